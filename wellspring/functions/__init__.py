"""Column builders and range joins."""
