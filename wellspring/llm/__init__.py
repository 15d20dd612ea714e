"""Operators for preparing training text at corpus scale.

Each module holds one operator with a general interface (DataFrame in, DataFrame out); ``queries`` holds the thin
``opN_*`` queries that fix parameters and derive digest columns. Nothing outside this subpackage imports it.
"""
