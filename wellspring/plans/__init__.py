"""Registered queries over the driver's tables, with the SQL that each is compared with."""
