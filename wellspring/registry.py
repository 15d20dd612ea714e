"""All queries of the library's own operators, with the SQL that each is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import registered, stages  # noqa: F401  stages adds its queries to the same tables


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(registered.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(registered.ORACLE)
