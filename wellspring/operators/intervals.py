"""Algebra of closed integer intervals within groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def merge(df: DataFrame, keys: Sequence[str], start: str = "start", end: str = "end", gap: int = 1) -> DataFrame:
    """Unions of intervals at most ``gap`` apart: 1 joins adjacent closed intervals, 0 only overlapping or, half-open, touching."""
    w = Window.partitionBy(*keys).orderBy(start, end)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(before.isNull() | (F.col(start) > before + gap), 1).otherwise(0)
    island = df.withColumn("_new", new).withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return island.groupBy(*keys, "_island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_island")


def gaps(merged: DataFrame, keys: Sequence[str], start: str = "start", end: str = "end") -> DataFrame:
    """What lies between neighbouring merged intervals."""
    following = F.lead(start).over(Window.partitionBy(*keys).orderBy(start))
    out = merged.select(*keys, (F.col(end) + 1).alias(start), (following - 1).alias(end))
    return out.where(F.col(end) >= F.col(start))


def from_positions(df: DataFrame, keys: Sequence[str], pos: str = "pos") -> DataFrame:
    """Distinct positions as closed intervals."""
    w = Window.partitionBy(*keys).orderBy(pos)
    island = df.select(*keys, pos).distinct().withColumn("_i", F.col(pos) - F.row_number().over(w))
    return island.groupBy(*keys, "_i").agg(F.min(pos).alias("start"), F.max(pos).alias("end")).drop("_i")


def single_cover(df: DataFrame, keys: Sequence[str], owner: str, start: str = "start", end: str = "end") -> DataFrame:
    """Segments that exactly one interval covers, with its ``owner`` (a number): a sweep over summed +1 and -1 events."""
    events = df.select(*keys, F.col(start).alias("at"), F.lit(1).alias("d"), F.col(owner).cast("long").alias("o")).unionByName(
        df.select(*keys, (F.col(end) + 1).alias("at"), F.lit(-1).alias("d"), (-F.col(owner)).cast("long").alias("o"))
    )
    events = events.groupBy(*keys, "at").agg(F.sum("d").alias("d"), F.sum("o").alias("o"))
    w = Window.partitionBy(*keys).orderBy("at")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    swept = events.select(*keys, F.col("at").alias(start), (F.lead("at").over(w) - 1).alias(end), F.sum("d").over(run).alias("_depth"), F.sum("o").over(run).alias(owner))
    return swept.where((F.col("_depth") == 1) & F.col(end).isNotNull()).drop("_depth")


def _swept(a: DataFrame, b: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Segments between neighbouring edges of both sets, with how many intervals of each (``_a``, ``_b``) cover them."""
    event = lambda df, n: df.select(*keys, F.col(start).alias("at"), F.lit(n).alias("a"), F.lit(1 - n).alias("b")).unionByName(df.select(*keys, (F.col(end) + 1).alias("at"), F.lit(-n).alias("a"), F.lit(n - 1).alias("b")))
    events = event(a, 1).unionByName(event(b, 0)).groupBy(*keys, "at").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    w = Window.partitionBy(*keys).orderBy("at")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    return events.select(*keys, F.col("at").alias(start), (F.lead("at").over(w) - 1).alias(end), F.sum("a").over(run).alias("_a"), F.sum("b").over(run).alias("_b"))


def difference(a: DataFrame, b: DataFrame, keys: Sequence[str], start: str = "start", end: str = "end") -> DataFrame:
    """Parts of ``a``'s union that ``b`` does not cover."""
    return merge(_swept(a, b, keys, start, end).where("_a > 0 AND _b = 0").drop("_a", "_b"), keys, start, end)


def intersect(a: DataFrame, b: DataFrame, keys: Sequence[str], start: str = "start", end: str = "end") -> DataFrame:
    """What the unions of both sets cover."""
    return merge(_swept(a, b, keys, start, end).where("_a > 0 AND _b > 0").drop("_a", "_b"), keys, start, end)


def union(a: DataFrame, b: DataFrame, keys: Sequence[str], start: str = "start", end: str = "end") -> DataFrame:
    """What either set covers, adjacent intervals joined."""
    return merge(a.select(*keys, start, end).unionByName(b.select(*keys, start, end)), keys, start, end)


def internal_gaps(df: DataFrame, span: DataFrame, keys: Sequence[str], start: str = "start", end: str = "end") -> DataFrame:
    """Parts of each group's ``span`` (keys, start, end) that its intervals leave open, ahead of the first and after the last too."""
    return difference(span, df, keys, start, end)


def extent(df: DataFrame, keys: Sequence[str], start: str = "start", end: str = "end") -> DataFrame:
    """(keys, n, bases, first, last) of each group's merged intervals."""
    return merge(df, keys, start, end).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(end) - F.col(start) + 1).cast("long").alias("bases"), F.min(start).alias("first"), F.max(end).alias("last"))


def overlaps(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Whether two closed intervals share a position; a point is an interval of one."""
    return (a_start <= b_end) & (b_start <= a_end)


def segments(df: DataFrame, keys: Sequence[str], member: str, start: str = "start", end: str = "end") -> DataFrame:
    """Elementary segments with the sorted set of members that cover each; neighbours of one set are one segment."""
    from ..functions.ranges import overlap_join

    edges = df.select(*keys, F.col(start).alias("at")).unionByName(df.select(*keys, (F.col(end) + 1).alias("at"))).distinct()
    w = Window.partitionBy(*keys).orderBy("at")
    parts = edges.select(*keys, F.col("at").alias("s"), (F.lead("at").over(w) - 1).alias("e")).where("e IS NOT NULL")
    met = overlap_join(parts, df, keys, "s", "e", start, end).groupBy(*keys, "s", "e").agg(F.sort_array(F.collect_set(member)).alias("members"))
    return merge(met.withColumnsRenamed({"s": start, "e": end}), [*keys, "members"], start, end)
