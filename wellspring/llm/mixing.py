"""Mixing sources to target weights: subset sums over exact document lengths."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

#: The dynamic programme fits this many of a source's longest documents; what is left of the budget is never larger.
LONGEST = 3


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; null counts 0. What is left over when a space is put for each run."""
    return F.coalesce(F.size(F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """(source, source_size, target): ``share`` of all sizes divided by weight, each target at most ``most`` times its size.

    Sources in order of code points, null last, take the weights in turn. With sources ordered by cap over weight, those
    that reach their cap come first; the level of the others follows from running sums. One row per source is sorted in
    one task, nothing is collected. ``sizes`` has (source, source_size); sources of size 0 get target 0.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    s = sizes.select("source", "source_size", w.alias("w"), (F.col("source_size") * float(most)).alias("cap"))
    everything = Window.partitionBy(F.lit(0))
    up = Window.orderBy((F.col("cap") / F.col("w")).asc(), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    s = s.select(
        "*",
        (F.sum("source_size").over(everything) * float(share)).alias("budget"),
        F.coalesce(F.sum("cap").over(up), F.lit(0.0)).alias("cap_before"),
        (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(up), F.lit(0.0))).alias("w_left"),
    )
    level = (F.col("budget") - F.col("cap_before")) / F.col("w_left")
    s = s.withColumn("level", F.when(level * F.col("w") < F.col("cap"), F.struct(F.col("cap") / F.col("w"), level.alias("level"))))
    # The first source that stays under its cap fixes the level for all after it.
    return s.select("source", "source_size", F.least(F.col("cap"), F.coalesce(F.min("level").over(everything)["level"] * F.col("w"), F.col("cap"))).alias("target"))


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length (ascending, over 0) to take so that their words come nearest to ``budget``.

    Most of the budget is met in proportion to the counts; a bounded knapsack over reachable sums (each count split in
    powers of two, sums as the bits of an integer) fits the rest, which is at most a few of the longest documents. Each
    sum keeps the part that first reached it, so memory is four bytes a sum, whatever the number of lengths. Of two
    equally near sums the smaller is taken.
    """
    take = np.zeros(len(lengths), np.int64)
    total = int((lengths * counts).sum())
    if budget <= 0 or total <= 0:
        return take
    if budget >= total:
        return counts.astype(np.int64)
    rest_size = LONGEST * int(lengths.max())
    bulk = max(0.0, (budget - rest_size) / total)
    take = np.floor(counts * bulk).astype(np.int64)
    rest = budget - int((lengths * take).sum())
    # The shortest documents first refine the sum; lengths are taken from long to short until the rest is spent.
    for i in np.argsort(-lengths, kind="stable"):
        more = min(int(counts[i] - take[i]), max(0, (rest - rest_size) // int(lengths[i])))
        take[i] += more
        rest -= more * int(lengths[i])
    limit = rest + int(lengths.max())
    mask, reach, items, by = (1 << (limit + 1)) - 1, 1, [], np.full(limit + 1, -1, np.int32)
    for i in range(len(lengths)):
        left, part = min(int(counts[i] - take[i]), limit // int(lengths[i])), 1
        while left > 0:
            n = min(part, left)
            new = (reach << (n * int(lengths[i]))) & mask & ~reach
            if new:
                bits = np.unpackbits(np.frombuffer(new.to_bytes(limit // 8 + 1, "little"), np.uint8), bitorder="little")
                by[np.flatnonzero(bits)] = len(items)
                items.append((i, n))
                reach |= new
            left -= n
            part *= 2
        if reach >> rest & 1:
            break
    sums = reach
    below = (sums & ((1 << (rest + 1)) - 1)).bit_length() - 1
    above = sums >> (rest + 1)
    above = rest + 1 + (above & -above).bit_length() - 1 if above else None
    at = above if above is not None and above - rest < rest - below else below
    while at:  # what was left of a sum had been reached by earlier parts
        i, n = items[by[at]]
        take[i] += n
        at -= n * int(lengths[i])
    return take


def _plan(group: pd.DataFrame) -> pd.DataFrame:
    g = group.sort_values("size")
    size, n = g["size"].to_numpy(np.int64), g["n"].to_numpy(np.int64)
    target, words = int(round(float(g["target"].iloc[0]))), int((size * n).sum())
    whole = target // words  # times that every document is taken
    again = fit(size, n, target - whole * words)
    return pd.DataFrame({"key": g["key"].to_numpy(), "size": size, "whole": whole, "again": again})


def mix(df: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carry: Sequence[str] = ()) -> DataFrame:
    """Per row of ``df``: id, the columns ``carry``, ``size`` (words), ``source_size``, ``target`` (of its source) and ``taken`` words.

    Documents are counted by source and exact length. Per source, as many documents of each length are taken as a
    bounded knapsack finds to meet the target (every document once first, where the target exceeds the source), and
    within a length those with the smallest seeded hash. A document is taken 0, 1 or 2 times (``most`` of 2).

    Null texts have size 0 and are never taken; null sources are one source; repeated rows count as rows. Rows of one id and
    length are taken in the order of a hash of what they carry. Only ids, lengths, sources and carried
    columns are shuffled.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), word_count(F.col(text_col)).alias("size"), F.col(source_col).alias("source"), F.struct(F.lit(0).alias("_"), *carry).alias("carried"))
    # A text key stands for the null source; other sources are marked so that none equals it.
    rows = rows.withColumn("key", F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("null")))
    if not carry:
        rows = stored(rows.drop("carried"), "lengths")  # texts are read once
    by_length = rows.groupBy("source", "key", "size").agg(F.count(F.lit(1)).alias("n"))
    sizes = by_length.groupBy("source", "key").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    goal = targets(sizes, weights, share, most).select(F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("null")).alias("key"), "source_size", "target")
    plan = (
        by_length.where("size > 0").join(goal, "key").groupBy("key").applyInPandas(_plan, "key string, size long, whole long, again long")
    )
    # Rank within (source, length) by seeded hash: ranks within hash slices, plus the rows of the slices before, so that
    # one very common length isn't sorted in one task.
    slices = 64
    h = F.xxhash64(F.lit(seed), "doc_id")
    if carry:  # rows of one id and length whose texts differ have a fixed order too
        rows = rows.withColumn("tie", F.xxhash64("carried"))
    rows = rows.withColumn("h", h).withColumn("slice", F.shiftrightunsigned("h", 58).cast("int"))
    per = rows.where("size > 0").groupBy("key", "size", "slice").agg(F.count(F.lit(1)).alias("k"))
    before = Window.partitionBy("key", "size").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("before", F.coalesce(F.sum("k").over(before), F.lit(0))).drop("k")
    # Only slices in which the last taken document lies need ranks; the others are taken whole or not at all.
    plan = plan.join(per, ["key", "size"]).select("key", "size", "slice", "whole", (F.col("again") - F.col("before")).alias("quota"))
    rank = F.row_number().over(Window.partitionBy("key", "size", "slice").orderBy(F.shiftleft("h", 6), "doc_id", *(["tie"] if carry else [])))
    assert slices == 64
    taken = F.col("size") * (F.coalesce("whole", F.lit(0)) + F.when(F.col("rank") <= F.coalesce("quota", F.lit(0)), 1).otherwise(0))
    return (
        rows.withColumn("rank", rank)
        .join(plan, ["key", "size", "slice"], "left")
        .join(goal, "key", "left")
        .select("doc_id", "size", F.col("source_size").cast("long"), F.col("target").cast("double"), taken.cast("long").alias("taken"), *(F.col(f"carried.{c}").alias(c) for c in carry))
    )
