"""Which reads a gene-body curve is drawn from, and the curve itself."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as E


def sampling_fraction(total: Column, target: int) -> Column:
    """Share of reads that gives about ``target`` of them: 1 without a target or reads."""
    return F.when((F.lit(target) <= 0) | (F.coalesce(total, F.lit(0)) <= 0), F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.lit(float(target)) / total))


def sampled(name: Column, fraction: Column, seed: int = 42, source: Column | None = None) -> Column:
    """Whether a read is in the sample: the first 8 bytes of BLAKE2b over ``seed|source|name``, as a share of all, are under the fraction.

    The same reads are taken in every run and by every task, and a larger fraction takes all that a smaller one does.
    The engine has no BLAKE2b, so the hash is an Arrow batch function.
    """

    @F.pandas_udf("double")
    def share(keys: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in keys:
            yield batch.map(lambda k: int.from_bytes(hashlib.blake2b(k.encode(), digest_size=8).digest(), "big") / float(1 << 64)).astype("float64")

    key = F.concat_ws("|", F.lit(str(seed)), F.coalesce(source if source is not None else F.lit(""), F.lit("")), F.coalesce(name, F.lit("")))
    return (fraction >= 1) | (share(key) < fraction)


def primary_mapped(reads: DataFrame, paired: bool = True) -> DataFrame:
    """One row (mapped): mapped records that are neither secondary nor supplementary, of pairs read 1 only."""
    flag = F.col("flag")
    keep = flag.bitwiseAND(2308) == 0
    return reads.where(keep & (flag.bitwiseAND(64) != 0) if paired else keep).agg(F.count(F.lit(1)).alias("mapped"))


def is_primary(flag: Column, first_only: bool = True) -> Column:
    """Counts for coverage: mapped, neither secondary nor supplementary, and of a pair read 1."""
    return E.is_mapped(flag) & ((flag.bitwiseAND(0x900) == 0) & ((flag.bitwiseAND(1) == 0) | (flag.bitwiseAND(0x40) != 0)) if first_only else (flag.bitwiseAND(0x900) == 0))


def curve(coverage: DataFrame, window: int = 7, bins: int = 100) -> DataFrame:
    """(source, bin, coverage, smooth, max_norm): exactly ``bins`` bins, absent ones 0, smoothed and over their largest.

    ``coverage`` is (source, bin, coverage); bins beyond the last are left out. The moving average is centred, its
    edges continue the first and the last bin.
    """
    spark = coverage.sparkSession
    half = window // 2
    sources = coverage.select("source").distinct()
    axis = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    full = sources.join(axis, how="cross").join(coverage, ["source", "bin"], "left").select("source", "bin", F.coalesce("coverage", F.lit(0.0)).alias("coverage"))  # sources x bins
    w = Window.partitionBy("source").orderBy("bin")
    near = w.rowsBetween(-half, half)
    ends = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    missing = lambda n: F.greatest(F.lit(0), n)
    padded = F.sum("coverage").over(near) + missing(half - F.col("bin")) * F.first("coverage").over(ends) + missing(F.col("bin") + half - (bins - 1)) * F.last("coverage").over(ends)
    out = full.withColumn("smooth", padded / float(2 * half + 1))
    top = F.max("smooth").over(Window.partitionBy("source"))
    return out.withColumn("max_norm", F.when(top > 0, F.col("smooth") / top).otherwise(F.lit(0.0)))
