"""Per-well quality tables and run summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as E

#: Read categories of the well table.
CATEGORIES = ("Exon", "Intron", "Intergenic", "Ambiguity", "Unmapped", "Other_Unassigned")


def read_stats(reads: DataFrame) -> DataFrame:
    """(well, one column per category, umi_reads, internal_reads): reads without a well are ``__NO_CB__``."""
    known = F.when(F.col("category").isin(*CATEGORIES[:-1]), F.col("category")).otherwise(CATEGORIES[-1])
    n = lambda cond: F.count(F.when(cond, 1))
    return reads.withColumn("_c", known).groupBy(F.coalesce("well", F.lit("__NO_CB__")).alias("well")).agg(
        *[n(F.col("_c") == c).alias(c) for c in CATEGORIES], n(F.col("source") == "UMI").alias("umi_reads"), n(F.col("source") == "Internal").alias("internal_reads")
    )


def with_ratios(stats: DataFrame) -> DataFrame:
    """Mapping, genic and exon-to-intron ratios; null where the denominator is 0."""
    c = F.col
    mapped = c("Exon") + c("Intron") + c("Intergenic") + c("Ambiguity") + c("Other_Unassigned")
    every = mapped + c("Unmapped")
    return stats.withColumns({
        "all_reads": every, "MappingRatio": E.ratio(mapped, every), "GenicRatio": E.ratio(c("Exon") + c("Intron"), every),
        "ExonIntronRatio": E.ratio(c("Exon"), c("Intron")), "UMIfrac": E.ratio(c("umi_reads"), every),
    })


def well_stats(wells: DataFrame, stats: DataFrame, summary: DataFrame) -> DataFrame:
    """Every expected well with its read statistics and, per type, UMIs and genes; 0 where there is nothing."""
    kinds = {"exon": "Exon", "intron": "Intron", "inex": "Intron_Exon"}
    wide = summary.groupBy("well").agg(*[F.max(F.when(F.col("ftype") == k, F.col(f))).alias(f"{v}_{n}") for k, v in kinds.items() for f, n in (("total", "umis"), ("genes", "genes"))])
    out = wells.select("well").distinct().join(stats, "well", "left").join(wide, "well", "left")
    zero = [c for c, t in out.dtypes if t in ("bigint", "int")]
    return with_ratios(out.fillna(0, zero).drop("all_reads", "MappingRatio", "GenicRatio", "ExonIntronRatio", "UMIfrac"))


def expected_wells(wells: DataFrame, stats: DataFrame) -> DataFrame:
    """(well, expected, the columns of ``stats``): expected wells and those that were read, whatever the case of their names."""
    own = wells.select(F.upper("well").alias("_k"), F.col("well").alias("_w")).distinct()
    met = own.join(stats.withColumn("_k", F.upper("well")), "_k", "full_outer")
    rest = [c for c in stats.columns if c != "well"]
    return met.select(F.coalesce("_w", "well").alias("well"), F.col("_w").isNotNull().alias("expected"), *rest)


def failed(thresholds: dict[str, float]) -> Column:
    """The enabled thresholds that a well misses; a missing metric misses its threshold."""
    misses = [F.when(F.coalesce(F.col(m) < t, F.lit(True)), F.lit(m)) for m, t in sorted(thresholds.items())]
    return F.array_compact(F.array(*misses)) if misses else F.array().cast("array<string>")


def plates(stats: DataFrame, thresholds: dict[str, float], metrics: tuple[str, ...]) -> DataFrame:
    """(plate, expected, active, active_share, medians): of active wells, or of all where none is active."""
    rows = stats.withColumn("plate", E.plate(F.col("well"))).withColumn("_ok", F.size(failed(thresholds)) == 0)
    flag = rows.groupBy("plate").agg(F.count(F.lit(1)).alias("expected"), F.count(F.when(F.col("_ok"), 1)).alias("active"), *[
        F.coalesce(F.median(F.when(F.col("_ok"), F.col(m))), F.median(m)).alias(f"median_{m}") for m in metrics
    ])
    return flag.withColumn("active_share", E.ratio(F.col("active"), F.col("expected")))


def run_summary(stats: DataFrame, metrics: tuple[str, ...]) -> DataFrame:
    """Mean and median of each metric over wells, and the genic share without unassigned reads."""
    assigned = sum((F.sum(c) for c in CATEGORIES[1:-1]), F.sum(CATEGORIES[0]))
    parts = [f(F.col(m).cast("double")).alias(f"{n}_{m}") for m in metrics for n, f in (("mean", F.avg), ("median", F.median))]
    return stats.agg(*parts, E.ratio(F.sum("Exon") + F.sum("Intron"), assigned).alias("transcriptome_share"))
