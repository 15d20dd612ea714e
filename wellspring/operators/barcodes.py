"""Barcode counting, selection, error-tolerant matching and discovery."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as E


def passes_quality(qual: Column, phred: int, bases: int) -> Column:
    """Fewer than ``bases`` bases under ``phred``."""
    return E.low_quality(qual, phred) < bases


def counts(reads: DataFrame, barcode: str, keep: Column | None = None) -> DataFrame:
    """(XC, n)."""
    rows = reads if keep is None else reads.where(keep)
    return rows.groupBy(F.col(barcode).alias("XC")).agg(F.count(F.lit(1)).alias("n"))


def quality_totals(reads: DataFrame, labels: dict[str, str]) -> DataFrame:
    """(metric, total_bases, q30_bases, rate) for quality columns by label; before any filter."""
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("metric"), F.col(c).alias("q")) for k, c in labels.items()]))
    rows = reads.select(pairs.alias("p")).select("p.metric", "p.q")
    out = rows.groupBy("metric").agg(F.sum(F.length("q")).cast("long").alias("total_bases"), F.sum(E.high_quality(F.col("q"))).cast("long").alias("q30_bases"))
    return out.withColumn("rate", E.ratio(F.col("q30_bases"), F.col("total_bases")))


def ranked(bc: DataFrame) -> DataFrame:
    """With ``rank`` by falling count, then barcode.

    Barcodes of one count and one beginning are ranked among themselves; how many come before these follows from the
    histogram of counts and beginnings, which alone is sorted as a whole.
    """
    rows = bc.withColumn("_p", F.substring("XC", 1, 4))
    before = Window.orderBy(F.desc("n"), F.asc("_p")).rowsBetween(Window.unboundedPreceding, -1)
    cells = rows.groupBy("n", "_p").agg(F.count(F.lit(1)).alias("_k")).select("n", "_p", F.coalesce(F.sum("_k").over(before), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("n", "_p").orderBy("XC"))
    return rows.withColumn("_own", own).join(cells, ["n", "_p"]).withColumn("rank", (F.col("_before") + F.col("_own")).cast("int")).select(*bc.columns, "rank")


def knee(bc: DataFrame) -> DataFrame:
    """One row (cutoff): the count at the first point farthest from the chord of log10 counts over ranks.

    Barcodes of one count lie on a level stretch, whose farthest point is one of its ends: the curve is worked out on
    the histogram of counts, which grows with the square root of the reads, not on all barcodes in one task.
    """
    hist = bc.groupBy("n").agg(F.count(F.lit(1)).alias("k"))
    w = Window.orderBy(F.desc("n"))
    last = F.sum("k").over(w.rowsBetween(Window.unboundedPreceding, 0))
    points = hist.select("n", last.alias("last"), (last - F.col("k") + 1).alias("first"))
    ends = points.select("n", F.explode(F.array("first", "last")).alias("r"))
    span = points.agg(F.max("last").alias("x1"), F.log10(F.max("n")).alias("y0"), F.log10(F.min("n")).alias("y1"))
    far = F.abs((F.col("y1") - F.col("y0")) * (F.col("r") - 1) - (F.col("x1") - 1) * (F.log10("n") - F.col("y0")))
    at = ends.crossJoin(F.broadcast(span)).withColumn("d", F.round(far, 9))  # one row of limits
    return at.agg(F.max_by("n", F.struct(F.col("d"), (-F.col("r")).alias("r"))).alias("cutoff"))


def select_top(bc: DataFrame, number: int, least: int) -> DataFrame:
    """Eligible barcodes with ``keep`` for the first ``number`` of them."""
    return ranked(bc.where(F.col("n") >= least)).withColumn("keep", F.col("rank") <= number)


def select_knee(bc: DataFrame, least: int, floor: int = 10, fallback: int = 100) -> DataFrame:
    """Eligible barcodes with ``keep`` from the knee's count on; the first ``fallback`` too if that keeps under ``floor``."""
    rows = bc.where(F.col("n") >= least)
    limits = rows.crossJoin(F.broadcast(knee(rows))).agg(F.first("cutoff").alias("cutoff"), F.count(F.when(F.col("n") >= F.col("cutoff"), 1)).alias("kept"))
    over = ranked(rows).crossJoin(F.broadcast(limits))  # one row
    return over.withColumn("keep", (F.col("n") >= F.col("cutoff")) | ((F.col("kept") < floor) & (F.col("rank") <= fallback))).drop("kept", "cutoff")


def select_knee_listed(bc: DataFrame, whitelist: DataFrame, least: int, floor: int = 10, fallback: int = 100) -> DataFrame:
    """The knee's barcodes that the whitelist has too; the rest have ``keep`` false."""
    listed = whitelist.select(F.col("barcode").alias("XC")).distinct().withColumn("_in", F.lit(True))
    return select_knee(bc, least, floor, fallback).join(listed, "XC", "left").withColumn("keep", F.col("keep") & F.coalesce("_in", F.lit(False))).drop("_in")


def select_listed(bc: DataFrame, whitelist: DataFrame, least: int) -> DataFrame:
    """Eligible barcodes of the whitelist."""
    return bc.where(F.col("n") >= least).join(whitelist.select(F.col("barcode").alias("XC")).distinct(), "XC", "left_semi")


def unlisted(bc: DataFrame, whitelist: DataFrame, limit: int = 100) -> DataFrame:
    """The commonest barcodes that the whitelist lacks (a top-k report)."""
    rest = bc.join(whitelist.select(F.col("barcode").alias("XC")), "XC", "left_anti")
    return rest.orderBy(F.desc("n"), F.asc("XC")).limit(limit)


def near_matches(true: DataFrame, observed: DataFrame, distance: int = 1) -> DataFrame:
    """(trueBC, falseBC, hamming): exact matches, and texts of one length within ``distance`` otherwise.

    For 1, texts that share a mask; for more, texts that share one of distance + 1 pieces (of as many, one is untouched),
    verified. With 2 and more only the nearest of each observed barcode are returned.
    """
    t = true.select(F.col("barcode").alias("trueBC")).distinct()
    o = observed.select(F.col("barcode").alias("falseBC")).distinct()
    exact = o.join(t, o["falseBC"] == t["trueBC"]).select("trueBC", "falseBC", F.lit(0).alias("hamming"))
    rest = o.join(t, o["falseBC"] == t["trueBC"], "left_anti")
    if distance == 1:
        met = t.withColumn("m", F.explode(E.masks(F.col("trueBC")))).join(rest.withColumn("m", F.explode(E.masks(F.col("falseBC")))), "m")
        near = met.select("trueBC", "falseBC", F.lit(1).alias("hamming")).distinct()
    else:
        k = distance + 1

        def pieces(c: str) -> Column:
            cut = lambda i: F.floor(i * F.length(c) / k).cast("int")  # noqa: E731  no piece is empty if there are letters for all
            return F.explode(F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.struct(F.length(c).alias("n"), i.alias("i"), F.substr(F.col(c), cut(i) + 1, cut(i + 1) - cut(i)).alias("s"))))

        met = t.withColumn("m", pieces("trueBC")).join(rest.withColumn("m", pieces("falseBC")), "m").select("trueBC", "falseBC").distinct()
        met = met.withColumn("hamming", E.hamming(F.col("trueBC"), F.col("falseBC"))).where(F.col("hamming") <= distance)
        near = met.withColumn("_r", F.rank().over(Window.partitionBy("falseBC").orderBy("hamming"))).where("_r = 1").drop("_r")
    return exact.unionByName(near)


def binning(true: DataFrame, observed: DataFrame, distance: int = 1) -> DataFrame:
    """Near matches of observed barcodes that have exactly one, exact ones left out."""
    near = near_matches(true, observed, distance).where("hamming > 0")
    return near.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("falseBC"))).where("_n = 1").drop("_n")


def add_back(kept: DataFrame, bins: DataFrame, bc: DataFrame) -> DataFrame:
    """(XC, n): kept counts with those of the barcodes binned to them."""
    more = bins.join(bc.withColumnRenamed("XC", "falseBC"), "falseBC").groupBy(F.col("trueBC").alias("XC")).agg(F.sum("n").alias("more"))
    return kept.select("XC", "n").join(more, "XC", "left").select("XC", (F.col("n") + F.coalesce("more", F.lit(0))).cast("long").alias("n"))


def by_well(expected: DataFrame, bc: DataFrame) -> DataFrame:
    """(wellID, umi_reads, internal_reads, total_reads) for expected (wellID, barcode, kind)."""
    met = expected.join(bc.withColumnRenamed("XC", "barcode"), "barcode", "left")
    part = lambda k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0)).cast("long")
    return met.groupBy("wellID").agg(part("umi").alias("umi_reads"), part("internal").alias("internal_reads"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total_reads"))


def discovery_matches(bc: DataFrame, candidates: DataFrame) -> DataFrame:
    """The best record of each (observed, candidate): exact matches shut out those at distance 1 of the same barcode."""
    near = near_matches(candidates.select("barcode"), bc.select(F.col("XC").alias("barcode")))
    met = near.join(candidates, near["trueBC"] == candidates["barcode"]).join(bc, F.col("falseBC") == F.col("XC"))
    w = Window.partitionBy("XC", "candidate_type", "candidate_id").orderBy("hamming", "wellID", "barcode_type", "barcode")
    return met.withColumn("_r", F.row_number().over(w)).where("_r = 1").select("XC", "n", "candidate_type", "candidate_id", "wellID", "barcode", "barcode_type", "hamming")


def discovery_summary(matches: DataFrame) -> DataFrame:
    """Reads, exact and near reads, distinct observed and expected barcodes of each candidate."""
    part = lambda d: F.coalesce(F.sum(F.when(F.col("hamming") == d, F.col("n"))), F.lit(0)).cast("long")
    return matches.groupBy("candidate_type", "candidate_id").agg(
        F.sum("n").cast("long").alias("reads"), part(0).alias("exact_reads"), part(1).alias("hamming1_reads"),
        F.count_distinct("XC").alias("observed"), F.count_distinct("barcode").alias("expected"),
    )


def discovery_selection(summary: DataFrame, share: float = 0.2, expected: int = 2, types: Sequence[str] = ("manual", "auto")) -> DataFrame:
    """Candidates of the best one's type with enough barcodes and at least ``share`` of its reads (at least 1)."""
    rank = F.coalesce(F.array_position(F.array(*map(F.lit, types)), F.col("candidate_type")).cast("int"), F.lit(0))
    rank = F.when(rank == 0, len(types) + 1).otherwise(rank)
    best = summary.agg(F.max_by(F.struct("candidate_type", "reads"), F.struct(F.col("reads"), F.col("expected"), -rank)).alias("b")).select(F.col("b.candidate_type").alias("bt"), F.col("b.reads").alias("br"))
    met = summary.crossJoin(F.broadcast(best))  # one row
    least = F.greatest(F.lit(1), F.floor(F.col("br") * share))
    return met.where((F.col("candidate_type") == F.col("bt")) & (F.col("expected") >= expected) & (F.col("reads") >= least)).drop("bt", "br")


def discover(bc: DataFrame, candidates: DataFrame, least_reads: int = 1, share: float = 0.2, expected: int = 2) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(summary, matches, the selected candidates' records) of barcode counts against all candidates.

    Best candidates of two types that tie in reads and expected barcodes, and none that is sure, raise errors. The
    summary has a row a candidate; one pair of its numbers is what the driver sees.
    """
    matches = discovery_matches(bc.where(F.col("n") >= least_reads), candidates)
    summary = discovery_summary(matches)
    best = summary.agg(F.max(F.struct("reads", "expected")).alias("b")).first().b
    if best is not None:
        tied = [r[0] for r in summary.where((F.col("reads") == best.reads) & (F.col("expected") == best.expected)).select("candidate_type").distinct().collect()]
        if len(tied) > 1:
            raise ValueError(f"barcodes do not tell {' and '.join(sorted(tied))} candidates apart")
    selected = discovery_selection(summary, share, expected)
    if selected.isEmpty():
        raise ValueError("no candidate is sure")
    return summary, matches, candidates.join(selected.select("candidate_type", "candidate_id"), ["candidate_type", "candidate_id"], "left_semi")


def correct(reads: DataFrame, corrections: DataFrame, wells: DataFrame) -> DataFrame:
    """Reads (with CR) and ``CC``, ``CB`` and ``is_internal`` by dictionaries (falseBC, trueBC) and (barcode, wellID, kind).

    Reads of unknown wells get neither CC nor CB. Dictionaries must not repeat keys; their sizes are those of the plates.
    """
    met = reads.withColumn("CR", F.upper("CR")).join(corrections.select(F.col("falseBC").alias("CR"), "trueBC"), "CR", "left")
    met = met.withColumn("_cc", F.coalesce("trueBC", "CR")).drop("trueBC")
    met = met.join(wells.select(F.col("barcode").alias("_cc"), F.col("wellID").alias("CB"), F.col("kind").alias("_kind")), "_cc", "left")
    return met.withColumn("CC", F.when(F.col("CB").isNotNull(), F.col("_cc"))).withColumn("is_internal", F.coalesce(F.col("_kind") == "internal", F.lit(False))).drop("_cc", "_kind")


def adjust(reads: DataFrame) -> DataFrame:
    """First mates (flag 77): three bases trimmed from others than internal reads, the UMI put before internal ones."""
    first, inner = F.col("flag") == 77, F.col("is_internal")
    trim = lambda c: F.when(first & ~inner & (F.length("seq") > 3), F.substr(F.col(c), F.lit(4)))
    out = reads.withColumn("_s", trim("seq")).withColumn("_q", trim("qual"))
    seq = F.coalesce("_s", F.when(first & inner, F.concat(F.coalesce("UR", F.lit("")), "seq")), "seq")
    qual = F.coalesce("_q", F.when(first & inner, F.concat(F.coalesce("UY", F.lit("")), "qual")), "qual")
    clear = inner & F.col("flag").isin(77, 141)
    return out.withColumns({"seq": seq, "qual": qual}).withColumns({c: F.when(~clear, F.col(c)) for c in ("UR", "UY")}).drop("_s", "_q")
