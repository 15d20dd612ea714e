"""The first stage: layouts, patterns, quality filters, and the tagged records that later stages read."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as E
from .barcodes import passes_quality

Layout = dict[str, list[tuple[int, int]]]

#: The pattern that only switches a read's layout, the substitutions it may have unless a pattern says
#: otherwise, and the flags of unmapped records, single and by mate.
SWITCH, SWITCH_MISMATCHES = "ATTGCGCAATG", 1
SINGLE, FIRST, SECOND = 4, 77, 141
#: Lengths of the UMI at the start of read 1 and of the barcode at the end of read 2.
UMI_LENGTH, BARCODE_LENGTH = 10, 20


def parse_layout(text: str | Sequence[str]) -> Layout:
    """``BC(1-4,7-8);UMI(9-16)`` or a list of such parts, as 0-based half-open ranges by name; other parts are ignored."""
    parts = text if isinstance(text, (list, tuple)) else str(text).split(";")
    found = (re.match(r"(\w+)\((.*)\)", str(p).strip()) for p in parts)
    span = lambda r: (int(r.split("-")[0]) - 1, int(r.split("-")[1]))
    return {m[1]: [span(r) for r in m[2].split(",")] for m in found if m}


def configured_length(parts: str | Sequence[str]) -> int:
    """The last base that a layout names."""
    return max((end for ranges in parse_layout(parts).values() for _, end in ranges), default=0)


def parse_pattern(text: str | None) -> tuple[str, int] | None:
    """A pattern and its mismatches from ``SEQ`` or ``SEQ;n``; ``character(0)`` is none."""
    if text is None or text == "character(0)":
        return None
    seq, _, n = str(text).partition(";")
    return seq, int(n) if n else SWITCH_MISMATCHES


def pattern_checks(seq: Column, pattern: tuple[str, int] | None) -> tuple[Column, Column]:
    """(the pair stays, the read's layout holds). The switching pattern never drops a pair, others must be a prefix."""
    if pattern is None:
        return F.lit(True), F.lit(True)
    text, most = pattern
    if text == SWITCH:
        return F.lit(True), E.hamming(F.substring(seq, 1, len(text)), F.lit(text)) <= most
    return seq.startswith(text), F.lit(True)


def extract(seq: Column, qual: Column, layout: Layout, holds: Column) -> dict[str, Column]:
    """Barcode, UMI and cDNA of a read with their qualities; without its pattern a read has no UMI and its cDNA starts at 0."""
    out = {}
    for name, col in (("seq", seq), ("qual", qual)):
        start, end = layout["cDNA"][0] if "cDNA" in layout else (0, 0)
        out[f"BC_{name}"] = E.slices(col, layout.get("BC", []))
        out[f"UMI_{name}"] = F.when(holds, E.slices(col, layout.get("UMI", []))).otherwise("")
        out[f"cDNA_{name}"] = F.when(holds, E.slices(col, [(start, end)])).otherwise(E.slices(col, [(0, end)])) if "cDNA" in layout else F.lit("")
    return out


def filter_pairs(pairs: DataFrame, layouts: Sequence[Layout], patterns: Sequence[tuple[str, int] | None], barcode_filter: tuple[int, int], umi_filter: tuple[int, int], fixed: str | None = None) -> DataFrame:
    """``pairs`` (seq1, qual1 and, of mates, seq2, qual2) with CR, CY, UR, UY, seq and qual of each mate's cDNA, and ``keep``.

    Filters are (number of bases, phred): fewer bases under phred than that. Barcodes are joined over the mates; a column
    ``fixed``, named here, overrides them with best quality where it isn't null. Rows are not dropped, since the totals
    of qualities count what is filtered too: ``where('keep')`` is the filter.
    """
    mates = range(1, len(layouts) + 1)
    keep, parts = F.lit(True), []
    for i, layout in zip(mates, layouts):
        pattern = patterns[i - 1] if i <= len(patterns) else None
        stays, holds = pattern_checks(F.col(f"seq{i}"), pattern)
        keep = keep & stays
        parts.append(extract(F.col(f"seq{i}"), F.col(f"qual{i}"), layout, holds))
    joined = lambda k: F.concat(*[p[k] for p in parts])
    own = {"CR": joined("BC_seq"), "CY": joined("BC_qual"), "UR": joined("UMI_seq"), "UY": joined("UMI_qual")}
    if fixed is not None:
        own["CY"] = F.when(F.col(fixed).isNotNull(), F.repeat(F.lit("I"), F.length(fixed))).otherwise(own["CY"])
        own["CR"] = F.coalesce(F.col(fixed), own["CR"])
    own |= {f"cDNA{i}_{k}": p[f"cDNA_{k}"] for i, p in zip(mates, parts) for k in ("seq", "qual")}
    out = pairs.withColumns(own)
    good = passes_quality(F.col("CY"), barcode_filter[1], barcode_filter[0]) & passes_quality(F.col("UY"), umi_filter[1], umi_filter[0])
    return out.withColumn("keep", keep & good)


def unmapped_records(kept: DataFrame, paired: bool = True) -> DataFrame:
    """(qname, flag, seq, qual, CR, CY, UR, UY): one unmapped record a read, flagged 4, or 77 and 141 for mates."""
    flags = ((FIRST, 1), (SECOND, 2)) if paired else ((SINGLE, 1),)
    mates = F.array(*[F.struct(F.lit(flag).alias("flag"), F.col(f"cDNA{i}_seq").alias("seq"), F.col(f"cDNA{i}_qual").alias("qual")) for flag, i in flags])
    return kept.select("qname", F.explode(mates).alias("m"), "CR", "CY", "UR", "UY").select("qname", "m.flag", "m.seq", "m.qual", "CR", "CY", "UR", "UY")


def first_pairs(pairs: DataFrame, limit: int, order: Sequence[str] = ("pair_no", "rec_no")) -> DataFrame:
    """The first ``limit`` pairs in input order, counted before any filter; all if it is not over 0."""
    return pairs.orderBy(*order).limit(limit) if limit > 0 else pairs


def infer_layout(lengths: DataFrame, samplesheet: bool) -> tuple[str, list[str], list[str]]:
    """(barcode source, layout of read 1, of read 2) from (pair_no, len1, len2), one row a pair of files.

    All pairs must agree. Read 2 longer by a barcode holds it at its end; equal lengths need a samplesheet.
    """
    kinds = [(r.len1, r.len2) for r in lengths.select("len1", "len2").distinct().limit(2).collect()]
    if len(kinds) != 1:
        raise ValueError("all FASTQ pairs must have identical read lengths" if kinds else "no FASTQ pairs")
    a, b = kinds[0]
    if a <= UMI_LENGTH:
        raise ValueError(f"read 1 has {a} bases; it must be longer than the UMI ({UMI_LENGTH})")
    first = [f"cDNA({UMI_LENGTH + 1}-{a})", f"UMI(1-{UMI_LENGTH})"]
    if b == a + BARCODE_LENGTH:
        if samplesheet:
            raise ValueError("a samplesheet is for reads of equal lengths; read 2 already ends in a barcode")
        return "read_embedded_barcode", first, [f"cDNA(1-{b - BARCODE_LENGTH})", f"BC({b - BARCODE_LENGTH + 1}-{b})"]
    if a != b:
        raise ValueError(f"unsupported read lengths {a} and {b}")
    if not samplesheet:
        raise ValueError("reads of equal lengths need a samplesheet for their barcodes")
    return "samplesheet_barcode", first, [f"cDNA(1-{b})"]


def layout_of(records: DataFrame, order: Sequence[str] = ("rec_no",)) -> DataFrame:
    """One row (layout): SE if the first record's flag is 4, else PE; without records none."""
    first = records.agg(F.min_by("flag", F.struct(*order)).alias("flag")).where("flag IS NOT NULL")
    return first.select(F.when(F.col("flag") == SINGLE, "SE").otherwise("PE").alias("layout"))


def modal_length(records: DataFrame, first: int = 1000, order: Sequence[str] = ("rec_no",)) -> DataFrame:
    """One row (length): the commonest sequence length of the first records that have one, the smaller of two as common."""
    head = records.where(F.length("seq") > 0).orderBy(*order).limit(first)
    return head.groupBy(F.length("seq").alias("length")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "length").limit(1).select("length")


def corrected_once(reads: DataFrame, corrected: DataFrame, key: str = "qname") -> DataFrame:
    """Reads that have CC and CB already keep them; others take those of ``corrected`` (key, CC, CB)."""
    new = corrected.select(key, F.col("CC").alias("_cc"), F.col("CB").alias("_cb"))
    done = F.col("CC").isNotNull() & F.col("CB").isNotNull()
    met = reads.join(new, key, "left")
    return met.withColumns({"CC": F.when(done, F.col("CC")).otherwise(F.col("_cc")), "CB": F.when(done, F.col("CB")).otherwise(F.col("_cb"))}).drop("_cc", "_cb")


def streams(reads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(UMI stream, internal stream): reads that are not internal or have no cell, and internal ones alone."""
    inner = F.coalesce(F.col("is_internal"), F.lit(False))
    return reads.where(~inner | F.col("CB").isNull()), reads.where(inner)


def with_umi(reads: DataFrame, tag: str = "UR") -> tuple[DataFrame, DataFrame]:
    """(reads with a UMI, reads without)."""
    has = F.coalesce(F.length(F.col(tag)) > 0, F.lit(False))
    return reads.where(has), reads.where(~has)


def merged_stats(parts: DataFrame) -> DataFrame:
    """(barcode, n) summed over the chunks' counts, upper-cased, in the order of barcodes."""
    return parts.groupBy(F.upper("barcode").alias("barcode")).agg(F.sum("n").cast("long").alias("n")).orderBy("barcode")


def merged_quality(parts: DataFrame) -> DataFrame:
    """(metric, total_bases, q30_bases, q30_rate) summed over the chunks, rate 0 without bases, by metric."""
    out = parts.groupBy("metric").agg(F.sum("total_bases").cast("long").alias("total_bases"), F.sum("q30_bases").cast("long").alias("q30_bases"))
    return out.withColumn("q30_rate", F.coalesce(E.ratio(F.col("q30_bases"), F.col("total_bases")), F.lit(0.0))).orderBy("metric")


def merged_categories(parts: DataFrame, counts: Mapping[str, str] | Sequence[str], key: str = "well") -> DataFrame:
    """Per-source read statistics added up by well."""
    return parts.groupBy(key).agg(*[F.sum(c).cast("long").alias(c) for c in counts])
