"""Annotations: contigs, gene regions, the table of exons and introns, and the indices of transcripts.

Intervals are closed and 1-based, as in a GTF; the transcript indices are closed and 0-based, as alignments are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import assign as A
from . import intervals as I

#: What marks an intron's row, and the width of an index's bins.
INTRON, BIN = "__INTRON__", 100_000


def genes(exons: DataFrame) -> DataFrame:
    """(gene, name, gene_no) of ``formats.gtf`` exons in the order of their first lines, numbered from 1."""
    first = exons.where(F.col("gene_id").isNotNull()).groupBy(F.col("gene_id").alias("gene")).agg(F.min_by("gene_name", "line_no").alias("name"), F.min("line_no").alias("_l"))
    return first.withColumn("gene_no", F.row_number().over(Window.orderBy("_l"))).drop("_l")  # a row a gene


def gene_regions(rows: DataFrame, contigs: DataFrame, contig: str | None = None, wanted: DataFrame | None = None, attribute: str = "gene_id") -> DataFrame:
    """(gene, chrom, tid, start, end, strand) of ``gene`` rows on known contigs (chrom, tid), by tid, start, end and gene.

    ``attribute`` names the genes where it is there, else gene_id; a gene's first row counts. ``contig`` and ``wanted``
    (gene) leave out others.
    """
    own = rows.withColumn("gene", F.coalesce(F.col(attribute), F.col("gene_id"))).where("gene IS NOT NULL")
    if contig is not None:
        own = own.where(F.col("chrom") == contig)
    if wanted is not None:
        own = own.join(wanted.select("gene").distinct(), "gene", "left_semi")
    met = own.join(contigs.select("chrom", "tid"), "chrom")
    first = met.groupBy("gene").agg(F.min_by(F.struct("chrom", "tid", "start", "end", "strand"), "line_no").alias("r"))
    return first.select("gene", "r.*").orderBy("tid", "start", "end", "gene")


def with_extra_contigs(exons: DataFrame, index: DataFrame, extra: DataFrame) -> DataFrame:
    """Exon rows with a synthetic gene for each extra contig (chrom), as long as ``index`` (chrom, length) says; an unknown one raises an error."""
    met = extra.select("chrom").distinct().join(index.select("chrom", "length"), "chrom", "left")
    bad = F.when(F.col("length").isNull(), F.raise_error(F.concat(F.lit("contig is missing from the index: "), "chrom"))).cast("long")
    size = F.coalesce(bad, F.col("length"))
    own = met.select("chrom", F.lit(1).cast("long").alias("start"), size.alias("end"), F.lit("+").alias("strand"), *[F.col("chrom").alias(c) for c in ("gene_id", "transcript_id", "gene_name")])
    last = exons.agg(F.coalesce(F.max("line_no") + 1, F.lit(0)).alias("line_no"))  # one row
    return exons.unionByName(own.crossJoin(F.broadcast(last)).select(*exons.columns))


def extended(exons: DataFrame, reach: int, buffer: int) -> DataFrame:
    """Exons (chrom, strand, gene, start, end) with each gene's 3' exon reaching out, up to its next neighbour less ``buffer``.

    The neighbour is the nearest merged exon of the locus beyond the exon's end, of whatever gene: a union of exons and
    merged exons in the order of the strand, over which a window finds the next one's edge.
    """
    locus, minus = ["chrom", "strand"], F.col("strand") == "-"
    tip = F.when(minus, -F.col("start")).otherwise(F.col("end"))
    w = Window.partitionBy("gene").orderBy(F.desc(tip), "start", "end")
    ranked = exons.withColumn("_r", F.row_number().over(w)).withColumn("_tip", tip)
    edge = F.when(minus, -F.col("end")).otherwise(F.col("start"))
    merged = I.merge(exons.select(*locus, "start", "end"), locus).select(*locus, edge.alias("_at"), F.lit(True).alias("_edge"))
    last = ranked.where("_r = 1").select(*locus, F.col("_tip").alias("_at"), F.lit(False).alias("_edge")).distinct()
    after = Window.partitionBy(*locus).orderBy("_at").rangeBetween(1, Window.unboundedFollowing)
    following = last.unionByName(merged).withColumn("_next", F.min(F.when(F.col("_edge"), F.col("_at"))).over(after)).where("NOT _edge").select(*locus, F.col("_at").alias("_tip"), "_next")
    met = ranked.join(following, [*locus, "_tip"], "left")
    by = F.when(F.col("_r") == 1, A.extension(F.col("_next") - F.col("_tip"), reach, buffer)).otherwise(0)
    return met.select("chrom", "strand", "gene", F.when(minus, F.col("start") - by).otherwise(F.col("start")).cast("long").alias("start"), F.when(minus, F.col("end")).otherwise(F.col("end") + by).cast("long").alias("end"))


def saf(exons: DataFrame, contigs: DataFrame | None = None, reach: int = 0, buffer: int = 0, order: DataFrame | None = None) -> DataFrame:
    """(GeneID, Chr, Start, End, Strand, intron, gene_no): merged exons and introns of every gene; introns' ids are marked.

    ``contigs`` (chrom) leaves out others, ``reach`` extends 3' ends, ``order`` (gene, gene_no) numbers the genes.
    """
    own = exons if contigs is None else exons.join(contigs.select("chrom").distinct(), "chrom", "left_semi")
    own = own.select("chrom", "strand", "gene", "start", "end")
    if reach > 0:
        own = extended(own, reach, buffer)
    key = ["chrom", "strand", "gene"]
    both = I.merge(own, key).withColumn("intron", F.lit(False)).unionByName(A.introns(own).withColumn("intron", F.lit(True)))
    both = both.withColumn("gene_no", F.lit(0)) if order is None else both.join(order.select("gene", "gene_no"), "gene")
    name = F.when(F.col("intron"), F.concat("gene", F.lit(INTRON))).otherwise(F.col("gene"))
    return both.select(name.alias("GeneID"), F.col("chrom").alias("Chr"), F.col("start").alias("Start"), F.col("end").alias("End"), F.col("strand").alias("Strand"), "intron", "gene_no")


def interval_index(rows: DataFrame, size: int = BIN) -> DataFrame:
    """(chrom, bin, gene, start, end, strand, intron): a row for each bin that a row of ``saf`` touches, ids without their mark."""
    own = rows.select(F.col("Chr").alias("chrom"), F.replace(F.col("GeneID"), F.lit(INTRON), F.lit("")).alias("gene"), F.col("Start").alias("start"), F.col("End").alias("end"), F.col("Strand").alias("strand"), F.col("GeneID").endswith(INTRON).alias("intron"))
    return own.withColumn("bin", F.explode(F.sequence(F.expr(f"start div {size}"), F.expr(f"end div {size}"))))


def transcript_indices(exons: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(exon entries, junction entries) as (gene, members, start, end), 0-based, of (gene, tx, start, end) in a GTF's numbers.

    Introns lie between neighbouring exons of a transcript as they are listed, before overlapping ones are merged.
    """
    zero = exons.select("gene", "tx", (F.col("start") - 1).alias("start"), (F.col("end") - 1).alias("end"))
    following = F.lead("start").over(Window.partitionBy("gene", "tx").orderBy("start", "end"))
    skips = zero.select("gene", "tx", (F.col("end") + 1).alias("start"), (following - 1).alias("end")).where("start <= end")
    return I.segments(I.merge(zero, ["gene", "tx"]), ["gene"], "tx"), I.segments(I.merge(skips, ["gene", "tx"]), ["gene"], "tx")


def index_entries(segments: DataFrame) -> DataFrame:
    """(gene, intervals, transcripts): an entry's intervals as ``[s,e] | [s,e]`` and its transcripts between commas."""
    listed = F.transform(F.sort_array(F.collect_list(F.struct("start", "end"))), lambda x: F.concat(F.lit("["), x["start"].cast("string"), F.lit(","), x["end"].cast("string"), F.lit("]")))
    return segments.groupBy("gene", "members").agg(F.array_join(listed, " | ").alias("intervals")).select("gene", "intervals", F.array_join("members", ",").alias("transcripts"))


def parse_intervals(text: Column) -> Column:
    """Intervals of such a text as an array of (start, end); parts that aren't intervals, or end before they start, are left out."""
    part = r"\[\s*(-?\d+)\s*,\s*(-?\d+)\s*\]"
    both = F.arrays_zip(F.regexp_extract_all(text, F.lit(part), F.lit(1)).alias("start"), F.regexp_extract_all(text, F.lit(part), F.lit(2)).alias("end"))
    typed = F.transform(both, lambda x: F.struct(x["start"].cast("long").alias("start"), x["end"].cast("long").alias("end")))
    return F.filter(typed, lambda x: x["start"] <= x["end"])


def read_index(entries: DataFrame, legacy: str | None = None) -> DataFrame:
    """(gene, members, start, end) of ``index_entries``. Legacy ones are 1-based: ``exon``, or ``refskip`` from an exon's end to the next's start."""
    each = entries.select("gene", F.transform(F.split("transcripts", ","), lambda t: F.trim(t)).alias("members"), F.explode(parse_intervals(F.col("intervals"))).alias("x"))
    shift = {None: (0, 0), "exon": (-1, -1), "refskip": (0, -2)}[legacy]
    return each.select("gene", "members", (F.col("x.start") + shift[0]).alias("start"), (F.col("x.end") + shift[1]).alias("end")).where("start <= end")


def clusters(regions: DataFrame, keys: Sequence[str] = ("chrom",)) -> DataFrame:
    """Gene regions with ``cluster``: numbered runs of genes that overlap or lie next to each other."""
    w = Window.partitionBy(*keys).orderBy("start", "end", "gene")
    before = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(before.isNull() | (F.col("start") > before + 1), 1).otherwise(0)
    return regions.withColumn("_new", new).withColumn("cluster", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int")).drop("_new")


def resolve_tags(values: Column) -> tuple[Column, Column, Column]:
    """(gene, E or N, category) of a read's assigned names in order: its first exon's, else its first intron's without the mark."""
    named = F.filter(values, lambda x: F.coalesce(x != "", F.lit(False)))
    exon = F.try_element_at(F.filter(named, lambda x: ~F.contains(x, F.lit(INTRON))), F.lit(1))
    intron = F.substring_index(F.try_element_at(F.filter(named, lambda x: F.contains(x, F.lit(INTRON))), F.lit(1)), INTRON, 1)
    kind = F.when(exon.isNotNull(), "E").when(intron.isNotNull(), "N")
    return F.coalesce(exon, intron), kind, F.when(kind == "E", "Exon").when(kind == "N", "Intron")


def named(df: DataFrame, names: DataFrame, gene: str = "gene") -> DataFrame:
    """``df`` with ``gene_name`` by (gene, name), the gene itself where it has none."""
    of = names.groupBy(F.col("gene").alias(gene)).agg(F.first("name").alias("_name"))
    return df.join(of, gene, "left").withColumn("gene_name", F.coalesce("_name", gene)).drop("_name")
