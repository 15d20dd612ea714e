"""Assignment of aligned blocks to genes, and gene-body coverage. Intervals are closed and 1-based."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranges import overlap_join
from . import intervals as I


def introns(exons: DataFrame, shortest: int = 10, longest: int = 100_000) -> DataFrame:
    """(chrom, strand, gene, start, end): gaps between a gene's merged exons, where no other gene's body lies.

    Bounds on the length are exclusive. ``exons`` has (chrom, strand, gene, start, end).
    """
    locus = ["chrom", "strand"]
    merged = I.merge(exons, [*locus, "gene"])
    bodies = exons.groupBy(*locus, "gene").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    numbered = bodies.withColumn("no", F.row_number().over(Window.partitionBy(*locus).orderBy("gene")))
    alone = I.single_cover(numbered, locus, "no").join(numbered.select(*locus, "no", "gene"), [*locus, "no"])
    # Gaps are those of all exons of the locus, so that another gene's exon ends an intron.
    holes = I.gaps(I.merge(merged, locus), locus)
    met = overlap_join(holes, alone.withColumnsRenamed({"start": "s", "end": "e"}), locus, "start", "end", "s", "e", 10_000)
    out = met.select(*locus, "gene", F.greatest("start", "s").alias("start"), F.least("end", "e").alias("end"))
    size = F.col("end") - F.col("start") + 1
    return out.where((size > shortest) & (size < longest))


def best_gene(reads: DataFrame, features: DataFrame, strand: int = 0, size: int = 1000) -> DataFrame:
    """(qname, gene, overlap, ties): the gene with the largest summed overlap of a read's blocks; several if they tie.

    ``strand``: 0 any, 1 the read's, 2 the opposite.
    """
    met = overlap_join(reads.select("qname", "chrom", F.col("strand").alias("rs"), "b_start", "b_end"), features.select("chrom", "strand", "gene", "start", "end"), ["chrom"], "b_start", "b_end", "start", "end", size)
    if strand:
        met = met.where((F.col("strand") == F.col("rs")) if strand == 1 else (F.col("strand") != F.col("rs")))
    per = met.groupBy("qname", "gene").agg(F.sum("overlap").cast("long").alias("overlap"))
    w = Window.partitionBy("qname")
    top = per.withColumn("_r", F.rank().over(w.orderBy(F.desc("overlap")))).where("_r = 1").drop("_r")
    return top.withColumn("ties", F.count(F.lit(1)).over(w))


def assign(reads: DataFrame, exons: DataFrame, inner: DataFrame, strand: int = 0, size: int = 1000) -> DataFrame:
    """(qname, gene, category): exons first, introns for what has none; ties are Ambiguity, nothing is Intergenic.

    Exons and introns are met in one overlap join and told apart by a rank; one shuffle by read settles the rest.
    """
    features = exons.select("chrom", "strand", "gene", "start", "end", F.lit(1).alias("rank")).unionByName(inner.select("chrom", "strand", "gene", "start", "end", F.lit(0).alias("rank")))
    met = overlap_join(reads.select("qname", "chrom", F.col("strand").alias("rs"), "b_start", "b_end"), features, ["chrom"], "b_start", "b_end", "start", "end", size)
    if strand:
        met = met.where((F.col("strand") == F.col("rs")) if strand == 1 else (F.col("strand") != F.col("rs")))
    rows = met.select("qname", "gene", "rank", "overlap").unionByName(reads.select("qname", F.lit(None).cast("string").alias("gene"), F.lit(-1).alias("rank"), F.lit(0).cast("long").alias("overlap")))
    per = rows.repartition("qname").groupBy("qname", "rank", "gene").agg(F.sum("overlap").alias("overlap"))
    # Rank and overlap as one number; genes tie if the last and the first of those with the best one differ.
    best = F.col("rank") * F.lit(1 << 40) + F.col("overlap")
    every = per.groupBy("qname").agg(F.max(F.struct(best.alias("s"), "gene")).alias("top"), F.min(F.struct((-best).alias("s"), "gene")).alias("other"))
    tied, score = F.col("top.gene") != F.col("other.gene"), F.col("top.s")
    category = F.when(score < 0, "Intergenic").when(tied, "Ambiguity").when(score >= 1 << 40, "Exon").otherwise("Intron")
    return every.select("qname", F.when(~tied, F.col("top.gene")).alias("gene"), category.alias("category"))


def gene_models(exons: DataFrame, shortest: int = 100) -> DataFrame:
    """(gene, chrom, strand, tx, start, end, before, length): merged exons of each gene's longest transcript (ties: largest id).

    ``before`` counts the transcript's bases ahead of the exon, in the direction of its strand.
    """
    merged = I.merge(exons, ["chrom", "strand", "gene", "tx"])
    width = F.col("end") - F.col("start") + 1
    size = merged.groupBy("gene", "tx").agg(F.sum(width).cast("long").alias("length")).where(F.col("length") >= shortest)
    best = size.groupBy("gene").agg(F.max(F.struct("length", "tx")).alias("b")).select("gene", "b.tx", "b.length")
    w = Window.partitionBy("gene", "tx").orderBy(F.when(F.col("strand") == "-", -F.col("start")).otherwise(F.col("start")))
    before = F.coalesce(F.sum(width).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")
    return merged.join(best, ["gene", "tx"]).withColumn("before", before)


def gene_body_coverage(reads: DataFrame, models: DataFrame, bins: int = 100) -> DataFrame:
    """(source, bin, coverage): reads spread over equal parts of their gene's transcript; reads of a tie are left out.

    An interval adds its overlap over the part's length to every part that it meets.
    """
    top = best_gene(reads, models).where("ties = 1").select("qname", "gene")
    own = models.select("gene", F.col("chrom").alias("m_chrom"), F.col("strand").alias("m_strand"), "start", "end", "before", "length")
    met = reads.join(top, "qname").join(own, "gene").where("chrom = m_chrom AND b_start <= end AND start <= b_end")
    s, e = F.greatest("b_start", "start"), F.least("b_end", "end")
    t0 = F.col("before") + F.when(F.col("m_strand") == "-", F.col("end") - e).otherwise(s - F.col("start"))
    part = met.select("source", "length", t0.alias("t0"), (t0 + e - s).alias("t1"))
    first, last = F.expr(f"(t0 * {bins}) div length"), F.least(F.lit(bins - 1), F.expr(f"(t1 * {bins}) div length + 1"))
    rows = part.withColumn("bin", F.explode(F.sequence(first, last)))
    lo, hi = F.expr(f"(bin * length) div {bins}"), F.expr(f"((bin + 1) * length) div {bins}")
    inside = F.least(F.col("t1") + 1, hi) - F.greatest(F.col("t0"), lo)
    rows = rows.withColumn("w", F.when(inside > 0, inside / (hi - lo))).where("w IS NOT NULL")
    return rows.groupBy("source", F.col("bin").cast("int").alias("bin")).agg(F.sum("w").alias("coverage"))


def reads_of_genes(reads: DataFrame, regions: DataFrame, size: int = 100_000) -> DataFrame:
    """Reads (qname, gene, b_start, b_end) that overlap their own gene's region (gene, start, end)."""
    return overlap_join(reads, regions.select("gene", "start", "end"), ["gene"], "b_start", "b_end", "start", "end", size).drop("start", "end", "overlap")


def nearest_exon(exons: DataFrame) -> DataFrame:
    """Merged exons of a locus with ``gap`` to the next one downstream (null: none), for extending 3' ends."""
    merged = I.merge(exons, ["chrom", "strand"])
    w = Window.partitionBy("chrom", "strand").orderBy("start")
    plus, minus = F.lead("start").over(w) - F.col("end") - 1, F.col("start") - F.lag("end").over(w) - 1
    return merged.withColumn("gap", F.when(F.col("strand") == "-", minus).otherwise(plus))


def extension(gap, reach: int = 100, buffer: int = 10):
    """How far a 3' end is extended: all the way without a neighbour in reach, not at all next to one."""
    return F.when(gap.isNull() | (gap > reach + buffer), F.lit(reach)).when(gap <= buffer, F.lit(0)).otherwise(gap - buffer)
