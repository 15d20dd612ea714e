"""Molecules: consensus bases, transcript compatibility and quantification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bases in the order that ties are resolved.
BASES = ("A", "T", "C", "G")
MOST_QUALITY = 93


def consensus(bases: DataFrame) -> DataFrame:
    """(molecule, pos, base, qual) from (molecule, pos, base, qual): the base of highest posterior, N up to 0.3.

    Log-likelihoods count to nine digits: what is left of a sum beyond that depends on the order of the reads and would
    decide between bases that are equally likely.
    """
    error = F.pow(F.lit(10.0), -F.least(F.greatest("qual", F.lit(1)), F.lit(MOST_QUALITY)) / 10.0)
    like = [F.round(F.sum(F.when(F.col("base") == b, F.ln(1 - error)).otherwise(F.ln(error / 3))), 9).alias(f"l{b}") for b in BASES]
    sums = bases.where(F.col("base").isin(*BASES)).groupBy("molecule", "pos").agg(*like)
    top = F.greatest(*[f"l{b}" for b in BASES])
    p = 1 / sum((F.exp(F.col(f"l{b}") - top) for b in BASES[1:]), F.exp(F.col("lA") - top))
    best = F.coalesce(*[F.when(F.col(f"l{b}") == top, F.lit(b)) for b in BASES])
    phred = F.greatest(F.lit(0), F.least(F.lit(MOST_QUALITY), F.round(-10 * F.log10(1 - p + 1e-13)))).cast("int")
    out = sums.withColumns({"_p": p, "_b": best})
    return out.select("molecule", "pos", F.when(F.col("_p") <= 0.3, "N").otherwise(F.col("_b")).alias("base"), phred.alias("qual"))


def molecules(reads: DataFrame, paired: bool = False) -> DataFrame:
    """(well, gene, umi, reads, exonic, intronic, strand): distinct read names; strand by majority, ties reverse.

    ``paired``: ``first`` marks records of read 1, which alone settle the strand; molecules without any are dropped.
    Records are dealt by molecule once; names and molecules are then added up in place.
    """
    of = ["well", "gene", "umi"]
    votes = F.col("first") if paired else F.lit(True)
    n = lambda c: F.count(F.when(F.col(c) if isinstance(c, str) else c, 1))
    dealt = reads.select(*of, "qname", "re", "strand", votes.alias("votes")).repartition(*of)
    names = dealt.groupBy(*of, "qname").agg(F.max(F.col("re") == "E").alias("e"), F.max(F.col("re") == "N").alias("i"), n(F.col("votes") & (F.col("strand") == "+")).alias("forward"), n("votes").alias("votes"))
    out = names.groupBy(*of).agg(
        F.count(F.lit(1)).alias("reads"), n("e").alias("exonic"), n("i").alias("intronic"),
        F.when(F.sum("forward") * 2 > F.sum("votes"), "+").otherwise("-").alias("strand"), F.sum("votes").alias("_v"),
    )
    return out.where("_v > 0").drop("_v")


def _division(blocks: DataFrame, segments: DataFrame, least: int, size: int) -> DataFrame:
    """(molecule, k, txs): the number of segments that a molecule overlaps by ``least`` bases, and the transcripts in all of them.

    Relational division: a transcript stays if it is in as many matched segments as there are. A segment is an index
    entry, all intervals of a gene with the same transcripts.
    """
    from ..functions.ranges import overlap_join

    met = overlap_join(blocks, segments, ["gene"], "b_start", "b_end", "start", "end", size)
    hit = met.groupBy("molecule", "gene", "members").agg(F.sum("overlap").alias("o")).where(F.col("o") >= least)
    per = hit.groupBy("molecule").agg(F.count(F.lit(1)).alias("k"))
    each = hit.select("molecule", F.explode("members").alias("tx")).groupBy("molecule", "tx").agg(F.count(F.lit(1)).alias("k"))
    return per.join(each, ["molecule", "k"], "left").groupBy("molecule").agg(F.collect_set("tx").alias("txs"))


def compatible(molecule_blocks: DataFrame, segments: DataFrame, skipped: DataFrame | None = None, junctions: DataFrame | None = None, least: int = 5, size: int = 1000) -> DataFrame:
    """(molecule, transcripts): transcripts that hold every entry a molecule overlaps by ``least`` bases; none: null.

    ``molecule_blocks`` and ``skipped`` (molecule, gene, b_start, b_end) are what a molecule covers and leaves out,
    ``segments`` and ``junctions`` (gene, members, start, end) the entries of exons and of introns. Where both meet
    entries a transcript has to be in the answers of both.
    """
    exonic = _division(molecule_blocks, segments, least, size)
    if skipped is not None and junctions is not None:
        inner = _division(skipped, junctions, least, size).withColumnRenamed("txs", "inner")
        met = exonic.join(inner, "molecule", "full_outer")
        exonic = met.select("molecule", F.when(F.col("txs").isNull(), F.col("inner")).when(F.col("inner").isNull(), F.col("txs")).otherwise(F.array_intersect("txs", "inner")).alias("txs"))
    return exonic.select("molecule", F.when(F.size("txs") > 0, F.sort_array("txs")).alias("transcripts"))


def quantify(rows: DataFrame) -> DataFrame:
    """(well, tx, unique_molecules, fractional, reads) from (well, transcripts, reads)."""
    k = F.size("transcripts")
    each = rows.where(F.col("transcripts").isNotNull()).select("well", F.explode("transcripts").alias("tx"), k.alias("k"), "reads")
    return each.groupBy("well", "tx").agg(F.count(F.when(F.col("k") == 1, 1)).alias("unique_molecules"), F.sum(1.0 / F.col("k")).alias("fractional"), F.sum("reads").cast("long").alias("total_reads"))


def assigned_gene(ge: Column, gi: Column, gx: Column, re: Column) -> tuple[Column, Column, Column]:
    """(gene, exonic, intronic) of a read's tags: GE, else GX where RE is E; GI, else GX where RE is N; no gene if they differ."""
    exon = F.coalesce(ge, F.when(re == "E", gx))
    intron = F.coalesce(gi, F.when(re == "N", gx))
    gene = F.when(exon.isNotNull() & intron.isNotNull() & (exon != intron), F.lit(None)).otherwise(F.coalesce(exon, intron))
    return gene, exon.isNotNull(), intron.isNotNull()
