"""Read and UMI matrices, UMI clustering, and what is derived from them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exprs as E


def eligible(reads: DataFrame, wells: DataFrame, genes: DataFrame, introns: bool = True) -> DataFrame:
    """Reads that count: representative, mapped, of an expected well and a known gene, exonic (also where unsaid) or intronic."""
    kinds = ["E", "N"] if introns else ["E"]
    rows = reads.withColumn("re", F.coalesce("re", F.lit("E"))).where(F.col("re").isin(kinds) & E.is_representative(F.col("flag")) & E.is_mapped(F.col("flag")))
    return rows.join(wells.select("well").distinct(), "well", "left_semi").join(genes.select("gene").distinct(), "gene", "left_semi")


def read_matrix(reads: DataFrame) -> DataFrame:
    """(well, gene, ftype, n)."""
    return reads.groupBy("well", "gene", F.when(F.col("re") == "N", "intron").otherwise("exon").alias("ftype")).agg(F.count(F.lit(1)).alias("n"))


def both_types(matrix: DataFrame) -> DataFrame:
    """The matrix and, as ``inex``, its sum over types: one shuffle of grouping sets."""
    return matrix.rollup("well", "gene", "ftype").agg(F.sum("n").cast("long").alias("n"), F.grouping_id().alias("_g")).where("_g < 2").select("well", "gene", F.coalesce("ftype", F.lit("inex")).alias("ftype"), "n")


def umi_counts(reads: DataFrame) -> DataFrame:
    """(well, gene, ftype, umi, n)."""
    return reads.groupBy("well", "gene", F.when(F.col("re") == "N", "intron").otherwise("exon").alias("ftype"), "umi").agg(F.count(F.lit(1)).alias("n"))


def _stars(keys: int, threshold: int):
    """Streams rows (keys, umi, carried columns), sorted by keys, falling count and UMI, and adds each UMI's parent.

    A centre leaves its texts with ``threshold`` letters blanked; a later UMI of its length within that many
    substitutions has one of them too. So a UMI costs its blanked texts, however many centres there are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, first, centres = None, {}, []
        blanks: dict[int, list[tuple[int, ...]]] = {}
        for batch in batches:
            groups = list(zip(*(batch.column(i).to_pylist() for i in range(keys))))
            out = []
            for group, umi in zip(groups, batch.column(keys).to_pylist()):
                if group != at:
                    at, first, centres = group, {}, []
                places = blanks.get(len(umi))
                if places is None:
                    places = blanks[len(umi)] = list(combinations(range(len(umi)), min(threshold, len(umi))))
                masks = []
                for own in places:
                    m, begin = "", 0
                    for i in own:
                        m += umi[begin:i] + "*"
                        begin = i + 1
                    masks.append(m + umi[begin:])
                near = min((first[m] for m in masks if m in first), default=None)
                if near is None:
                    for m in masks:
                        first.setdefault(m, len(centres))
                    centres.append(umi)
                    out.append(umi)
                else:
                    out.append(centres[near])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=[*batch.schema.names, "parent"])

    return run


def clustered(rows: DataFrame, keys: Sequence[str], threshold: int = 1, n: str = "n") -> DataFrame:
    """``rows`` (keys, umi, n, more), one a UMI, with ``parent``: greedy stars in the order of falling count, then UMI.

    A UMI within ``threshold`` substitutions of an earlier centre joins the first such centre, else becomes one; joined
    UMIs attract none. Groups are dealt by their keys, sorted, and streamed: none is held as a row or an array.
    """
    if threshold <= 0:
        return rows.withColumn("parent", F.col("umi"))
    more = [c for c in rows.columns if c not in (*keys, "umi")]
    dealt = rows.select(*keys, "umi", *more).where("umi IS NOT NULL").repartition(*keys).sortWithinPartitions(*keys, F.desc(n), "umi")
    return dealt.mapInArrow(_stars(len(keys), threshold), T.StructType([*dealt.schema.fields, T.StructField("parent", T.StringType())]))


def cluster(counts: DataFrame, keys: Sequence[str], threshold: int = 1) -> DataFrame:
    """(keys, umi, parent) of counts by UMI, added up over types: ``clustered``."""
    rows = counts.groupBy(*keys, "umi").agg(F.sum("n").alias("n"))
    return clustered(rows, keys, threshold).select(*keys, "umi", "parent")


def umi_types(reads: DataFrame) -> DataFrame:
    """(well, gene, umi, n, exon, intron): reads of each UMI of both types, and whether it has the type."""
    inner = F.col("re") == "N"
    return reads.groupBy("well", "gene", "umi").agg(F.count(F.lit(1)).alias("n"), F.max(~inner).alias("exon"), F.max(inner).alias("intron"))


def umi_matrix(parents: DataFrame) -> DataFrame:
    """(well, gene, ftype, n) of distinct parents from ``umi_types`` clustered jointly; ``inex`` is the union of both types."""
    each = parents.groupBy("well", "gene", "parent").agg(F.max("exon").alias("exon"), F.max("intron").alias("intron"))
    n = lambda c: F.count(F.when(F.col(c), 1)) if c else F.count(F.lit(1))
    wide = each.groupBy("well", "gene").agg(n("exon").alias("exon"), n("intron").alias("intron"), n("").alias("inex"))
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("ftype"), F.col(k).alias("n")) for k in ("exon", "intron", "inex")]))
    return wide.select("well", "gene", kinds.alias("k")).select("well", "gene", "k.ftype", "k.n").where("n > 0")


def corrected(reads: DataFrame, parents: DataFrame) -> DataFrame:
    """Reads with ``ub``: the parent, the UMI itself where it has none, null for genes without any parent."""
    met = reads.join(parents, ["well", "gene", "umi"], "left")
    known = parents.select("well", "gene").distinct().withColumn("_known", F.lit(True))
    return met.join(known, ["well", "gene"], "left").withColumn("ub", F.when(F.col("_known"), F.coalesce("parent", "umi"))).drop("parent", "_known")


def frequency(parents: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(reads, freq): how many corrected UMIs have how many reads, of rows (keys, parent, n)."""
    per = parents.groupBy(*keys, "parent").agg(F.sum("n").cast("long").alias("reads"))
    return per.groupBy("reads").agg(F.count(F.lit(1)).alias("freq"))


def cell_summary(matrix: DataFrame) -> DataFrame:
    """(well, ftype, total, genes): sums and positive genes; inex adds the totals and joins the gene sets."""
    pos = matrix.where("n > 0")
    each = pos.groupBy("well", "ftype").agg(F.sum("n").cast("long").alias("total"), F.count_distinct("gene").alias("genes"))
    both = pos.groupBy("well").agg(F.sum("n").cast("long").alias("total"), F.count_distinct("gene").alias("genes"))
    return each.unionByName(both.select("well", F.lit("inex").alias("ftype"), "total", "genes"))


#: The fractions of a saturation curve.
FRACTIONS = (0.0, 0.01, 0.02, 0.05, 0.08, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)


def _fractions(df: DataFrame) -> DataFrame:
    return df.withColumn("p", F.explode(F.array(*[F.lit(p) for p in FRACTIONS])))


def saturation(hist: DataFrame) -> DataFrame:
    """(p, saturation): one less distinct over reads expected in a sample of share p, in closed form; 0 at 0."""
    rows = _fractions(hist).groupBy("p").agg(F.sum(F.col("freq") * (1 - F.pow(1 - F.col("p"), F.col("reads")))).alias("seen"), F.sum(F.col("freq") * F.col("reads")).alias("all"))
    return rows.select("p", F.when(F.col("p") == 0, 0.0).otherwise(1 - F.try_divide("seen", F.col("p") * F.col("all"))).alias("saturation"))


def median_genes(matrix: DataFrame) -> DataFrame:
    """(p, median_genes): over wells with any count, of the genes expected in a sample of share p."""
    per = _fractions(matrix.where("n > 0")).groupBy("p", "well").agg(F.sum(1 - F.pow(1 - F.col("p"), F.col("n"))).alias("genes"))
    return per.groupBy("p").agg(F.median(F.round("genes", 9)).alias("median_genes"))


def normalise(matrix: DataFrame) -> DataFrame:
    """(gene, sample, norm): counts over the sample's median ratio to the genes' geometric means (genes in all samples)."""
    samples = matrix.agg(F.count_distinct("sample").alias("k"))
    pos = matrix.where("n > 0")
    mean = pos.groupBy("gene").agg(F.avg(F.ln("n")).alias("m"), F.count(F.lit(1)).alias("k")).join(F.broadcast(samples), "k").drop("k")
    size = pos.join(mean, "gene").groupBy("sample").agg(F.exp(F.median(F.ln("n") - F.col("m"))).alias("f"))
    return matrix.join(size, "sample").select("gene", "sample", (F.col("n") / F.col("f")).alias("norm"))


def fold_changes(norm: DataFrame, groups: DataFrame, first: str, second: str, pseudo: float = 0.5) -> DataFrame:
    """(gene, mean_first, mean_second, log2fc) of normalised counts by sample group: the descriptive comparison.

    A sample of either group without counts raises an error.
    """
    have = norm.select("sample").distinct().withColumn("_have", F.lit(True))
    met = groups.where(F.col("grp").isin(first, second)).join(have, "sample", "left")
    bad = F.when(F.col("_have").isNull(), F.raise_error(F.concat(F.lit("sample without counts: "), "sample"))).cast("string")
    groups = met.where(F.coalesce(bad, F.lit("")) == "").select("sample", "grp")
    mean = lambda g: F.avg(F.when(F.col("grp") == g, F.col("norm")))
    rows = norm.join(groups, "sample").groupBy("gene").agg(mean(first).alias("mean_first"), mean(second).alias("mean_second"))
    return rows.withColumn("log2fc", F.log2((F.col("mean_second") + pseudo) / (F.col("mean_first") + pseudo)))


def ordered_changes(changes: DataFrame) -> DataFrame:
    """Most significant first where there is ``padj`` (nulls last), else the largest change either way; then gene."""
    if "padj" in changes.columns:
        return changes.orderBy(F.col("padj").asc_nulls_last(), "gene")
    return changes.orderBy(F.abs("log2fc").desc_nulls_last(), "gene")
