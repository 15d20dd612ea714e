"""Text formats as DataFrames: FASTQ, GTF, SAM, whitelists, and Matrix Market bundles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.exprs import read_id


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """(file, no, line) with line numbers from 0 within each file, of files of any size, plain or gzipped.

    Files are read in splits, as Spark reads any text. A line's number is its place in its split and the number of lines
    of the splits before, which a first scan counts; only those counts are sorted as a whole.
    """
    split = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    rows = spark.read.text(path).select(*split, F.monotonically_increasing_id().alias("id"), F.col("value").alias("line"))
    sizes = spark.read.text(path).select(*split, F.monotonically_increasing_id().alias("id")).groupBy("file", "block").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("k"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("file", "block", (F.coalesce(F.sum("k").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return rows.join(sizes, ["file", "block"]).select("file", (F.col("id") + F.col("shift")).alias("no"), F.rtrim("line", F.lit("\r")).alias("line"))


def fastq(spark: SparkSession, path: str) -> DataFrame:
    """(file, rec_no, id, seq, qual) of plain or gzipped files of any size; broken records raise an error. Empty files have none."""
    lines = lines_of(spark, path)
    last = lines.groupBy("file").agg(F.max("no").alias("last"), F.max_by("line", "no").alias("end"))
    # One empty line at the end of a file is no record.
    rows = lines.join(last, "file").where((F.col("no") < F.col("last")) | (F.col("end") != "") | (F.col("no") % 4 != 0))
    rec = rows.groupBy("file", F.expr("no div 4").alias("rec_no")).agg(*[F.max(F.when(F.col("no") % 4 == i, F.col("line"))).alias(f"l{i}") for i in range(4)])
    part = lambda i: F.col(f"l{i}")
    fail = lambda cond, what: F.when(cond, F.raise_error(F.concat(F.lit(f"{what} "), (F.col("rec_no") + 1).cast("string"))))
    fine = F.coalesce(
        fail(part(3).isNull(), "Incomplete FASTQ record"), fail(~part(0).startswith("@") | ~part(2).startswith("+"), "Malformed FASTQ record"),
        fail(part(1) == "", "Empty sequence in FASTQ record"), fail(F.length(part(1)) != F.length(part(3)), "SEQ/QUAL length mismatch in FASTQ record"),
    ).cast("string")
    return rec.withColumn("_f", fine).where("_f IS NULL").select("file", "rec_no", read_id(part(0)).alias("id"), part(1).alias("seq"), part(3).alias("qual"))


def mates(first: DataFrame, second: DataFrame, pair: str = "pair_no") -> DataFrame:
    """Records of two mates by pair of files and number; a missing mate or another name raises an error.

    Records without the column ``pair`` are of one pair.
    """
    numbered = lambda df: df if pair in df.columns else df.withColumn(pair, F.lit(0))
    a, b = (numbered(df).select(pair, "rec_no", *[F.col(c).alias(f"{c}{i}") for c in ("id", "seq", "qual")]) for i, df in ((1, first), (2, second)))
    met = a.join(b, [pair, "rec_no"], "full_outer")
    bad = F.when(F.col("id1").isNull() | F.col("id2").isNull(), F.raise_error(F.concat(F.lit("mate count mismatch at record "), (F.col("rec_no") + 1).cast("string"))))
    named = F.when(F.col("id1") != F.col("id2"), F.raise_error(F.concat(F.lit("mate ID mismatch at record "), (F.col("rec_no") + 1).cast("string"))))
    return met.withColumn("_f", F.coalesce(bad, named).cast("string")).where("_f IS NULL").drop("_f")


def pairs(spark: SparkSession, listing: DataFrame) -> DataFrame:
    """``mates`` of the files (pair_no, read1, read2) of a run: all first and all second mates are one read each."""
    own = listing.select("pair_no", "read1", "read2").collect()  # a row a file
    plain = lambda c: F.regexp_replace(F.col(c), "^file:/+", "/")
    side = lambda c: fastq(spark, [r[c] for r in own]).withColumn("at", plain("file")).join(listing.select("pair_no", plain(c).alias("at")), "at")
    return mates(side("read1"), side("read2"))


def gtf(spark: SparkSession, path: str, feature: str = "exon") -> DataFrame:
    """(chrom, start, end, strand, gene_id, transcript_id, gene_name, line_no) of one feature; gene_name falls back to gene_id.

    ``line_no`` rises with the lines of the file, without being their number.
    """
    f = F.split("value", "\t")
    rows = spark.read.text(path).withColumn("line_no", F.monotonically_increasing_id()).where(~F.col("value").startswith("#") & (F.size(f) >= 9))
    attr = lambda k: F.nullif(F.regexp_extract(f[8], rf'(?:^|[;\s]){k}\s+"?([^";]+)"?', 1), F.lit(""))
    out = rows.where(f[2] == feature).select(f[0].alias("chrom"), f[3].cast("long").alias("start"), f[4].cast("long").alias("end"), f[6].alias("strand"), attr("gene_id").alias("gene_id"), attr("transcript_id").alias("transcript_id"), attr("gene_name").alias("gene_name"), "line_no")
    return out.withColumn("gene_name", F.coalesce("gene_name", "gene_id"))


def sam(spark: SparkSession, path: str, tags: Sequence[str] = ("CB", "CR", "UR", "GX", "RE", "SR")) -> DataFrame:
    """Alignments of SAM text with ``tags``, whatever their types, as columns of text; ``pos`` is 0-based."""
    f = F.split("value", "\t")
    rows = spark.read.text(path).where(~F.col("value").startswith("@"))
    tag = lambda t: F.nullif(F.regexp_extract("value", rf"\t{t}:[A-Za-z]:([^\t]*)", 1), F.lit(""))
    return rows.select(f[0].alias("qname"), f[1].cast("int").alias("flag"), f[2].alias("rname"), (f[3].cast("long") - 1).alias("pos"), f[5].alias("cigar"), f[9].alias("seq"), f[10].alias("qual"), *[tag(t).alias(t) for t in tags])


def contigs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).where(F.col("value").startswith("@SQ")).select(F.regexp_extract("value", r"\tSN:([^\t]+)", 1).alias("rname"))


def word_list(spark: SparkSession, path: str) -> DataFrame:
    """(barcode): distinct upper-cased entries between commas and white space."""
    return spark.read.text(path).select(F.explode(F.split(F.upper("value"), r"[,\s]+")).alias("barcode")).where("barcode <> ''").distinct()


def coordinate_sorted(df: DataFrame, parts: int) -> DataFrame:
    """Records by contig and position: ranges over tasks, sorted within."""
    return df.repartitionByRange(parts, "rname", "pos").sortWithinPartitions("rname", "pos", "qname")


def numbered_first(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first record of each key."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(order))).where("_r = 1").drop("_r")
