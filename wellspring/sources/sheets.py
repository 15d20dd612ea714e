"""Files that describe a run: FASTQ pairs, samplesheets, barcode tables, lists and statistics of earlier steps.

Paths go through Spark's file systems; what is read is a DataFrame. Rows that break a rule raise an error when they are
evaluated, so that a check costs no pass of its own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import exprs as E

#: What marks a file of first mates, and the second mate's form of it; endings of FASTQ files.
MATES = (("_R1", "_R2"), (".R1", ".R2"), ("_1.", "_2."), (".1.", ".2."))
ENDINGS = (".fastq.gz", ".fq.gz", ".fastq", ".fq")


def _fail(cond: Column, *message: Column | str) -> Column:
    """Null, or an error where ``cond`` holds."""
    return F.when(cond, F.raise_error(F.concat(*[F.lit(m) if isinstance(m, str) else m.cast("string") for m in message]))).cast("string")


def _checked(df: DataFrame, *fails: Column) -> DataFrame:
    """``df`` once none of the checks has failed; the checks are part of the filter, so no plan leaves them out."""
    return df.where(F.coalesce(*fails, F.lit("")) == "")


def files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, name, size) of a folder's files, by Spark's file system for the folder."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    listed = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(where)
    rows = [(str(f.getPath().toString()), str(f.getPath().getName()), int(f.getLen())) for f in listed if f.isFile()]
    return spark.createDataFrame(rows, "path string, name string, size long")


def fastq_pairs(listing: DataFrame) -> DataFrame:
    """(pair_no, read1, read2, size) of (path, name, size): first mates with their second, in order of the first's path.

    The first mark that gives a file of the folder counts. A first mate without a second raises an error.
    """
    own = listing.where(F.regexp_like("name", F.lit("(" + "|".join(e.replace(".", r"\.") for e in ENDINGS) + ")$")))
    first = own.where(" OR ".join(f"contains(name, '{a}')" for a, _ in MATES)).select(F.col("path").alias("read1"), "name", F.col("size").alias("size1"))
    at = lambda a: F.instr("name", a)
    guess = F.array(*[F.struct(F.lit(i).alias("i"), F.when(at(a) > 0, F.overlay("name", F.lit(b), at(a), F.lit(len(a)))).alias("name")) for i, (a, b) in enumerate(MATES)])
    tried = first.withColumn("g", F.explode(guess)).where("g.name IS NOT NULL").select("read1", "size1", "g.i", F.col("g.name").alias("name"))
    met = tried.join(own.select("name", F.col("path").alias("read2"), F.col("size").alias("size2")), "name", "left")
    best = met.groupBy("read1", "size1").agg(F.min_by(F.struct("read2", "size2"), F.when(F.col("read2").isNotNull(), F.col("i"))).alias("b"))
    best = best.select("read1", F.col("b.read2").alias("read2"), (F.col("size1") + F.coalesce("b.size2", F.lit(0))).alias("size"))
    best = _checked(best, _fail(F.col("read2").isNull(), "missing second mate of ", F.col("read1")))
    return best.withColumn("pair_no", F.row_number().over(Window.orderBy("read1")) - 1)  # a row a file


def grouped_files(entries: Mapping[str, str] | Sequence[str]) -> list[tuple[str, ...]]:
    """Pairs of files from comma-separated lists by mate, keyed by a name with a number or in order; lists must be of one length."""
    number = lambda k: int("".join(c for c in str(k) if c.isdigit()) or 0)
    lists = [entries[k] for k in sorted(entries, key=number)] if isinstance(entries, Mapping) else list(entries)
    split = [[x.strip() for x in str(e).split(",") if x.strip()] for e in lists]
    if len({len(s) for s in split}) > 1:
        raise ValueError(f"FASTQ counts of the mates differ: {[len(s) for s in split]}")
    return list(zip(*split))


def read_lengths(records: DataFrame) -> DataFrame:
    """(pair_no, len1, len2): lengths of each pair's first record; an empty one raises an error."""
    first = records.groupBy("pair_no").agg(F.min_by(F.struct(F.length("seq1").alias("a"), F.length("seq2").alias("b")), "rec_no").alias("l"))
    out = first.select("pair_no", F.col("l.a").alias("len1"), F.col("l.b").alias("len2"))
    return _checked(out, _fail((F.col("len1") == 0) | (F.col("len2") == 0), "empty sequence in pair ", F.col("pair_no")))


def samplesheet(spark: SparkSession, path: str, folder: str = "") -> DataFrame:
    """(read1, read2, barcode) of a CSV with these columns; relative paths are the folder's, barcodes upper-cased.

    An absent column, an empty barcode, a repeated pair and a sheet without rows raise errors.
    """
    rows = spark.read.option("header", True).csv(path)
    if absent := {"read1", "read2", "barcode"} - set(rows.columns):
        raise ValueError(f"samplesheet lacks {', '.join(sorted(absent))}")
    at = lambda c: F.when(F.trim(c).rlike("^(/|[a-z0-9]+:)"), F.trim(c)).otherwise(F.concat(F.lit(folder.rstrip("/") + "/" if folder else ""), F.trim(c)))
    own = rows.select(at("read1").alias("read1"), at("read2").alias("read2"), F.upper(F.trim(F.coalesce("barcode", F.lit("")))).alias("barcode"))
    if own.isEmpty():
        raise ValueError(f"samplesheet has no rows: {path}")
    own = own.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("read1", "read2")))
    return _checked(own, _fail(F.col("barcode") == "", "empty barcode for ", F.col("read1")), _fail(F.col("_n") > 1, "repeated pair ", F.col("read1"))).drop("_n")


def expected_table(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, wellID, kind, at, barcode) of a table of wells with their UMI and internal barcodes; a heading is skipped."""
    p = F.split("value", "\t")
    lines = numbered_lines(spark, path).where((F.size(p) >= 3) & (F.lower(F.ltrim(p[0], F.lit("﻿"))) != "wellid"))
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), p[i].alias("l")) for i, k in ((1, "umi"), (2, "internal"))])
    each = lines.select("line_no", p[0].alias("wellID"), F.explode(kinds).alias("k"))
    out = each.select("line_no", "wellID", "k.kind", F.posexplode(F.split("k.l", ",")).alias("at", "barcode"))
    return out.withColumn("barcode", F.upper(F.trim("barcode"))).where("barcode <> ''")


def wells_of(expected: DataFrame, kept: DataFrame | None = None) -> DataFrame:
    """(well, no): distinct wells in natural order; where there is none, the kept barcodes in theirs."""
    own = expected.select(F.upper(F.trim("wellID")).alias("well")).distinct()
    if kept is not None:
        own = own.unionByName(kept.select(F.col("barcode").alias("well")).distinct().join(own.agg(F.count(F.lit(1)).alias("k")), F.col("k") == 0).drop("k"))
    return own.withColumn("no", F.row_number().over(Window.orderBy(E.natural_key(F.col("well")), "well")))  # a row a well


def custom_table(spark: SparkSession, path: str) -> DataFrame:
    """``expected_table`` with upper-cased wells under the rules for tables of one's own.

    Each line needs three columns, a well and a barcode; a barcode belongs to one well and kind.
    """
    p = F.split("value", "\t")
    lines = numbered_lines(spark, path).where((F.trim("value") != "") & (F.lower(F.trim(F.ltrim(p[0], F.lit("﻿")))) != "wellid"))
    bare = F.coalesce(F.regexp_replace(F.concat(p[1], p[2]), r"[,\s]", ""), F.lit(""))
    good = _checked(lines, _fail(F.size(p) < 3, "too few columns in line ", F.col("line_no")), _fail(F.trim(p[0]) == "", "empty well in line ", F.col("line_no")), _fail(bare == "", "no barcode in line ", F.col("line_no")))
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), p[i].alias("l")) for i, k in ((1, "umi"), (2, "internal"))])
    each = good.select("line_no", F.upper(F.trim(p[0])).alias("wellID"), F.explode(kinds).alias("k"))
    out = each.select("line_no", "wellID", "k.kind", F.posexplode(F.split("k.l", ",")).alias("at", "barcode"))
    return owned_once(out.withColumn("barcode", F.upper(F.trim("barcode"))).where("barcode <> ''"))


def owned_once(expected: DataFrame) -> DataFrame:
    """Raises an error for a barcode of two wells or kinds."""
    w = Window.partitionBy("barcode")
    owner = F.struct("wellID", "kind")
    out = expected.withColumns({"_a": F.min(owner).over(w), "_b": F.max(owner).over(w)})
    return _checked(out, _fail(F.col("_a") != F.col("_b"), "barcode ", F.col("barcode"), " belongs to ", F.col("_a.wellID"), " and ", F.col("_b.wellID"))).drop("_a", "_b")


def resolve_samplesheet(sheet: DataFrame, expected: DataFrame, discover: bool = False) -> DataFrame:
    """The sheet with wellID and kind of its barcodes; an unknown barcode raises an error. ``discover`` leaves them open."""
    if discover:
        return sheet
    known = owned_once(expected).groupBy("barcode").agg(F.first("wellID").alias("wellID"), F.first("kind").alias("kind"))
    met = sheet.join(known, "barcode", "left")
    return _checked(met, _fail(F.col("wellID").isNull(), "barcode not expected: ", F.col("barcode")))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, value) of a small file, read as one text."""
    text = spark.read.text(path, wholetext=True).select(F.posexplode(F.split(F.regexp_replace("value", r"\r?\n\z", ""), r"\r?\n")).alias("line_no", "value"))
    return text.select((F.col("line_no") + 1).alias("line_no"), "value")


def binning_map(spark: SparkSession, path: str) -> DataFrame:
    """(falseBC, trueBC) of a CSV or TSV with these two columns in either order after its heading; the last line of a barcode counts."""
    p = F.split("value", "[,\t]")
    lines = numbered_lines(spark, path)
    head = lines.where("line_no = 1").select(F.array_position(p, "falseBC").alias("f"), F.array_position(p, "trueBC").alias("t"))
    rows = lines.where("line_no > 1").join(F.broadcast(head.where("f > 0 AND t > 0")))  # one row
    out = rows.select("line_no", F.upper(F.trim(F.try_element_at(p, F.col("f").cast("int")))).alias("falseBC"), F.upper(F.trim(F.try_element_at(p, F.col("t").cast("int")))).alias("trueBC"))
    return out.where("falseBC <> '' AND trueBC <> ''").groupBy("falseBC").agg(F.max_by("trueBC", "line_no").alias("trueBC"))


def id_map(expected: DataFrame) -> DataFrame:
    """(barcode, wellID, kind): the last assignment of a barcode counts, internal ones after UMI ones of their line."""
    order = F.struct("line_no", (F.col("kind") == "internal").alias("late"), "at")
    last = expected.groupBy("barcode").agg(F.max_by(F.struct("wellID", "kind"), order).alias("o"))
    return last.select("barcode", "o.wellID", "o.kind")


def barcode_counts(spark: SparkSession, path: str) -> DataFrame:
    """(XC, n): counts by upper-cased barcode, added up; lines without a whole number are skipped."""
    p = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(path).where(F.size(p) >= 2).select(F.upper(p[0]).alias("XC"), F.expr(r"try_cast(split(trim(value), '\\s+')[1] AS bigint)").alias("n"))
    return rows.where("n IS NOT NULL").groupBy("XC").agg(F.sum("n").cast("long").alias("n"))


def mapped_reads(spark: SparkSession, path: str) -> DataFrame:
    """One row (mapped) of a summary of statuses: all reads but the unmapped; lines without a number are skipped."""
    p = F.split("value", "\t")
    rows = spark.read.text(path).where((F.size(p) >= 2) & F.trim(p[1]).rlike(r"^\d+$")).select(p[0].alias("status"), F.trim(p[1]).cast("long").alias("n"))
    unmapped = F.coalesce(F.sum(F.when(F.col("status") == "Unassigned_Unmapped", F.col("n"))), F.lit(0))
    return rows.agg(F.greatest(F.lit(0), F.sum("n") - unmapped).cast("long").alias("mapped")).where("mapped IS NOT NULL")


def names(spark: SparkSession, path: str) -> DataFrame:
    """(name): trimmed lines that are not empty, each once."""
    return spark.read.text(path).select(F.trim("value").alias("name")).where("name <> ''").distinct()


def sample_groups(spark: SparkSession, path: str) -> DataFrame:
    """(sample, grp) of a table with a heading; empty or repeated samples raise an error."""
    rows = spark.read.option("header", True).option("sep", "\t").csv(path).select(F.trim("sample").alias("sample"), F.trim("group").alias("grp"))
    rows = rows.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("sample")))
    empty = F.coalesce((F.col("sample") == "") | (F.col("grp") == ""), F.lit(True))
    return _checked(rows, _fail(empty, "empty sample or group"), _fail(F.col("_n") > 1, "repeated sample ", F.col("sample"))).drop("_n")


def manual_records(spark: SparkSession, barcodes: Mapping[str, Sequence[Sequence[str]]], ids: Sequence[str] | None = None) -> DataFrame:
    """Records of manual sets (UMI i5, internal i5, i7): each i5 of a pair with each i7. Ids in natural order, unless given."""
    if missing := [i for i in ids or () if i not in barcodes]:
        raise ValueError(f"unknown manual id {missing[0]}")
    rows = [(str(i), t, n, list(barcodes[i][2])) for i in (ids or barcodes) for t, n in zip(barcodes[i][0], barcodes[i][1])]
    each = spark.createDataFrame(rows, "candidate_id string, umi string, internal string, i7 array<string>").withColumn("i7", F.explode("i7"))
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("barcode_type"), F.upper(F.concat(F.col(k), "i7")).alias("barcode")) for k in ("umi", "internal")]))
    return each.select(F.lit("manual").alias("candidate_type"), "candidate_id", F.concat(F.lit("MANUAL"), "candidate_id").alias("wellID"), kinds.alias("k")).select("candidate_type", "candidate_id", "wellID", "k.barcode", "k.barcode_type")


def auto_records(spark: SparkSession, plates: Mapping[str, Mapping[str, Sequence]], ids: Sequence[str] | None = None) -> DataFrame:
    """Records of plates of wells with (UMI barcodes, internal barcodes), each one or a list."""
    own = [f"plate{i}" for i in ids] if ids is not None else list(plates)
    if missing := [p for p in own if p not in plates]:
        raise ValueError(f"unknown plate {missing[0]}")
    many = lambda x: list(x) if isinstance(x, (list, tuple)) else [x]
    rows = [(p.replace("plate", ""), w, k, str(b)) for p in own for w, v in plates[p].items() for k, bs in (("umi", many(v[0])), ("internal", many(v[1]))) for b in bs]
    df = spark.createDataFrame(rows, "candidate_id string, well string, barcode_type string, barcode string")
    return df.select(F.lit("auto").alias("candidate_type"), "candidate_id", F.concat(F.lit("P"), "candidate_id", "well").alias("wellID"), F.upper(F.trim("barcode")).alias("barcode"), "barcode_type")


def expected_lines(records: DataFrame, order: Sequence[str] = ("candidate_id", "wellID")) -> DataFrame:
    """(wellID, umi_barcodes, internal_barcodes): each well's barcodes once, in order, joined by commas; natural order of wells."""
    w = Window.partitionBy("wellID", "barcode_type").orderBy(*order, "barcode")
    listed = records.withColumn("_i", F.row_number().over(w))
    part = lambda k: F.array_join(F.array_distinct(F.transform(F.sort_array(F.collect_list(F.when(F.col("barcode_type") == k, F.struct("_i", "barcode")))), lambda x: x["barcode"])), ",")
    out = listed.groupBy("wellID").agg(part("umi").alias("umi_barcodes"), part("internal").alias("internal_barcodes"))
    return out.orderBy(E.natural_key(F.col("wellID")), "wellID")
