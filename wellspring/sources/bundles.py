"""Files that a run leaves: matrix bundles that other readers open, tables, JSON, and the checks of all of them.

A bundle's three files are single gzipped files. Entries are sorted over many tasks and written as parts; parts of a
gzipped text joined end to end are a gzipped text, so they become one file by Hadoop's file system, without passing
through the driver. Every file is written beside its place and renamed into it.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Names and heading of a bundle.
MATRIX, FEATURES, BARCODES = "matrix.mtx.gz", "features.tsv.gz", "barcodes.tsv.gz"
HEADER = "%%MatrixMarket matrix coordinate integer general"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where, jvm


def write_one(parts: Sequence[DataFrame], path: str) -> None:
    """The texts (value) of ``parts``, one after the other and each in its order, as one file; gzipped if its name says so."""
    spark = parts[0].sparkSession
    fs, target, jvm = _fs(spark, path)
    beside = f"{path}.{uuid.uuid4().hex}"
    hidden = jvm.org.apache.hadoop.fs.Path(beside)
    try:
        pieces = []
        for i, part in enumerate(parts):
            part.select("value").write.option("compression", "gzip" if path.endswith(".gz") else "none").text(f"{beside}/{i}")
            own = [f.getPath() for f in fs.listStatus(jvm.org.apache.hadoop.fs.Path(f"{beside}/{i}")) if f.getPath().getName().startswith("part-")]
            pieces += sorted(own, key=lambda p: p.getName())
        joined = jvm.org.apache.hadoop.fs.Path(f"{beside}/joined")
        out = fs.create(joined)
        for piece in pieces:
            source = fs.open(piece)
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 1 << 16, False)
            source.close()
        out.close()
        fs.delete(target, False)
        if not fs.rename(joined, target):
            raise OSError(f"{path} could not be put in place")
    finally:
        fs.delete(hidden, True)


def numbered(names: DataFrame | Sequence[str], column: str, spark: SparkSession | None = None) -> DataFrame:
    """(column, column_no from 1) of a list or of rows (name, no)."""
    if isinstance(names, DataFrame):
        return names.toDF(column, f"{column}_no")
    return spark.createDataFrame([(n, i + 1) for i, n in enumerate(names)], f"{column} string, {column}_no long")


def write_mex(counts: DataFrame, genes: DataFrame | Sequence[str], wells: DataFrame | Sequence[str], path: str, gene_names: Mapping[str, str] | DataFrame | None = None) -> None:
    """A bundle of (well, gene, n): 1-based entries by column (well), then row (gene), none <= 0; others' are left out.

    Axes are lists or rows (name, number from 1). Features have three columns: id, name (the id where none is known) and
    kind. The size line needs the number of entries, counted first.
    """
    spark = counts.sparkSession
    g, w = numbered(genes, "gene", spark), numbered(wells, "well", spark)
    own = counts.where("n > 0").join(g, "gene").join(w, "well").select("well_no", "gene_no", F.col("n").cast("long").alias("n"))
    size = spark.createDataFrame([(f"{HEADER}\n{g.count()} {w.count()} {own.count()}",)], "value string").coalesce(1)
    write_one([size, own.orderBy("well_no", "gene_no").select(F.concat_ws(" ", "gene_no", "well_no", "n").alias("value"))], f"{path}/{MATRIX}")
    if gene_names is None:
        named = g.withColumn("name", F.col("gene"))
    else:
        of = gene_names if isinstance(gene_names, DataFrame) else spark.createDataFrame(list(gene_names.items()) or [("", "")], "gene string, name string")
        named = g.join(of.select("gene", "name"), "gene", "left").withColumn("name", F.coalesce("name", "gene"))
    write_one([named.orderBy("gene_no").select(F.concat_ws("\t", "gene", "name", F.lit("Gene Expression")).alias("value"))], f"{path}/{FEATURES}")
    write_one([w.orderBy("well_no").select(F.col("well").alias("value"))], f"{path}/{BARCODES}")


def _axis(spark: SparkSession, path: str, column: str) -> DataFrame:
    """(column, column_no): the first field of each line that isn't empty."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split(F.regexp_replace("value", r"(\r?\n)+\z", ""), r"\r?\n")).alias("i", "line"))
    return lines.where("line <> ''").select(F.split("line", "\t")[0].alias(column), (F.col("i") + 1).cast("long").alias(f"{column}_no"))


def features(spark: SparkSession, path: str) -> DataFrame:
    """(gene, name, kind, gene_no) of a bundle; files of one or two columns are filled up."""
    lines = spark.read.text(f"{path}/{FEATURES}", wholetext=True).select(F.posexplode(F.split(F.regexp_replace("value", r"(\r?\n)+\z", ""), r"\r?\n")).alias("i", "line"))
    p = F.split("line", "\t")
    rest = lambda i, default: F.coalesce(F.try_element_at(p, F.lit(i)), default)
    return lines.where("line <> ''").select(p[0].alias("gene"), rest(2, p[0]).alias("name"), rest(3, F.lit("Gene Expression")).alias("kind"), (F.col("i") + 1).cast("long").alias("gene_no"))


def _shape(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """Rows, columns and entries that the matrix declares; another heading or dimensions under 0 raise an error."""
    head = [r.value.strip() for r in spark.read.text(f"{path}/{MATRIX}").limit(100).collect()]
    if not head or not head[0].startswith("%%MatrixMarket matrix coordinate"):
        raise ValueError(f"no Matrix Market heading: {path}")
    line = next((x for x in head[1:] if x and not x.startswith("%")), "")
    if len(dims := line.split()) != 3 or not all(d.isdigit() for d in dims):
        raise ValueError(f"no three dimensions: {path}: {line!r}")
    return tuple(map(int, dims))


def entries(spark: SparkSession, path: str) -> DataFrame:
    """(gene_no, well_no, n) of a bundle's matrix; lines that aren't three whole numbers give nulls."""
    p = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(f"{path}/{MATRIX}").withColumn("_i", F.monotonically_increasing_id()).where(~F.col("value").startswith("%") & (F.trim("value") != ""))
    first = rows.agg(F.min("_i").alias("_size"))  # one row: the size line
    own = rows.crossJoin(F.broadcast(first)).where("_i > _size")
    at = lambda i: F.when(F.size(p) == 3, F.try_element_at(p, F.lit(i)).try_cast("long"))
    return own.select(at(1).alias("gene_no"), at(2).alias("well_no"), at(3).alias("n"))


def read_mex(spark: SparkSession, path: str) -> DataFrame:
    """(well, gene, n) of a bundle; entries outside its axes raise an error when they are read."""
    met = entries(spark, path).join(features(spark, path).select("gene", "gene_no"), "gene_no", "left").join(_axis(spark, f"{path}/{BARCODES}", "well"), "well_no", "left")
    bad = F.when(F.col("gene").isNull() | F.col("well").isNull(), F.raise_error(F.lit("entry outside the matrix")).cast("long"))
    return met.select("well", "gene", F.coalesce(bad, F.col("n")).alias("n"))


def check_bundle(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """The shape of a bundle whose axes, entries and declared sizes agree; anything else raises an error."""
    rows, cols, nnz = _shape(spark, path)
    n_genes, n_wells = features(spark, path).count(), _axis(spark, f"{path}/{BARCODES}", "well").count()
    if (rows, cols) != (n_genes, n_wells):
        raise ValueError(f"{path}: matrix is {rows} x {cols}, axes are {n_genes} x {n_wells}")
    inside = (F.col("gene_no").between(1, rows)) & F.col("well_no").between(1, cols) & (F.col("n") >= 0)
    got = entries(spark, path).agg(F.count(F.lit(1)).alias("k"), F.count(F.when(~F.coalesce(inside, F.lit(False)), 1)).alias("bad")).first()
    if got.bad:
        raise ValueError(f"{path}: {got.bad} entries are no whole numbers inside the matrix")
    if got.k != nnz:
        raise ValueError(f"{path}: {got.k} entries, {nnz} declared")
    return rows, cols, nnz


def check_bundles(spark: SparkSession, folder: str, project: str, introns: bool) -> tuple[int, int]:
    """The common shape of the bundles a run needs (``project.exon.umi``): exons, and introns and their union where these are counted."""
    kinds = ("exon", "intron", "inex") if introns else ("exon",)
    shapes = {f"{kind}.{layer}": check_bundle(spark, f"{folder}/{project}.{kind}.{layer}")[:2] for kind in kinds for layer in ("umi", "read")}
    if len(set(shapes.values())) != 1:
        raise ValueError(f"bundles differ in shape: {shapes}")
    return next(iter(shapes.values()))


def check_counts(matrix: DataFrame) -> DataFrame:
    """(gene, sample, n) of whole numbers from 0 with unique (gene, sample) that have names; others raise an error."""
    fail = lambda cond, what: F.when(cond, F.raise_error(F.concat(F.lit(what), F.coalesce("gene", F.lit("")), F.lit(" "), F.coalesce("sample", F.lit(""))))).cast("string")
    each = matrix.groupBy("gene", "sample").agg(F.count(F.lit(1)).alias("_k"), F.first("n").alias("n"))
    nameless = F.coalesce((F.col("gene") == "") | (F.col("sample") == ""), F.lit(True))
    whole = F.coalesce((F.col("n") >= 0) & (F.col("n") == F.floor("n")), F.lit(False))
    fine = F.coalesce(fail(nameless, "no name: "), fail(F.col("_k") > 1, "repeated: "), fail(~whole, "no count: "), F.lit(""))
    return each.where(fine == "").select("gene", "sample", F.col("n").cast("long").alias("n"))


def check_gzip(spark: SparkSession, path: str) -> int:
    """Bytes of a gzipped file after it was decompressed to its end; empty or broken ones raise an error."""
    fs, where, jvm = _fs(spark, path)
    if fs.getFileStatus(where).getLen() == 0:
        raise ValueError(f"{path} is empty")
    try:
        size = spark.read.text(path).agg(F.sum(F.octet_length("value") + 1)).first()[0]
    except Exception as e:
        raise ValueError(f"{path} cannot be read: {str(e).splitlines()[0]}") from e
    if not size:
        raise ValueError(f"{path} holds nothing")
    return int(size)


def tsv(df: DataFrame, formats: Mapping[str, str] | None = None) -> DataFrame:
    """(value) of a heading and rows between tabs, in the order of ``df``; formats (``%.4f``) by column, nulls empty."""
    text = [F.coalesce(F.format_string(formats[c], F.col(c).cast("double")) if formats and c in formats else F.col(c).cast("string"), F.lit("")) for c in df.columns]
    return df.select(F.concat_ws("\t", *text).alias("value"))


def write_tsv(df: DataFrame, path: str, formats: Mapping[str, str] | None = None) -> None:
    head = df.sparkSession.createDataFrame([("\t".join(df.columns),)], "value string").coalesce(1)
    write_one([head, tsv(df, formats)], path)


def write_report(summary: DataFrame, matches: DataFrame, path: str) -> None:
    """Sections ``[summary]`` and ``[matches]`` of a barcode discovery, each with a heading."""
    spark = summary.sparkSession
    line = lambda *x: spark.createDataFrame([(s,) for s in x], "value string").coalesce(1)
    write_one([line("[summary]", "\t".join(summary.columns)), tsv(summary), line("", "[matches]", "\t".join(matches.columns)), tsv(matches)], path)


def discovery_order(summary: DataFrame, types: Sequence[str] = ("manual", "auto")) -> DataFrame:
    """Best candidates first: reads, expected barcodes, the types' rank, id."""
    return summary.orderBy(F.desc("reads"), F.desc("expected"), type_rank(F.col("candidate_type"), types), "candidate_id")


def type_rank(kind: Column, types: Sequence[str] = ("manual", "auto")) -> Column:
    """Place of a candidate's type, others last."""
    at = F.array_position(F.array(*map(F.lit, types)), kind)
    return F.when(at > 0, at - 1).otherwise(len(types)).cast("int")


def to_json(df: DataFrame, key: str) -> DataFrame:
    """One row (value): an object of objects, the other columns by ``key`` in its order. For tables of wells."""
    own = [c for c in df.columns if c != key]
    pairs = F.sort_array(F.collect_list(F.struct(F.col(key).alias("k"), F.struct(*own).alias("v"))))
    return df.agg(F.to_json(F.map_from_entries(pairs)).alias("value"))


def write_saf(saf: DataFrame, prefix: str) -> None:
    """``prefix``.combined.saf, .exon.saf and .intron.saf of ``annotation.saf``'s rows, in their order."""
    head = saf.sparkSession.createDataFrame([("GeneID\tChr\tStart\tEnd\tStrand",)], "value string").coalesce(1)
    for kind, rows in (("combined", saf), ("exon", saf.where("NOT intron")), ("intron", saf.where("intron"))):
        text = rows.orderBy("gene_no", "intron", "Start").select(F.concat_ws("\t", "GeneID", "Chr", "Start", "End", "Strand").alias("value"))
        write_one([head, text], f"{prefix}.{kind}.saf")


def write_isoforms(counts: DataFrame, molecules: DataFrame, transcripts: DataFrame, cells: DataFrame, path: str) -> None:
    """Counts by transcript and cell of ``isoform.quantify`` as a matrix, its axes and two tables.

    The matrix has fractional counts in the order of rows, then columns; axes are rows (name, number from 1).
    ``counts.tsv`` is sorted by cell and transcript, ``molecules.tsv`` has a line a molecule with its transcripts.
    """
    spark = counts.sparkSession
    t, c = numbered(transcripts, "tx"), numbered(cells, "well")
    own = counts.join(t, "tx").join(c, "well").where("fractional > 0")
    head = spark.createDataFrame([(f"{HEADER.replace('integer', 'real')}\n{t.count()} {c.count()} {own.count()}",)], "value string").coalesce(1)
    lines = own.orderBy("tx_no", "well_no").select(F.concat_ws(" ", "tx_no", "well_no", F.format_string("%.6f", "fractional")).alias("value"))
    write_one([head, lines], f"{path}/{MATRIX}")
    for df, name, column in ((t, FEATURES, "tx"), (c, BARCODES, "well")):
        write_one([df.orderBy(f"{column}_no").select(F.col(column).alias("value"))], f"{path}/{name}")
    write_tsv(counts.select("well", "tx", "unique_molecules", "fractional", "total_reads").orderBy("well", "tx"), f"{path}/counts.tsv", {"fractional": "%.6f"})
    write_tsv(molecules.select("molecule", "reads", F.array_join("transcripts", ",").alias("transcripts")).orderBy("molecule"), f"{path}/molecules.tsv")


def write_layers(layers: Mapping[str, DataFrame], path: str) -> None:
    """Matrices (well, gene, n) by name as one Parquet table in folders ``layer=name``: the columnar form of a file of layers."""
    every = None
    for name, df in layers.items():
        part = df.select("well", "gene", F.col("n").cast("long").alias("n"), F.lit(name).alias("layer"))
        every = part if every is None else every.unionByName(part)
    every.write.mode("overwrite").partitionBy("layer").parquet(path)


def check_layers(spark: SparkSession, path: str, genes: DataFrame, wells: DataFrame, needed: Sequence[str]) -> None:
    """Raises an error unless all needed layers are there and name known genes and wells only."""
    rows = spark.read.parquet(path)
    have = {r.layer for r in rows.select("layer").distinct().collect()}
    if missing := set(needed) - have:
        raise ValueError(f"layers are missing: {sorted(missing)}")
    for axis, known in (("gene", genes), ("well", wells)):
        if stranger := rows.join(known.select(F.col(known.columns[0]).alias(axis)), axis, "left_anti").select(axis).first():
            raise ValueError(f"unknown {axis} in the layers: {stranger[0]}")


def assert_same_names(df: DataFrame, known: DataFrame, column: str, what: str) -> DataFrame:
    """``df``, or an error for a value of ``column`` that ``known`` lacks."""
    own = known.select(column).distinct().withColumn("_known", F.lit(True))
    met = df.join(own, column, "left")
    bad = F.when(F.col("_known").isNull(), F.raise_error(F.concat(F.lit(f"{what}: "), F.coalesce(F.col(column).cast("string"), F.lit("null"))))).cast("string")
    return met.where(F.coalesce(bad, F.lit("")) == "").drop("_known")
