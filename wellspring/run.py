"""A run: its configuration, its stages with their manifests, the lock of its folder, and what it delivers.

Stages are functions from a run to the tables they leave as Parquet in the run's folder. A stage is done when its
manifest is written: what it left, with sizes, and the digest of the configuration it ran under. A run that is taken up
again skips to a stage whose predecessors have manifests that still hold. All paths go through Hadoop's file systems.
"""

from __future__ import annotations

import hashlib
import json
import os
import socket
import time
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import annotation as N
from .operators import assign as A
from .operators import barcodes as B
from .operators import expression as X
from .operators import intervals as I
from .operators import qc as Q
from .operators import reads as R
from .operators import report as P
from .sources import bam, bundles, formats, sheets

FILTERING, MAPPING, COUNTING, SUMMARISING = STAGES = ("Filtering", "Mapping", "Counting", "Summarising")
#: Settings that do not change results, and so no digest.
FREE = ("out_dir", "threads", "stage", "resume")
#: Space a run needs over its input, at least and by input.
LEAST_DISK, DISK_BY_INPUT = 5 << 30, 4.0


class Files:
    """Small files of a folder through Hadoop's file system for it."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark.sparkContext._jvm, root.rstrip("/")
        self.fs = self.path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def read(self, name: str) -> str | None:
        if not self.fs.exists(self.path(name)):
            return None
        stream = self.fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """Written beside its place and renamed into it."""
        beside = self.path(f"{name}.{os.getpid()}.tmp")
        out = self.fs.create(beside, True)
        out.write(bytearray(text.encode()))
        out.close()
        self.fs.delete(self.path(name), False)
        if not self.fs.rename(beside, self.path(name)):
            raise OSError(f"{name} could not be put in place")

    def claim(self, name: str, text: str) -> bool:
        """Create a file that must not be there yet."""
        try:
            out = self.fs.create(self.path(name), False)
        except Exception:  # noqa: BLE001  Py4J wraps what says that the file is there
            if self.fs.exists(self.path(name)):
                return False
            raise
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def size(self, name: str) -> int | None:
        """Bytes of a file or folder; null where there is none."""
        where = self.path(name)
        return int(self.fs.getContentSummary(where).getLength()) if self.fs.exists(where) else None

    def names(self, name: str) -> list[str]:
        return sorted(str(f.getPath().getName()) for f in self.fs.listStatus(self.path(name))) if self.fs.exists(self.path(name)) else []

    def free(self) -> int:
        return int(self.fs.getStatus(self.path("")).getRemaining())


def parse_config(text: str) -> dict[str, Any]:
    """JSON, or YAML where a parser is installed; anything but a mapping raises an error. yes, no and ~ are YAML's."""
    try:
        config = json.loads(text)
    except ValueError:
        try:
            import yaml
        except ImportError as e:
            raise ValueError("this configuration is not JSON, and no YAML parser is installed") from e
        config = yaml.safe_load(text)
    if not isinstance(config, dict):
        raise ValueError("the configuration is empty or no mapping")
    return config


def digest(config: Mapping[str, Any]) -> str:
    """Of the settings that results follow from, whatever their order."""
    own = {k: v for k, v in config.items() if k not in FREE}
    return hashlib.sha256(json.dumps(own, sort_keys=True, default=str).encode()).hexdigest()


@dataclass
class Run:
    """Settings: project, out_dir, fastqs or pairs, layouts, patterns, barcode_filter, umi_filter, expected, alignments, gtf, introns."""

    spark: SparkSession
    config: dict[str, Any]
    files: Files = field(init=False)

    def __post_init__(self) -> None:
        for key in ("project", "out_dir"):
            if not self.config.get(key):
                raise ValueError(f"the configuration lacks {key}")
        self.files = Files(self.spark, self.config["out_dir"])

    @property
    def project(self) -> str:
        return self.config["project"]

    def at(self, name: str) -> str:
        return f"{self.files.root}/{name}"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.at(f"tables/{name}"))

    def keep(self, name: str, df: DataFrame) -> str:
        df.write.mode("overwrite").parquet(self.at(f"tables/{name}"))
        return f"tables/{name}"


def save_config(run: Run) -> None:
    run.files.write("config/run_config.json", json.dumps(run.config, indent=1, default=str))


def load_config(spark: SparkSession, out_dir: str) -> dict[str, Any]:
    text = Files(spark, out_dir).read("config/run_config.json")
    if text is None:
        raise ValueError(f"there is no run in {out_dir}")
    return parse_config(text)


@contextmanager
def locked(run: Run) -> Iterator[None]:
    """One writer a folder. The lock of a process of this host that has ended is taken over; others raise an error."""
    own = json.dumps({"pid": os.getpid(), "host": socket.gethostname(), "project": run.project})
    if not run.files.claim("run.lock", own):
        try:
            other = json.loads(run.files.read("run.lock") or "")
            gone = other["host"] == socket.gethostname() and not os.path.exists(f"/proc/{int(other['pid'])}")
        except (ValueError, KeyError, TypeError):
            other, gone = "an unknown process", False
        if not gone:
            raise RuntimeError(f"{run.files.root} is locked by {other}")
        run.files.delete("run.lock")
        if not run.files.claim("run.lock", own):
            raise RuntimeError(f"{run.files.root} was locked by another process meanwhile")
    try:
        yield
    finally:
        run.files.delete("run.lock")


def owned(run: Run) -> None:
    """Raises an error if the folder holds another project's run."""
    text = run.files.read("config/run_config.json")
    if text and (other := parse_config(text).get("project")) != run.project:
        raise ValueError(f"{run.files.root} holds the run of {other}")


def write_manifest(run: Run, stage: str, artifacts: list[str], seconds: float) -> None:
    sizes = [{"path": a, "size_bytes": run.files.size(a)} for a in artifacts]
    run.files.write(f"state/{stage}.manifest.json", json.dumps({"status": "success", "stage": stage, "project": run.project, "config_sha256": digest(run.config), "seconds": round(seconds, 3), "artifacts": sizes}, indent=1))


def check_manifest(run: Run, stage: str) -> dict[str, Any]:
    """The manifest of a stage that is done under this configuration and whose artifacts are as it left them."""
    text = run.files.read(f"state/{stage}.manifest.json")
    if text is None:
        raise RuntimeError(f"{stage} has not been done")
    found = json.loads(text)
    if found.get("status") != "success" or found.get("stage") != stage or found.get("project") != run.project:
        raise RuntimeError(f"{stage}: the manifest is not one of a finished stage of {run.project}")
    if found.get("config_sha256") != digest(run.config):
        raise RuntimeError(f"{stage} was done under another configuration")
    if changed := [a["path"] for a in found["artifacts"] if run.files.size(a["path"]) != a["size_bytes"] or not a["size_bytes"]]:
        raise RuntimeError(f"{stage}: missing, empty or changed: {', '.join(changed)}")
    return found


def preflight(run: Run, stage: str = FILTERING) -> list[str]:
    """What keeps a run from its start: settings and inputs that are missing, and too little space. Empty: nothing."""
    spark, config, wrong = run.spark, run.config, []
    needed = {FILTERING: ("fastqs", "expected"), MAPPING: ("alignments",), COUNTING: ("gtf",), SUMMARISING: ()}
    total = 0
    for name in [k for s in STAGES[STAGES.index(stage) :] for k in needed[s]]:
        if not config.get(name):
            wrong.append(f"the configuration lacks {name}")
        elif (size := Files(spark, config[name]).size("")) is None:
            wrong.append(f"{name} is not there: {config[name]}")
        else:
            total += size if name == "fastqs" else 0
    space = max(LEAST_DISK, int(DISK_BY_INPUT * total)) if stage == FILTERING else 0
    if space and run.files.free() < space:
        wrong.append(f"{space >> 20} MB are needed in {run.files.root}, {run.files.free() >> 20} MB are free")
    return wrong


def filtering(run: Run) -> list[str]:
    """FASTQ pairs to tagged records, barcode counts and quality totals."""
    c, spark = run.config, run.spark
    listing = sheets.fastq_pairs(sheets.files(spark, c["fastqs"])).cache()
    pairs = formats.pairs(spark, listing).withColumnRenamed("id1", "qname")
    fixed = None
    if c.get("samplesheet"):
        sheet = sheets.resolve_samplesheet(sheets.samplesheet(spark, c["samplesheet"], c["fastqs"]), sheets.expected_table(spark, c["expected"]))
        plain = lambda x: F.regexp_replace(x, "^file:/+", "/")
        own = listing.withColumn("read1", plain("read1")).join(sheet.withColumn("read1", plain("read1")), "read1").select("pair_no", "barcode")
        pairs, fixed = pairs.join(own, "pair_no"), "barcode"
    if c.get("layouts"):
        layouts = [R.parse_layout(x) for x in c["layouts"]]
    else:
        _, a, b = R.infer_layout(sheets.read_lengths(pairs), fixed is not None)
        layouts = [R.parse_layout(a), R.parse_layout(b)]
    pairs = R.first_pairs(pairs, int(c.get("limit") or 0))
    patterns = [R.parse_pattern(p) for p in c.get("patterns") or (None, None)]
    done = R.filter_pairs(pairs, layouts, patterns, tuple(c.get("barcode_filter", (4, 20))), tuple(c.get("umi_filter", (3, 20))), fixed)
    tables = [run.keep("pairs", done)]
    done = run.table("pairs")
    labels = {"R1": "qual1", "R2": "qual2", "BC": "CY", "UMI": "UY", "R1_cDNA": "cDNA1_qual", "R2_cDNA": "cDNA2_qual"}
    quality = B.quality_totals(done, labels).withColumnRenamed("rate", "q30_rate")
    counts = B.counts(done.where("keep"), "CR")
    return [*tables, run.keep("records", R.unmapped_records(done.where("keep"))), run.keep("quality", quality), run.keep("barcodes", counts)]


def mapping(run: Run) -> list[str]:
    """Alignments (SAM text of an aligner, or Parquet) with corrected barcodes; the aligner itself is another program."""
    c, spark = run.config, run.spark
    path = c["alignments"]
    kind = path.rstrip("/").rsplit(".", 1)[-1]
    rows = spark.read.parquet(path) if kind == "parquet" else bam.bam(spark, path) if kind == "bam" else formats.sam(spark, path)
    expected = sheets.expected_table(spark, c["expected"])
    wells = sheets.id_map(expected)
    bins = B.binning(wells.select("barcode"), run.table("barcodes").select(F.col("XC").alias("barcode")), int(c.get("distance", 1)))
    tags = run.table("pairs").where("keep").select("qname", F.col("CR").alias("_cr"), F.col("UR").alias("_ur"))
    tagged = rows.join(tags, "qname", "left").withColumns({"CR": F.coalesce("CR", "_cr"), "UR": F.coalesce("UR", "_ur")}).drop("_cr", "_ur", "CB")
    return [run.keep("alignments", B.correct(tagged, bins.select("falseBC", "trueBC"), wells))]


def counting(run: Run) -> list[str]:
    """Genes of reads, and read and UMI matrices of exons, introns and both."""
    from .functions.exprs import cigar_blocks, is_mapped

    c, spark = run.config, run.spark
    gtf = formats.gtf(spark, c["gtf"])
    genes = N.genes(gtf)
    exons = gtf.select("chrom", "strand", F.col("gene_id").alias("gene"), F.col("transcript_id").alias("tx"), "start", "end")
    rows = run.table("alignments")
    strand = F.when(F.col("flag").bitwiseAND(16) != 0, "-").otherwise("+")
    each = rows.where(is_mapped(F.col("flag"))).select("qname", F.col("rname").alias("chrom"), strand.alias("strand"), F.explode(cigar_blocks(F.col("pos"), F.col("cigar"))).alias("b"))
    blocks = each.select("qname", "chrom", "strand", (F.col("b.start") + 1).alias("b_start"), F.col("b.end").alias("b_end"))
    introns = bool(c.get("introns", True))
    union = I.merge(exons.select("chrom", "strand", "gene", "start", "end"), ["chrom", "strand", "gene"])
    inner = A.introns(exons) if introns else union.limit(0)
    assigned = A.assign(blocks, union, inner, int(c.get("strand", 0)))
    kind = F.when(F.col("category") == "Exon", "E").when(F.col("category") == "Intron", "N")
    source = F.when(F.col("is_internal"), "Internal").otherwise("UMI")
    met = rows.select("qname", "flag", F.col("CB").alias("well"), F.col("UR").alias("umi"), source.alias("source")).join(assigned, "qname", "left")
    met = met.withColumns({"category": F.when(is_mapped(F.col("flag")), F.coalesce("category", F.lit("Intergenic"))).otherwise("Unmapped"), "re": kind})
    tables = [run.keep("assigned", met)]
    wells = sheets.wells_of(sheets.expected_table(spark, c["expected"]))
    # Reads without a gene are no exonic reads without a mark.
    keep = X.eligible(run.table("assigned").where("gene IS NOT NULL"), wells, genes, introns)
    tables += [run.keep("read_matrix", X.both_types(X.read_matrix(keep)))]
    with_umi = keep.where("source = 'UMI' AND umi <> ''")
    tables += [run.keep("umis", X.clustered(X.umi_types(with_umi), ["well", "gene"], int(c.get("umi_distance", 1))))]
    tables += [run.keep("umi_matrix", X.umi_matrix(run.table("umis"))), run.keep("wells", wells), run.keep("genes", genes)]
    axes = genes.select("gene", F.col("gene_no").cast("long")), wells.select("well", F.col("no").cast("long"))
    for layer, table in (("umi", "umi_matrix"), ("read", "read_matrix")):
        for kind in ("exon", "intron", "inex") if introns else ("exon",):
            bundles.write_mex(run.table(table).where(F.col("ftype") == kind).drop("ftype"), *axes, run.at(f"expression/{run.project}.{kind}.{layer}"), genes)
    bundles.check_bundles(spark, run.at("expression"), run.project, introns)
    return [*tables, "expression"]


def summarising(run: Run) -> list[str]:
    """Tables of wells, saturation and quality, as TSV, and the report."""
    matrix, stats = run.table("umi_matrix"), Q.read_stats(run.table("assigned"))
    summary = X.cell_summary(matrix.where("ftype <> 'inex'"))
    wells = Q.well_stats(run.table("wells"), stats, summary)
    curve = X.saturation(X.frequency(run.table("umis"), ["well", "gene"]))
    quality = P.sequencing_quality(P.read_counts(stats, Q.CATEGORIES), run.table("quality"))
    bundles.write_tsv(wells.orderBy("well"), run.at(f"stats/{run.project}.stats.tsv"))
    bundles.write_tsv(curve.orderBy("p"), run.at(f"stats/{run.project}.saturation.tsv"), {"p": "%.2f", "saturation": "%.4f"})
    bundles.write_tsv(run.table("quality").orderBy("metric"), run.at(f"stats/{run.project}.q30_stats.tsv"), {"q30_rate": "%.6f"})
    page = P.html(run.project, {"Sequencing quality": quality.orderBy("no"), "Wells": wells.orderBy("well")}, {"saturation": curve.orderBy("p")})
    run.files.write(f"{run.project}.report.html", page)
    return [f"stats/{run.project}.{x}.tsv" for x in ("stats", "saturation", "q30_stats")] + [f"{run.project}.report.html"]


FUNCTIONS: dict[str, Callable[[Run], list[str]]] = {FILTERING: filtering, MAPPING: mapping, COUNTING: counting, SUMMARISING: summarising}


def start(run: Run, stage: str = FILTERING, last: str = SUMMARISING) -> list[str]:
    """Run the stages from ``stage`` to ``last``; those before must be done under this configuration. Returns what was left."""
    if stage not in STAGES or last not in STAGES or STAGES.index(stage) > STAGES.index(last):
        raise ValueError(f"stages are {', '.join(STAGES)}")
    owned(run)
    with locked(run):
        if wrong := preflight(run, stage):
            raise ValueError("; ".join(wrong))
        for done in STAGES[: STAGES.index(stage)]:
            check_manifest(run, done)
        save_config(run)
        left = []
        for name in STAGES[STAGES.index(stage) : STAGES.index(last) + 1]:
            begin = time.time()
            own = FUNCTIONS[name](run)
            write_manifest(run, name, own, time.time() - begin)
            left += own
        return left


def deliver(run: Run, largest_hashed: int = 64 << 20) -> dict[str, Any]:
    """Copy tables, matrices and the report to ``outs`` and list them with sizes and, up to a size, SHA-256. Old ones go first."""
    files, out = run.files, []
    files.delete("outs")
    hadoop = run.spark.sparkContext._jsc.hadoopConfiguration()
    for name in ("expression", "stats", f"{run.project}.report.html"):
        if files.size(name) is None:
            continue
        files.jvm.org.apache.hadoop.fs.FileUtil.copy(files.fs, files.path(name), files.fs, files.path(f"outs/{name}"), False, hadoop)
    todo = [f"outs/{n}" for n in files.names("outs")]
    while todo:
        name = todo.pop()
        if files.fs.getFileStatus(files.path(name)).isDirectory():
            todo += [f"{name}/{n}" for n in files.names(name)]
            continue
        size = files.size(name)
        sha = run.spark.read.format("binaryFile").load(files.path(name).toString()).select(F.sha2("content", 256)).first()[0] if size <= largest_hashed else None
        out.append({"path": name, "size_bytes": size, "sha256": sha})
    manifest = {"project": run.project, "files": sorted(out, key=lambda x: x["path"])}
    files.write("outs/manifest.json", json.dumps(manifest, indent=1))
    return manifest


def artifact(files: Files, project: str, folder: str, suffix: str) -> str | None:
    """``project + suffix`` in its folder, else the only one of that name in a neighbouring folder; never another project's."""
    if f"{project}{suffix}" in files.names(folder):
        return f"{folder}/{project}{suffix}"
    others = [f"{d}/{project}{suffix}" for d in files.names("") if d != folder and f"{project}{suffix}" in files.names(d)]
    return others[0] if len(others) == 1 else None
