"""The folder that the driver and all executors share, tables written there, and connected components."""

from __future__ import annotations

import atexit
import gc
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; only where that is unset on one machine (tests) a folder of our own.

    Executors of a cluster don't see each other's folders, so without the setting an error is raised there.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        path = _own[app] = _own.get(app) or tempfile.mkdtemp(prefix="wellspring-")
    return path.rstrip("/")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table that ``stored`` wrote, through Spark's file system for that path."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def _remove_quietly(spark: SparkSession, path: str, table: str | None = None) -> None:
    try:  # at exit the session may be gone already; the folder is then the cluster's to clean
        if table:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        remove(spark, path)
    except Exception:  # noqa: BLE001
        pass


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return it as read from there: a cut of lineage that outlives executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/wellspring/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    atexit.register(_remove_quietly, spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def stored_by(df: DataFrame, name: str, key: str, buckets: int, into: DataFrame | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder in buckets of ``key``: later groupings by the key read it in place.

    The table's name is in the session's catalog until the program ends, when it is dropped; its files are where
    ``stored`` puts them. ``into``: what this returned before; the rows are added to its table, and all are returned.
    """
    spark = df.sparkSession
    dealt = df.repartition(buckets, key).write.option("compression", "zstd").bucketBy(buckets, key)
    if into is None:
        table = f"wellspring_{name}_{uuid.uuid4().hex}"
        path = f"{shared_dir(spark)}/wellspring/{table}"
        dealt.option("path", path).saveAsTable(table, format="parquet")
        atexit.register(_remove_quietly, spark, path, table)
    else:
        table, path = into.stored_as, into.stored_at
        dealt.saveAsTable(table, format="parquet", mode="append")
    out = spark.read.table(table)
    out.stored_as, out.stored_at = table, path
    return out


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of steps whose results are stored.

    It acts on the driver's garbage: Python's first, then the plans that Python held.
    """
    master = spark.sparkContext.master
    if master.startswith("local") and not master.startswith("local-cluster"):
        return  # one JVM on one disk: its own collections do
    for _ in range(3):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.4)


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): smallest node reachable over ``edges`` (a, b); nodes without an edge are absent.

    Alternating large-star and small-star rounds, each a grouped minimum and a join, so that a node with very many
    neighbours is pre-aggregated and its join is split by adaptive execution. Every round is written to the shared
    folder. Null ends and loops are ignored; an empty table gives an empty table.
    """
    e = (
        edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
        .where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    e = stored(e, "edges")
    while True:
        # Done when every leaf has one centre and no centre is a leaf.
        n, leaves = e.agg(F.count(F.lit(1)), F.count_distinct("u")).first()
        if n == leaves and e.select(F.col("v").alias("u")).distinct().join(e.select("u"), "u", "left_semi").isEmpty():
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v"))).alias("e"))
        e = stored(small.select(F.explode("e").alias("e")).select("e.*").where("u <> v").distinct(), "edges")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def merge_components(root: DataFrame, edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of ``root`` with further edges: only the components that these join are worked on."""
    of = lambda c: root.select(F.col("node").alias(c), F.col("component").alias(f"_{c}"))
    joined = edges.join(of(a), a, "left").join(of(b), b, "left").select(F.coalesce(f"_{a}", a).alias("u"), F.coalesce(f"_{b}", b).alias("v"))
    more = stored(connected_components(joined, "u", "v"), "classes")
    moved = root.join(more.select(F.col("node").alias("component"), F.col("component").alias("to")), "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    return moved.unionByName(more.join(root.select("node"), "node", "left_anti"))
