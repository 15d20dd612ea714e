"""The additive counts over a landing folder: running totals with the same results as in a batch.

Clustering, selection and curves need whole groups and stay batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def landing(spark: SparkSession, path: str, schema: str, files: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def running_counts(stream: DataFrame, *keys: str) -> DataFrame:
    return stream.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def windowed_counts(stream: DataFrame, time: str, late: str, width: str, *keys: str) -> DataFrame:
    """Counts by event time (an addition to the batch operators), late rows accepted up to ``late``."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width), *keys).agg(F.count(F.lit(1)).alias("n"))


def to_memory(df: DataFrame, name: str, checkpoint: str, mode: str = "complete") -> StreamingQuery:
    return df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
