"""From raw documents to token ids: the stages in order, each over what the one before it kept."""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession

from wellspring.llm import bpe, langid, mixing, ngram_join, suffix_dedup
from wellspring.llm.queries import fold, read, tokenizer_path
from wellspring.llm.shared import stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told: those without any letter are rejected, all others are kept unchanged."""
    learn = docs.where(F.coalesce(fold("doc_id", 4) != 2, F.lit(False)))
    found = langid.predict(docs.select(*COLUMNS), langid.train(learn))
    return found.where(F.col("lang_pred") != langid.UNDETERMINED).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each class of near copies (five words, Jaccard 0.75); rows without an id all stay.

    Rows that repeat an id stay or go together; of those that stay each different text does.
    """
    classes = ngram_join.jaccard_classes(docs, 5, 75)
    leads = F.max((F.col("doc_id") == F.col("component_id")).cast("int"))
    first = classes.groupBy("doc_id").agg(leads.alias("leads"), F.count(F.lit(1)).alias("rows")).where("leads = 1").select("doc_id", "rows")
    kept = docs.select(*COLUMNS).join(first, "doc_id")
    # Of rows that repeat an id every different text stays, once, with the least of what else differs; the join has
    # brought them together already.
    again = kept.where(F.col("rows") > 1).groupBy("doc_id", "text").agg(F.min(F.struct("lang", "source", "n_chars")).alias("r")).select("doc_id", "text", "r.*")
    parts = [kept.where(F.col("rows") == 1), again, docs.where("doc_id IS NULL")]
    return parts[0].select(*COLUMNS).unionByName(parts[1].select(*COLUMNS)).unionByName(parts[2].select(*COLUMNS))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes that 100-byte passages repeat; of a cut character nothing stays."""
    # Characters are made whole where bytes are cut, and the text comes from what is kept: a second Python step on top of
    # the cut, or the text a second time beside the blocks, would double what a task holds.
    rows = docs.withColumn("_null", F.col("text").isNull())
    cut = suffix_dedup.remove_repeats(rows, 100, carry=("lang", "source", "n_chars", "_null"), whole=True)
    text = F.when(~F.col("_null"), F.col("kept").cast("string"))
    n_chars = F.when(F.col("n_removed") == 0, F.col("n_chars")).otherwise(F.length("text").cast("long"))
    return cut.withColumn("text", text).withColumn("n_chars", n_chars).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources by weight (5, 2, 1): a document taken twice is two rows, one not taken none."""
    taken = mixing.mix(docs, (5, 2, 1), 1.5, 2.0, carry=("text", "lang", "source", "n_chars"))
    times = F.when(F.col("size") > 0, (F.col("taken") / F.col("size")).cast("int")).otherwise(0)
    return taken.withColumn("_n", F.explode(F.array_repeat(F.lit(1), times))).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether decoding them gives the text again."""
    out = bpe.encode(docs.select("doc_id", "lang", "source", "text"), tokenizer_path(), verify=True, kept_words=200_000)
    return out.select("doc_id", "lang", "source", "n_tokens", "ids", "round_trip")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mixture", mixture),
    ("tokens", tokens),
]

#: The classifier, the class search and the seeded choice have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
