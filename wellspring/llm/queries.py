"""The registered queries: each operator over its whole table with production parameters, and the digests of its results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, langid, mixing, neardup, ngram_join, pst, sql, suffix_dedup, topk, toxicity, url_filter

#: Fixed values of the contract: rules as (verdict, host, path).
URL_RULES = (("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds))


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = read(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path()
    out = bpe.decode(bpe.encode(docs, path).drop("text"), path)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pst.score(read(spark, sf_dir, "documents"), fold("doc_id", 10) != 0)


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read(spark, sf_dir, "embeddings"), 0.95)


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_classes(read(spark, sf_dir, "documents"), 5, 75)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(read(spark, sf_dir, "documents"), 100)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"), (5, 2, 1), 1.5, 2.0)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held = F.coalesce(fold("doc_id", 5) == 0, F.lit(False))
    model = toxicity.train(docs.where(~held), read(spark, sf_dir, "labels").where(~held))
    return toxicity.score(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = F.coalesce(fold("doc_id", 4) == 2, F.lit(False))
    model = langid.train(docs.where(~held))
    return langid.predict(docs.select("doc_id", "text"), model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_bpe, op2_topk, op3_lm_score, op4_embedding_dedup, op5_ngram_join, op6_suffix_dedup, op7_mixing, op8_toxicity, op9_langid, op10_url_filter)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    """SQL of the exact searches and joins; models, seeded choices and a tokenizer have none and are held against brute force."""
    return dict(sql.ORACLE)
