"""Sequencing-like views of the driver's tables: the same SQL text on both engines."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


def _base4(x: str) -> str:
    return " || ".join(f"substr('ACGT', cast(1 + cast(floor(({x}) / {d}) as bigint) % 4 as int), 1)" for d in (64, 16, 4, 1))


VIEWS = {
    "reads": f"""
        SELECT cast(l_orderkey as string) || '_' || cast(l_linenumber as string) AS qname,
               'P1' || chr(cast(65 + l_suppkey % 16 as int)) || cast(1 + l_suppkey % 24 as string) AS well,
               'G' || lpad(cast(l_partkey % 50 as string), 3, '0') AS gene, {_base4('l_orderkey % 256')} AS umi, {_base4('l_suppkey % 256')} AS bc,
               CASE l_returnflag WHEN 'A' THEN 'E' WHEN 'N' THEN 'N' ELSE 'I' END AS re, CASE l_linestatus WHEN 'O' THEN 'UMI' ELSE 'Internal' END AS source,
               cast(l_quantity as int) AS phred, 'chr' || cast(1 + l_suppkey % 5 as string) AS chrom, CASE WHEN l_linenumber % 2 = 0 THEN '+' ELSE '-' END AS strand,
               cast(floor(l_extendedprice) as bigint) % 30000 + 1 AS b_start, cast(floor(l_extendedprice) as bigint) % 30000 + 60 + l_partkey % 90 AS b_end,
               CASE l_linenumber % 8 WHEN 1 THEN 99 WHEN 2 THEN 147 WHEN 3 THEN 355 WHEN 4 THEN 0 WHEN 5 THEN 69 WHEN 6 THEN 137 WHEN 7 THEN 2147 ELSE 16 END AS flag
        FROM lineitem""",
    "exons": """
        SELECT 'G' || lpad(cast(p_partkey % 50 as string), 3, '0') AS gene, 'T' || lpad(cast(p_partkey % 200 as string), 4, '0') AS tx,
               'chr' || cast(1 + p_partkey % 5 as string) AS chrom, CASE WHEN p_partkey % 10 < 5 THEN '+' ELSE '-' END AS strand,
               cast(600 * (p_partkey % 50) + 150 * k + p_size AS bigint) AS "start", cast(600 * (p_partkey % 50) + 150 * k + p_size + 40 + p_partkey % 30 AS bigint) AS "end"
        FROM part, (SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 2) ks""",
    "wells": "SELECT DISTINCT 'P1' || chr(cast(65 + s_suppkey % 16 as int)) || cast(1 + s_suppkey % 24 as string) AS well FROM supplier",
    "genes": "SELECT DISTINCT 'G' || lpad(cast(p_partkey % 50 as string), 3, '0') AS gene FROM part",
    "expected": f"SELECT DISTINCT 'P1' || chr(cast(65 + s_suppkey % 16 as int)) || cast(1 + s_suppkey % 24 as string) AS \"wellID\", {_base4('s_suppkey % 256')} AS barcode, CASE WHEN s_suppkey % 2 = 0 THEN 'umi' ELSE 'internal' END AS kind FROM supplier",
    "whitelist": f"SELECT DISTINCT {_base4('s_suppkey % 256')} AS barcode FROM supplier",
    "observed": f"SELECT {_base4('(c_custkey * 7) % 256')} AS \"XC\", count(*) AS n FROM customer GROUP BY 1",
    "candidates": f"SELECT CASE WHEN n_nationkey % 2 = 0 THEN 'manual' ELSE 'auto' END AS candidate_type, cast(r_regionkey as string) AS candidate_id, 'P1A' || cast(1 + n_nationkey % 12 as string) AS \"wellID\", {_base4('n_nationkey * 5 + r_regionkey')} AS barcode, CASE WHEN r_regionkey % 2 = 0 THEN 'umi' ELSE 'internal' END AS barcode_type FROM nation, region",
    # The whole of a text as reads of 100 characters; an empty text is one empty read.
    "quals": "SELECT doc_id, substr(r, 1, 60) AS q1, substr(r, 61, 40) AS q2 FROM (SELECT doc_id, unnest(regexp_extract_all(regexp_replace(text, '[^ -~]', '', 'g'), '^$|.{1,100}', 0)) AS r FROM documents) cut",
    "samples": "SELECT 'G' || lpad(cast(l_partkey % 50 as string), 3, '0') AS gene, 'S' || cast(l_suppkey % 6 as string) AS sample, count(*) AS n FROM lineitem GROUP BY 1, 2",
    "groups": "SELECT DISTINCT 'S' || cast(s_suppkey % 6 as string) AS sample, CASE WHEN s_suppkey % 6 < 3 THEN 'a' ELSE 'b' END AS grp FROM supplier",
}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = VIEWS[name].replace(", '', 'g')", ", '')").replace("unnest(", "explode(").replace('"', "`").replace("{", "{{").replace("}", "}}")
    used = [t for t in TABLES if re.search(rf"\b{t}\b", text)]
    for t in used:
        text = re.sub(rf"(FROM|,) {t}\b", rf"\1 {{{t}}}", text)
    return spark.sql(text, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used})


def with_views(sql: str, *more: str) -> str:
    """DuckDB SQL over the views that it names; ``more`` are further common tables."""
    body = " ".join((*more, sql))
    used = [v for v in VIEWS if re.search(rf"\b{v}\b", body)]
    return "WITH RECURSIVE " + ", ".join([*(f"{v} AS ({VIEWS[v]})" for v in used), *more]) + " " + sql
