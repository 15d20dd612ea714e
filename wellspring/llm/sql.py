"""DuckDB SQL for the queries that SQL can express: the contract restated over the tables, by plain joins."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FINITE = "embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0"


def components(nodes: str, links: str) -> str:
    """Common tables from (id) rows ``nodes`` and (a, b) rows ``links``, both ways: each id's smallest reachable one.

    An id hands on only roots below the node that it reaches, so a class of n costs the pairs below its members.
    """
    return f"""reach AS (SELECT id AS node, id AS root FROM {nodes} UNION SELECT l.b, r.root FROM reach r JOIN {links} l ON l.a = r.node WHERE r.root < l.b),
        classes AS (SELECT node AS id, min(root) AS root FROM reach GROUP BY 1)"""


OP2 = f"""WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings WHERE {FINITE}),
    met AS (SELECT q.vec_id AS query_id, c.vec_id, cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0)
    SELECT query_id, rank, vec_id, score FROM (SELECT query_id, cast(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM met) WHERE rank <= 10"""

OP4 = f"""WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: cast(x AS DOUBLE)) AS v FROM embeddings WHERE {FINITE} AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    u AS (SELECT vec_id, list_transform(v, lambda x: x / n) AS v FROM (SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS n FROM v)),
    links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) >= 0.95),
    ids AS (SELECT vec_id AS id FROM embeddings), {components('ids', 'links')}
    SELECT c.id AS vec_id, coalesce(n.k, 0) AS n_links, c.root AS component_id, c.id = c.root AS kept FROM classes c LEFT JOIN (SELECT a, count(*) AS k FROM links GROUP BY 1) n ON n.a = c.id"""

OP5 = rf"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 4)) AS i FROM w WHERE len(w) >= 5)
        UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM w WHERE len(w) BETWEEN 1 AND 4),
    size AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
    met AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
    links AS (SELECT a, b FROM met JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b WHERE 100 * c >= 75 * (p.n + q.n - c)),
    ids AS (SELECT doc_id AS id FROM documents), {components('ids', 'links')}
    SELECT c.id AS doc_id, coalesce(s.n, 0) AS n_shingles, c.root AS component_id FROM classes c LEFT JOIN size s ON s.doc_id = c.id"""

#: Windows are told apart by the MD5 of their bytes; what is kept is put together from the bytes' hexadecimals.
OP6 = """WITH b AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
    windows AS (SELECT doc_id, s, md5_number(substr(h, 2 * s + 1, 200)) AS name FROM (SELECT doc_id, h, unnest(generate_series(0, length(h) // 2 - 100)) AS s FROM b WHERE length(h) >= 200)),
    repeated AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY name ORDER BY doc_id, s) AS k FROM windows) WHERE k > 1),
    runs AS (SELECT doc_id, min(s) AS s, max(s) + 99 AS e FROM (SELECT doc_id, s, sum(new) OVER (PARTITION BY doc_id ORDER BY s ROWS UNBOUNDED PRECEDING) AS run FROM
        (SELECT doc_id, s, CASE WHEN s > coalesce(lag(s) OVER (PARTITION BY doc_id ORDER BY s), -200) + 100 THEN 1 ELSE 0 END AS new FROM repeated)) GROUP BY doc_id, run),
    sums AS (SELECT doc_id, sum(e - s + 1) AS n_removed, count(*) AS n_spans FROM runs GROUP BY 1),
    holes AS (SELECT doc_id, s, e, lag(e, 1, -1) OVER (PARTITION BY doc_id ORDER BY s) AS before, lead(s) OVER (PARTITION BY doc_id ORDER BY s) AS following FROM runs),
    pieces AS (SELECT b.doc_id, string_agg(substr(h, 2 * (before + 1) + 1, 2 * (s - before - 1)) || CASE WHEN following IS NULL THEN substr(h, 2 * (e + 1) + 1) ELSE '' END, '' ORDER BY s) AS kept FROM holes JOIN b ON b.doc_id = holes.doc_id GROUP BY 1)
    SELECT b.doc_id, length(h) // 2 AS n_bytes, cast(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
    FROM b LEFT JOIN sums ON sums.doc_id = b.doc_id LEFT JOIN pieces ON pieces.doc_id = b.doc_id"""

ORACLE = {"op2_topk": OP2, "op4_embedding_dedup": OP4, "op5_ngram_join": OP5, "op6_suffix_dedup": OP6}
