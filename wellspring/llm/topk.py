"""Exact top-k search by inner product with vector-approximation files."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a block of candidates (at least, at most) and queries in a block; a task holds one block of each.
BLOCK, QUERIES, CELL_BITS = (1024, 32768), 1024, 6
#: Sums up to here are whole numbers in double precision.
MOST_EXACT = float(1 << 53)


def usable(vec: str) -> Column:
    """Neither null nor empty nor with null or non-finite components."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.col(vec).isNotNull() & (F.size(vec) > 0) & ~F.coalesce(F.exists(vec, bad), F.lit(False))


def cells(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The approximation file: per dimension the cell of each component, and the cells' lower and upper bounds."""
    low, high = x.min(0), x.max(0)
    n = 1 << CELL_BITS
    edges = low[:, None] + np.ceil((high - low)[:, None] * np.arange(n + 1) / n)
    cell = np.empty(x.shape, np.uint8)
    for d in range(x.shape[1]):
        cell[:, d] = np.clip(np.searchsorted(edges[d], x[:, d], "right") - 1, 0, n - 1)
    upper = np.maximum(edges[:, 1:], edges[:, :-1])
    return cell, edges[:, :-1], upper


def search(q: np.ndarray, q_id: np.ndarray, x: np.ndarray, x_id: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(query id, vector id, score) of the k best of a block for every query.

    Bounds come from the cells alone. Vectors are then read in the order of their upper bounds, until the kth best
    score exceeds the next bound; equal scores go to the smaller id, so a bound equal to it is still read.
    """
    if float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * x.shape[1] >= MOST_EXACT:
        return _by_whole_numbers(q, q_id, x, x_id, k)
    cell, low, high = cells(x)
    lower, upper = (np.take_along_axis(e.T, cell.astype(np.int64), 0) for e in (low, high))
    out = []
    up, down = np.maximum(q, 0).astype(np.float64), np.minimum(q, 0).astype(np.float64)
    most = up @ upper.T + down @ lower.T  # sums of integers below MOST_EXACT: exact
    least = up @ lower.T + down @ upper.T
    for i in range(len(q)):
        own = x_id != q_id[i]
        n = int(own.sum())
        if n == 0:
            continue
        kth = np.partition(least[i][own], n - min(k, n))[n - min(k, n)]
        read = np.flatnonzero(own & (most[i] >= kth))
        read = read[np.argsort(-most[i][read], kind="stable")]
        best_s, best_id, at = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        while at < len(read) and (len(best_s) < k or most[i][read[at]] >= best_s[k - 1]):
            part = read[at : at + 4 * k]
            best_s, best_id = np.concatenate([best_s, x[part] @ q[i]]), np.concatenate([best_id, x_id[part]])
            order = np.lexsort((best_id, -best_s))[:k]
            best_s, best_id, at = best_s[order], best_id[order], at + 4 * k
        out += [(int(q_id[i]), int(v), int(s)) for v, s in zip(best_id, best_s)]
    return out


def _by_whole_numbers(q: np.ndarray, q_id: np.ndarray, x: np.ndarray, x_id: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """The same for components so large that bounds in double precision would not be exact; scores have to fit a long."""
    rows, out = x.astype(object), []
    for own, i in zip(q.astype(object), q_id.tolist()):
        best = sorted((-int(s), v) for s, v in zip(rows @ own, x_id.tolist()) if v != i)[:k]
        out += [(i, v, -s) for s, v in best]
    if any(abs(s) >= 1 << 63 for *_, s in out):
        raise OverflowError("an inner product does not fit a long")
    return out


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of highest integer inner product for each query row, itself excluded.

    Components become floor(scale * x). Rows whose vector is null, empty or holds null or non-finite components, and
    rows with a null id, take no part; vectors of another length than the query's are no candidates. Rows that repeat
    an id count once (the smallest vector). Scores are exact, however large; one that does not fit a long raises an error. Fewer than k candidates give fewer rows; an empty table gives none.

    Blocks of queries meet blocks of candidates; each pair of blocks is a task of bounded size and hands on at most k
    rows a query. Blocks of candidates grow with the table from 1,024 to 32,768 rows.
    """
    rows = (
        vectors.where(usable(vec_col) & F.col(id_col).isNotNull())
        .select(F.col(id_col).cast("long").alias("id"), F.transform(vec_col, lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("v"), is_query.alias("q"))
        .groupBy("id").agg(F.min("v").alias("v"), F.max("q").alias("q"))
        .withColumn("d", F.size("v"))
    )
    n, n_q = rows.agg(F.count(F.lit(1)), F.count(F.when(F.col("q"), 1))).first()
    block = min(BLOCK[1], max(BLOCK[0], n // 64))
    n_block, n_query = max(1, -(-n // block)), max(1, -(-n_q // QUERIES))
    slot = lambda seed, m: F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(m)).cast("int")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    base = rows.select("d", slot(1, n_block).alias("b"), every(n_query).alias("qb"), F.lit(False).alias("is_q"), "id", "v")
    asked = rows.where("q").select("d", every(n_block).alias("b"), slot(2, n_query).alias("qb"), F.lit(True).alias("is_q"), "id", "v")

    def run(table: pa.Table) -> pa.Table:
        size = table.column("d")[0].as_py()
        v = table.column("v").combine_chunks().flatten().to_numpy().reshape(-1, size)
        ids, is_q = table.column("id").to_numpy(), table.column("is_q").to_numpy()
        found = search(v[is_q], ids[is_q], v[~is_q], ids[~is_q], k) if is_q.any() and not is_q.all() else []
        return pa.table({"query_id": pa.array([f[0] for f in found], pa.int64()), "vec_id": pa.array([f[1] for f in found], pa.int64()), "score": pa.array([f[2] for f in found], pa.int64())})

    found = base.unionByName(asked).groupBy("d", "b", "qb").applyInArrow(run, "query_id long, vec_id long, score long")
    # Of the blocks' results the k best; an array keeps what a query has together small and aggregates before the shuffle.
    best = found.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))).alias("l"))
    top = best.select("query_id", F.posexplode(F.slice("l", 1, k)).alias("p", "e"))
    return top.select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("e.vec_id").alias("vec_id"), (-F.col("e.s")).alias("score"))
