"""Near duplicates of embeddings by a robust-pruned flat graph.

Equal vectors become one. Vectors go to the shards of their nearest centroids, two each, so that shards overlap; very
large shards are split once more by centroids of their own, and what is still large is cut into slices. In every slice a flat graph is built: each vector keeps neighbours that no closer neighbour
covers (robust pruning). The adjacency lists that a vector has from its shards are united. Then every vector searches
the slices of its shards: greedily from the slice's medoid until its surroundings are reached, and on from every vector
in range to all of that one's neighbours until none is left in range. What is found is verified in double precision.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import connected_components, stored
from .topk import usable

#: Rows of a shard on average, rows of a slice, shards a vector goes to; neighbours kept and how many of
#: them are far, slack of the pruning, width of
#: the greedy search; rows that centroids are fitted on and how many of those there are at most.
SHARD, SLICE, OVERLAP = 1000, 2000, 2
DEGREE, FAR, ALPHA, BEAM = 24, 8, 1.2, 24
FIT_ROWS, MOST_CENTROIDS = 20_000, 2048
#: Rows from which on a shard is split by centroids of its own, the sample that these are fitted on, and rows that a
#: task assigns.
SPLIT, FIT_SPLIT, PART = 16_000, 20_000, 20_000
#: Rows that the audit asks for at a time.
AUDIT = 5000


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length 1 in double precision; scaled first, so that squares neither overflow nor vanish."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def centroids(x: np.ndarray, k: int, seed: int = 9, rounds: int = 6) -> np.ndarray:
    """Spherical k-means on the bounded sample."""
    c = x[np.random.default_rng(seed).choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        own = (x @ c.T).argmax(1)
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(size > 1e-9, total / np.maximum(size, 1e-9), c)
    return c


def _covered(own: np.ndarray, dist: np.ndarray, between: np.ndarray, most: int) -> list[int]:
    """Of ``own``, nearest first, those that no kept one is ALPHA times nearer to than the vector; ``most`` at most."""
    kept, left = [], np.ones(len(own), bool)
    for i in range(len(own)):
        if left[i]:
            kept.append(int(own[i]))
            if len(kept) == most:
                break
            left &= ALPHA * between[i] > dist
    return kept


def pruned_graph(x: np.ndarray, seed: int = 4) -> list[np.ndarray]:
    """Robust pruning of the nearest vectors, and of some taken at random, whose long edges lead out of a dense group."""
    n = len(x)
    out = []
    if n < 2:
        return [np.zeros(0, np.int64)] * n
    far = np.random.default_rng(seed).choice(n, min(n, 8 * FAR), replace=False)
    far_between = 2 - 2 * (x[far] @ x[far].T)
    for begin in range(0, n, 512):
        near = x[begin : begin + 512] @ x.T
        near[np.arange(len(near)), np.arange(begin, begin + len(near))] = -2
        m = min(4 * DEGREE, n - 1)
        top = np.argpartition(-near, m - 1, axis=1)[:, :m]
        for i, (row, own) in enumerate(zip(near, top)):
            own = own[np.lexsort((own, -row[own]))]
            kept = _covered(own, 2 - 2 * row[own], 2 - 2 * (x[own] @ x[own].T), DEGREE - FAR)
            order = np.argsort(-row[far], kind="stable")
            order = order[far[order] != begin + i]
            kept += _covered(far[order], 2 - 2 * row[far[order]], far_between[np.ix_(order, order)], FAR)
            out.append(np.unique(kept))
    return out


def search(q: np.ndarray, start: int, x: np.ndarray, edges: list[np.ndarray], limit: float) -> np.ndarray:
    """Vectors within ``limit`` of q: greedy from ``start``, then on from everything in range."""
    seen = np.zeros(len(x), bool)
    seen[start] = True
    ids, score = np.array([start]), np.array([float(x[start] @ q)])
    done = np.zeros(1, bool)
    while True:
        # The best unexpanded of the beam; everything in range belongs to it, whatever its width.
        wide = np.flatnonzero(~done & ((np.arange(len(ids)) < BEAM) | (score >= limit)))
        if len(wide) == 0:
            return ids[score >= limit]
        take = wide[:8] if score[wide[0]] < limit else wide[score[wide] >= limit]
        done[take] = True
        new = np.unique(np.concatenate([edges[i] for i in ids[take].tolist()]))
        new = new[~seen[new]]
        if len(new) == 0:
            continue
        seen[new] = True
        ids, score, done = np.concatenate([ids, new]), np.concatenate([score, x[new] @ q]), np.concatenate([done, np.zeros(len(new), bool)])
        order = np.argsort(-score, kind="stable")
        ids, score, done = ids[order], score[order], done[order]


def _vectors(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy().reshape(rows, -1).astype(np.float64)


def _split(placed: DataFrame) -> DataFrame:
    """Rows with ``shards``, those of shards over SPLIT rows replaced by the nearest of the shard's own centroids.

    A large shard's centroids are fitted on a bounded sample of it, in one task a shard; its rows are then assigned in
    tasks of about PART rows, each with a copy of these centroids.
    """
    each = placed.withColumn("shard", F.explode("shards"))
    large = stored(each.groupBy("d", "shard").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > SPLIT), "large")
    if large.isEmpty():
        return placed
    placed = stored(placed, "assigned")
    each = placed.withColumn("shard", F.explode("shards")).join(large, ["d", "shard"], "left").drop("shards")
    dice = F.pmod(F.xxhash64(F.lit(7), "rep"), F.lit(1 << 40))
    some = each.where(F.col("rows").isNotNull() & (dice < F.least(F.lit(1.0), F.lit(float(FIT_SPLIT)) / F.col("rows")) * F.lit(float(1 << 40))))

    def fit(group: pa.Table) -> pa.Table:
        group = group.sort_by("rep")
        k = min(MOST_CENTROIDS, max(2, group.column("rows")[0].as_py() // SHARD), group.num_rows)
        found = centroids(unit(_vectors(group.column("v"), group.num_rows)), k)
        return pa.table({"d": group.column("d")[:1].take([0] * len(found)), "shard": group.column("shard")[:1].take([0] * len(found)), "rows": group.column("rows")[:1].take([0] * len(found)), "no": pa.array(range(len(found)), pa.int64()), "v": pa.array(found.tolist(), pa.list_(pa.float64()))})

    fitted = stored(some.select("d", "shard", "rows", "rep", "v").groupBy("d", "shard").applyInArrow(fit, "d int, shard long, rows long, no long, v array<double>"), "centroids")
    parts = F.ceil(F.col("rows") / PART).cast("int")
    asking = each.where("rows IS NOT NULL").withColumn("part", F.pmod(F.xxhash64(F.lit(8), "rep"), parts).cast("int")).select("d", "shard", "part", "rep", "v")
    copies = fitted.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).select("d", "shard", "part", "no", "v")

    def assign(rows: pa.Table, own: pa.Table) -> pa.Table:
        if own.num_rows == 0 or rows.num_rows == 0:
            return pa.table({"rep": rows.column("rep"), "shards": pa.array([[_inner(s, 0)] for s in rows.column("shard").to_pylist()], pa.list_(pa.int64()))})
        own, shard = own.sort_by("no"), rows.column("shard")[0].as_py()
        near = unit(_vectors(rows.column("v"), rows.num_rows)) @ _vectors(own.column("v"), own.num_rows).T
        best = np.argsort(-near, axis=1, kind="stable")[:, :OVERLAP]
        return pa.table({"rep": rows.column("rep"), "shards": pa.array([[_inner(shard, i) for i in b] for b in best.tolist()], pa.list_(pa.int64()))})

    inner = asking.groupBy("d", "shard", "part").cogroup(copies.groupBy("d", "shard", "part")).applyInArrow(assign, "rep long, shards array<long>")
    every = inner.unionByName(each.where("rows IS NULL").select("rep", F.array("shard").alias("shards")))
    united = every.groupBy("rep").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("shards")))).alias("shards"))  # at most four
    return placed.drop("shards").join(united, "rep")


def _inner(shard: int, i: int) -> int:
    """Number of a shard's i-th part, beyond those of all whole shards."""
    return (shard + 1) * (1 << 20) + i


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept): rows linked by cosine >= ``threshold`` in double precision.

    ``n_links`` counts other rows linked directly, copies included; ``component_id`` is the smallest id that links
    reach; ``kept`` marks it. Vectors that are null, empty, zero or hold null or non-finite components, and rows with
    a null id, link with nothing. Vectors of different length link with nothing. Rows that repeat an id with the same
    vector are one row; an empty table gives an empty one. The search is approximate: ``audit`` measures it.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("v"), (usable(vec_col) & F.coalesce(F.exists(vec_col, lambda c: c != 0), F.lit(False)) & F.col(id_col).isNotNull()).alias("ok")).distinct()
    ok = rows.where("ok").select("vec_id", F.transform("v", lambda c: c.cast("double") + F.lit(0.0)).alias("v"))
    # Equal vectors are one from here on: the smallest id stands for them, and counts as many times as it has rows.
    copies = stored(ok.withColumn("name", F.sha2(F.array_join(F.transform("v", lambda c: c.cast("string")), ","), 256)).select("vec_id", "name", "v"), "vectors")
    reps = stored(copies.groupBy("name").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"), F.first("v").alias("v")).withColumn("d", F.size("v")), "distinct")
    count = reps.count()

    # A bounded sample fits the centroids of each length of vector; every row is indexed.
    # A length that the sample lacks is one shard, in slices.
    share = min(1.0, FIT_ROWS / max(1, count))
    got = reps.where(F.pmod(F.xxhash64(F.lit(3), "rep"), F.lit(1 << 40)) < int(share * (1 << 40))).select("d", "v").collect()
    k = min(MOST_CENTROIDS, max(1, count // SHARD))
    fitted = {d: centroids(unit(np.array([r[1] for r in got if r[0] == d])), k) for d in {r[0] for r in got}}

    def assign(batches):
        for batch in batches:
            out = []
            for d, v in zip(batch.column("d").to_pylist(), batch.column("v").to_pylist()):
                if d not in fitted:
                    out.append([0])
                    continue
                near = fitted[d] @ unit(np.array([v], np.float64))[0]
                out.append(sorted(np.argsort(-near, kind="stable")[:OVERLAP].tolist()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int64()))], names=[*batch.schema.names, "shards"])

    schema = "rep long, n long, v array<double>, d int, shards array<long>"
    placed = _split(reps.select("rep", "n", "v", "d").mapInArrow(assign, schema)).withColumn("shard", F.explode("shards"))
    size = placed.groupBy("d", "shard").agg(F.ceil(F.count(F.lit(1)) / SLICE).cast("int").alias("slices"))
    placed = placed.join(F.broadcast(size), ["d", "shard"]).withColumn("slice", F.pmod(F.xxhash64(F.lit(5), "rep"), "slices").cast("int"))
    placed = stored(placed, "shards")

    def build(group: pa.Table) -> pa.Table:
        group = group.sort_by("rep")
        ids = group.column("rep").to_numpy()
        edges = pruned_graph(unit(_vectors(group.column("v"), len(ids))))
        return pa.table({"rep": pa.array(ids, pa.int64()), "edges": pa.array([ids[e].tolist() for e in edges], pa.list_(pa.int64()))})

    lists = placed.groupBy("d", "shard", "slice").applyInArrow(build, "rep long, edges array<long>")
    united = lists.groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("edges"))).alias("edges"))  # one list a shard
    nodes = placed.join(united, "rep")
    # A slice is searched by each slice of its shard.
    base = nodes.withColumn("asks", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).withColumn("is_base", F.lit(True))
    asking = placed.withColumn("edges", F.lit(None).cast("array<long>")).withColumn("asks", F.col("slice")).withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).withColumn("is_base", F.lit(False))
    columns = ["d", "shard", "slice", "asks", "is_base", "rep", "n", "v", "shards", "edges"]

    def find(group: pa.Table) -> pa.Table:
        group = group.sort_by([("is_base", "descending"), ("rep", "ascending")])
        is_base = np.array(group.column("is_base").to_pylist())
        nb, ids, times = int(is_base.sum()), group.column("rep").to_numpy(), group.column("n").to_numpy()
        shard = group.column("shard")[0].as_py()
        x = unit(_vectors(group.column("v"), len(ids)))
        base, at = x[:nb], {r: i for i, r in enumerate(ids[:nb].tolist())}
        edges = [np.array([at[e] for e in own or () if e in at], np.int64) for own in group.column("edges").to_pylist()[:nb]]
        # Robust pruning leaves one-way edges; both ways keep everything within reach.
        back: list[list[int]] = [[] for _ in range(nb)]
        for i, e in enumerate(edges):
            for j in e.tolist():
                back[j].append(i)
        edges = [np.unique(np.concatenate([e, np.array(b, np.int64)])) for e, b in zip(edges, back)]
        medoid = int((base @ base.mean(0)).argmax()) if nb else 0
        shards = [tuple(s) for s in group.column("shards").to_pylist()]
        # Links that join what earlier ones have not: their classes are those of all links found here.
        own = np.unique(ids, return_inverse=True)[1]
        out = []
        for q in range(nb, len(ids)) if nb else ():
            found = search(x[q], medoid, base, edges, threshold - 1e-9)
            found = found[((base[found] * x[q]).sum(1) >= threshold) & (ids[found] != ids[q])]
            # A pair that shares several shards counts in the first of them.
            links = sum(int(times[f]) for f in found.tolist() if min(s for s in shards[f] if s in shards[q]) == shard)
            if len(found):
                joined, at = np.unique(own[found], return_index=True)
                new = joined != own[q]
                out.append((int(ids[q]), links, ids[found[at[new]]].tolist()))
                own[np.isin(own, joined[new])] = own[q]
        return pa.table({"rep": pa.array([o[0] for o in out], pa.int64()), "links": pa.array([o[1] for o in out], pa.int64()), "to": pa.array([o[2] for o in out], pa.list_(pa.int64()))})

    found = base.select(columns).unionByName(asking.select(columns)).groupBy("d", "shard", "slice", "asks").applyInArrow(find, "rep long, links long, to array<long>")
    found = stored(found, "found")
    root = connected_components(found.select("rep", F.explode("to").alias("to")), "rep", "to").withColumnRenamed("node", "rep")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    of = reps.select("rep", "name", "n").join(links, "rep", "left").join(root, "rep", "left")
    of = of.select("name", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    linked = copies.select("vec_id", "name").join(of, "name").select("vec_id", "n_links", "component_id")
    alone = rows.where("NOT ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def recall(vectors: DataFrame, result: DataFrame, every: int = 50, threshold: float = 0.95, id_col: str = "vec_id", vec_col: str = "embedding") -> float:
    """The audit: links found over links there are, for the rows whose id ``every`` divides, by brute force.

    Those rows are held against all in blocks of AUDIT rows, one block at the driver at a time.
    """
    ok = vectors.where(usable(vec_col) & F.exists(vec_col, lambda c: c != 0)).select(F.col(id_col).alias("id"), F.col(vec_col).alias("v"))
    asking = ok.where(F.col("id") % every == 0)
    blocks = -(-asking.count() // AUDIT)
    got = result.select(F.col("vec_id").alias("id"), "n_links")
    there = found = 0
    for i in range(blocks):
        asked = asking.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == i).collect()
        if not asked:
            continue
        q_id, q = np.array([r[0] for r in asked], np.int64), unit(np.array([r[1] for r in asked], np.float64))

        def count(batches, q_id=q_id, q=q):
            for batch in batches:
                ids, x = batch.column("id").to_numpy(), unit(_vectors(pa.chunked_array([batch.column("v")]), batch.num_rows))
                hit = (q @ x.T >= threshold) & (q_id[:, None] != ids[None, :])
                yield pa.RecordBatch.from_arrays([pa.array(q_id), pa.array(hit.sum(1), pa.int64())], names=["id", "n"])

        true = ok.mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
        r = true.join(got, "id").agg(F.sum("n"), F.sum(F.least("n", "n_links"))).first()
        there, found = there + (r[0] or 0), found + (r[1] or 0)
    return found / there if there else 1.0


def audit(vectors: DataFrame, every: int = 50, threshold: float = 0.95, id_col: str = "vec_id", vec_col: str = "embedding") -> float:
    """``recall`` of links between different vectors: one row stands for its copies, so that these don't count."""
    ok = vectors.where(usable(vec_col) & F.exists(vec_col, lambda c: c != 0) & F.col(id_col).isNotNull())
    single = stored(ok.groupBy(F.col(vec_col).alias("v")).agg(F.min(F.col(id_col).cast("long")).alias("id")), "single")
    return recall(single, near_duplicates(single, threshold, "id", "v"), every, threshold, "id", "v")
