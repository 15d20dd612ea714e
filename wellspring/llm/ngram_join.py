"""N-gram Jaccard self-join: sets in a global order, prefixes to find candidates, and tries to verify them.

The global order of n-grams is by document frequency, then by hash. Two sets that are similar enough share an n-gram in
their first elements (n less the required overlap, plus one), and the first n-gram they share leaves enough elements
after it; n-grams that no other set has never count. Candidate sets are put in a trie by the global order, which the
set that they are held against walks: the overlap of shared prefixes is carried on, and a subtree is left as soon as
what remains cannot reach the required overlap.

Only classes are asked for, so candidates that are known to be in one class already are not compared again. First every
set is held against one set that leads some of its n-grams, then against the leaders that are still in other classes;
what these links leave undecided is compared in full: pair by pair where few sets have an n-gram, else by tries of all
sets around the n-gram's largest class, so that a large group of near copies never becomes rows of pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import blocks as B
from .shared import connected_components, merge_components, release, stored

#: Sets of a trie in a task, about.
GROUP = 2000
#: Sets of a shingle up to which its pairs are rows; beyond, sets travel and a trie finds the pairs.
FEW = 64
_MULT = np.uint64(0x9E3779B97F4A7C15)


def word_hash(word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


def shingle_sets(texts: B.Texts, n: int, known: dict[bytes, int] | None = None) -> list[np.ndarray]:
    """Of every text the rising distinct 64-bit hashes of its n-word shingles (A-Z lower-cased, ASCII white space).

    A text of fewer words has one shingle, its whole word sequence; one without words has none.
    """
    known = {} if known is None else known
    out = []
    for text in texts:
        words = text.lower().split()
        for w in set(words).difference(known):
            known[w] = word_hash(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        if 0 < len(h) < n:
            h = np.array([word_hash(b"\0".join(words) + b"\0%d" % len(words))], np.uint64)
        elif len(h):
            x = h[: len(h) - n + 1].copy()
            for i in range(1, n):
                x ^= x >> np.uint64(31)
                x = x * _MULT + h[i : len(h) - n + 1 + i]
            x ^= x >> np.uint64(29)
            h = np.unique(x * _MULT)
        out.append(h)
    return out


def set_id(h: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(h.tobytes(), digest_size=8).digest(), "little", signed=True)


def needed(a: int, b: int, percent: int) -> int:
    """Least overlap of sets of sizes a and b with 100 * overlap >= percent * union."""
    return -(-percent * (a + b) // (100 + percent))


class SetTrie:
    """Sets in the global order as a trie with compressed paths, walked level by level.

    A node holds a run of elements that all sets below it share; runs end where sets part, where a set ends, and at
    depths that are powers of two, so that a long run can be left half way. A walk carries the overlap of each node's
    path on to its children and leaves a subtree as soon as what remains of either side cannot reach the overlap needed.
    """

    def __init__(self, sets: Sequence[np.ndarray]):
        order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
        self.alphabet = np.unique(np.concatenate([*sets, np.zeros(0, np.uint64)]))
        parent, begin, end, owner, low, high, ends_here = [-1], [0], [0], [-1], [1 << 60], [0], [[]]
        stack = [0]  # the path to the last set, root first

        def node(up: int, first: int, last: int, i: int) -> int:
            parent.append(up), begin.append(first), end.append(last), owner.append(i)
            low.append(1 << 60), high.append(0), ends_here.append([])
            return len(parent) - 1

        before = np.zeros(0, np.uint64)
        for i in order:
            own = sets[i]
            k = min(len(own), len(before))
            differ = np.flatnonzero(own[:k] != before[:k])
            shared = int(differ[0]) if len(differ) else k
            while end[stack[-1]] > shared and begin[stack[-1]] >= shared:
                stack.pop()
            top = stack[-1]
            if end[top] > shared:  # the run is cut in two: the upper part is new, the rest stays below it
                upper = node(parent[top], begin[top], shared, owner[top])
                parent[top], begin[top] = upper, shared
                stack[-1] = upper
                low[upper], high[upper] = low[top], high[top]
            depth = shared
            while depth < len(own):
                stop = min(len(own), max(16, 1 << depth.bit_length()))
                stack.append(node(stack[-1], depth, stop, i))
                depth = stop
            ends_here[stack[-1]].append(i)
            for n in stack:
                low[n], high[n] = min(low[n], len(own)), max(high[n], len(own))
            before = own
        # Cutting a run moves what is below it one level down, so levels are counted once the trie stands.
        children: list[list[int]] = [[] for _ in parent]
        for n in range(1, len(parent)):
            children[parent[n]].append(n)
        rows, front = [], [0]
        while front:
            rows.append(front)
            front = [c for n in front for c in children[n]]
        every = [n for row in rows for n in row]
        at = np.empty(len(parent), np.int64)
        at[every] = np.arange(len(every))
        self.levels = np.cumsum([0, *map(len, rows)])
        self.parent = at[[max(0, parent[n]) for n in every]]
        self.depth, self.low, self.high = (np.array([x[n] for n in every], np.int64) for x in (end, low, high))
        runs = [sets[owner[n]][begin[n] : end[n]] if n else np.zeros(0, np.uint64) for n in every]
        self.run = np.concatenate([[0], np.cumsum([len(r) for r in runs])])
        self.elements = np.searchsorted(self.alphabet, np.concatenate(runs))
        self.ends_here = [ends_here[n] for n in every]
        self.full = np.array([len(e) > 0 for e in self.ends_here])
        self.visited = 0

    def linked(self, own: np.ndarray, percent: int) -> list[tuple[int, int]]:
        """(number of the set, overlap) of all sets with 100 * overlap >= ``percent`` * union with ``own``."""
        inside = np.zeros(len(self.alphabet) + 1, bool)
        at = np.searchsorted(self.alphabet, own)
        known = at < len(self.alphabet)
        known[known] = self.alphabet[at[known]] == own[known]
        inside[at[known]] = True
        # Elements of own up to and with each element of the trie's alphabet.
        upto = np.searchsorted(own, self.alphabet, "right")
        out, n = [], len(own)
        nodes, over = np.zeros(1, np.int64), np.zeros(1, np.int64)
        overlap = np.zeros(len(self.parent), np.int64)
        for k in range(len(self.levels) - 1):
            if k:
                nodes = np.arange(self.levels[k], self.levels[k + 1])
                nodes = nodes[overlap[self.parent[nodes]] >= 0]
                if len(nodes) == 0:
                    overlap[self.levels[k] : self.levels[k + 1]] = -1
                    break
                first, size = self.run[nodes], self.run[nodes + 1] - self.run[nodes]
                begin = np.concatenate([[0], np.cumsum(size)[:-1]])
                here = self.elements[np.repeat(first - begin, size) + np.arange(int(size.sum()))]
                over = overlap[self.parent[nodes]] + np.add.reduceat(inside[here].astype(np.int64), begin)
                left = n - upto[here[begin + size - 1]]
                self.visited += len(nodes)
            else:
                left = np.full(1, n)
            depth = self.depth[nodes]
            if self.full[nodes].any():
                for j in np.flatnonzero(self.full[nodes] & ((100 + percent) * over >= percent * (n + depth))).tolist():
                    out += [(i, int(over[j])) for i in self.ends_here[nodes[j]]]
            # The best size below a node is the one at which both sides run out together.
            best = np.clip(depth + left, self.low[nodes], self.high[nodes])
            alive = (100 + percent) * (over + np.minimum(left, best - depth)) >= percent * (n + best)
            overlap[self.levels[k] : self.levels[k + 1]] = -1
            overlap[nodes] = np.where(alive, over, -1)
        return out


_ROWS = "kind int, a long, b long, c int, d int, payload binary"


def jaccard_classes(docs: DataFrame, n: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id): classes of rows linked by 100 * intersection >= ``percent`` * union.

    ``component_id`` is the smallest id that links reach. Rows without words (null, empty, white space) link with
    nothing; rows with a null id neither (their component is null). Equal sets link, repeated rows included. An empty
    table gives an empty one. Shingles are told apart by 64-bit
    hashes, of which 48 bits and the frequency serve in a comparison of two sets.

    Blocks ask for the document frequency of their shingles. What travels as rows afterwards is one row per shared
    prefix shingle, and the sets of documents that have one.
    """
    table = B.blocks(docs, id_col, text_col)
    scale = B.Scale.of(B.total_bytes(table) / 5, 12)

    def distinct_sets(payload: bytes) -> tuple[B.Texts, list[np.ndarray], list[int], dict[int, int]]:
        t = B.unpack_texts(payload)
        sets = shingle_sets(t, n)
        ids = [set_id(s) if len(s) else 0 for s in sets]
        return t, sets, ids, {k: i for i, k in enumerate(ids) if len(sets[i])}

    def counted(sets: list[np.ndarray], own: dict[int, int]) -> B.Asked:
        every = np.concatenate([sets[i] for i in own.values()] or [np.zeros(0, np.uint64)])
        cut, df = np.unique(scale.cut(every), return_counts=True)
        return cut << np.uint64(64 - scale.bits), df.astype(np.uint32)

    def keys_of(payload: bytes) -> B.Asked:
        _, sets, _, own = distinct_sets(payload)
        return counted(sets, own)

    frequency = B.totals(B.ask(table, scale, keys_of))

    def prefixes(block: int, payload: bytes, answers: pa.Table) -> pa.Table:
        t, sets, ids, own = distinct_sets(payload)
        keys, df = counted(sets, own)[0] >> np.uint64(64 - scale.bits), B.told(answers)
        size = np.fromiter(map(len, sets), np.int64, len(sets))
        none = np.zeros(len(t.ids), np.int64)
        parts = [(none, t.ids, np.array(ids, np.int64), size, none, [None] * len(ids))]
        for key, i in own.items():
            s = sets[i]
            f = np.minimum(df[np.searchsorted(keys, scale.cut(s))], 65535).astype(np.uint64)
            order = np.sort(f << np.uint64(48) | s >> np.uint64(16))
            prefix = order[: len(s) - -(-percent * len(s) // 100) + 1]
            at = np.flatnonzero(prefix >> np.uint64(48) > 1)
            if len(at):
                k = len(at)
                parts.append((np.ones(k, np.int64), prefix[at].view(np.int64), np.full(k, key), np.full(k, len(s)), at, [None] * k))
                # Verified as a set, in the global order; the elements' hashes without their frequencies.
                parts.append((np.array([2]), np.array([0]), np.array([key]), np.array([len(s)]), np.array([0]), [B.pack(order, rising=True)]))
        kind, a, b, c, d = (np.concatenate([p[j] for p in parts]) for j in range(5))
        return pa.table({"kind": pa.array(kind, pa.int32()), "a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "c": pa.array(c, pa.int32()), "d": pa.array(d, pa.int32()), "payload": pa.array([x for p in parts for x in p[5]], pa.binary())})

    rows = stored(B.tell(table, {0: frequency}, prefixes, _ROWS), "prefixes")
    release(docs.sparkSession)
    members = rows.where("kind = 0").select(F.col("a").alias("doc_id"), F.col("b").alias("set_id"), F.col("c").alias("size"))
    sets = rows.where("kind = 2").groupBy(F.col("b").alias("set_id")).agg(F.first("payload").alias("payload"))
    entries = rows.where("kind = 1").select(F.col("a").alias("token"), F.col("b").alias("set_id"), F.col("c").alias("size"), F.col("d").alias("place")).distinct()

    root = _classes(entries, sets, percent)
    # A set stands for its smallest document, and a class of sets for the smallest of those.
    least = members.where("size > 0").groupBy("set_id").agg(F.min("doc_id").alias("least"))
    of = least.join(root, least["set_id"] == root["node"], "left").select("set_id", "least", F.coalesce("component", "set_id").alias("class"))
    of = of.join(of.groupBy("class").agg(F.min("least").alias("root")), "class").select("set_id", "root")
    own = members.join(of, "set_id", "left")
    out = own.select("doc_id", F.col("size").cast("long").alias("n_shingles"), F.when(F.col("size") > 0, F.col("root")).otherwise(F.col("doc_id")).alias("component_id"))
    nameless = docs.where(F.col(id_col).isNull()).select(F.col(text_col).cast("binary").alias("text"))

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [t or b"" for t in batch.column(0).to_pylist()]
            sizes = [len(s) for s in shingle_sets(B.Texts(np.zeros(len(raw), np.int64), np.cumsum([0, *map(len, raw)]), b"".join(raw)), n)]
            none = pa.nulls(len(raw), pa.int64())
            yield pa.RecordBatch.from_arrays([none, pa.array(sizes, pa.int64()), none], names=["doc_id", "n_shingles", "component_id"])

    return out.unionByName(nameless.mapInArrow(alone, "doc_id long, n_shingles long, component_id long"))


def _positional(percent: int) -> Column:
    """Whether two sets whose first shared shingle is this one can overlap enough."""
    left = F.least(F.col("x.size") - F.col("x.place"), F.col("y.size") - F.col("y.place"))
    return left * (100 + percent) >= percent * (F.col("x.size") + F.col("y.size"))


def _classes(entries: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(node, component): classes of linked sets; sets without a link are absent."""
    both = [F.least("x.set_id", "y.set_id").alias("a"), F.greatest("x.set_id", "y.set_id").alias("b")]
    # A shingle's leader is its smallest set. A shingle may lead very many sets: the minimum is taken before the
    # shuffle and the join is split by adaptive execution.
    lead = entries.groupBy("token").agg(F.min(F.struct("set_id", "size", "place")).alias("l"), F.count(F.lit(1)).alias("n")).where("n > 1").select("token", "l.*")
    # Each set first meets the smallest of its leaders alone: of a large class little is open after that.
    met = entries.alias("y").join(lead.alias("x"), "token").where((F.col("x.set_id") != F.col("y.set_id")) & _positional(percent))
    first = met.groupBy(F.col("y.set_id").alias("b")).agg(F.min("x.set_id").alias("a")).select("a", "b")
    checked = stored(_verify(stored(first, "pairs"), sets, percent), "links")
    root = stored(connected_components(checked.where("linked"), "a", "b"), "classes")

    def rooted() -> DataFrame:
        own = entries.join(root, entries["set_id"] == root["node"], "left")
        return stored(own.select("token", "set_id", "size", "place", F.coalesce("component", "set_id").alias("root")), "entries")

    of = rooted()
    lead = of.groupBy("token").agg(F.min(F.struct("set_id", "size", "place", "root")).alias("l"), F.count(F.lit(1)).alias("n")).where("n > 1").select("token", "l.*")
    met = of.alias("y").join(lead.alias("x"), "token").where((F.col("x.root") != F.col("y.root")) & _positional(percent))
    more = stored(_verify(stored(met.select(*both).distinct().join(checked.select("a", "b"), ["a", "b"], "left_anti"), "pairs"), sets, percent), "links")
    checked = checked.unionByName(more)
    root = stored(merge_components(root, more.where("linked"), "a", "b"), "classes")
    of = rooted()
    # Shingles of more than one class: sets outside the shingle's largest class against all others of it.
    per = of.groupBy("token", "root").agg(F.count(F.lit(1)).alias("n"))
    mixed = per.groupBy("token").agg(F.max(F.struct("n", "root")).alias("most"), F.sum("n").alias("sets"), F.count(F.lit(1)).alias("k")).where("k > 1")
    rest = stored(of.join(mixed.select("token", F.col("most.root").alias("main"), "sets"), "token"), "mixed")
    few = rest.where(F.col("sets") <= FEW)
    cross = few.where("root <> main").alias("x").join(few.alias("y"), "token").where((F.col("x.root") != F.col("y.root")) & _positional(percent))
    last = cross.select(*both).distinct().join(checked.select("a", "b"), ["a", "b"], "left_anti")
    links = _verify(stored(last, "pairs"), sets, percent).where("linked").select("a", "b")
    links = stored(links.unionByName(_hubs(rest.where(F.col("sets") > FEW), sets, percent)), "links")
    return stored(merge_components(root, links, "a", "b"), "classes")


def _hubs(rest: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links that join the classes of shingles that more than FEW sets have.

    Around the largest class of such a shingle, its hub, all sets outside it are held against all sets of the hub's
    shingles, by a trie of those. No row stands for a pair: sets travel, once for each slice of what they are held
    against, and links come back that join classes which the slice's other links have not. Linked sets differ in size
    by ``percent`` at most, so sets of one band of sizes meet those of this band and its neighbours only.
    """
    # A little less than the logarithm, so that rounding never sets linked sets two bands apart.
    band = F.floor(F.log(F.col("size").cast("double")) * ((1 - 1e-9) / math.log(max(1.01, 100 / percent))))
    sized = rest.groupBy("main", "set_id").agg(F.first("root").alias("root"), F.first("size").alias("size")).withColumn("band", band)
    of = sized.select("main", "set_id", "root", "band")
    ask = of.where("root <> main").withColumn("band", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)))
    slices = lambda n: F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias(n)
    cut = of.groupBy("main", "band").agg(slices("held")).join(ask.groupBy("main", "band").agg(slices("asking")), ["main", "band"])
    to = lambda n, by: F.explode(F.sequence(F.lit(0), F.col(by) - 1)).alias(n)
    own = lambda by: F.pmod(F.xxhash64("set_id"), F.col(by)).cast("int")
    base = of.join(cut, ["main", "band"]).withColumn("i", own("held")).select("main", "band", "i", to("j", "asking"), "set_id", "root", F.lit(True).alias("base"))
    asks = ask.join(cut, ["main", "band"]).withColumn("j", own("asking")).select("main", "band", to("i", "held"), "j", "set_id", "root", F.lit(False).alias("base"))
    met = base.select("main", "band", "i", "j", "set_id", "root", "base").unionByName(asks.select("main", "band", "i", "j", "set_id", "root", "base"))

    def run(group: pa.Table) -> pa.Table:
        B.trim()
        group = group.sort_by([("base", "descending"), ("set_id", "ascending")])
        ids, roots, base = (group.column(c).to_pylist() for c in ("set_id", "root", "base"))
        found = [B.unpack(p.as_py(), rising=True)[0] for p in group.column("payload")]
        n = sum(base)
        trie, up, out = SetTrie(found[:n]), {}, []

        def top(c: int) -> int:
            while c in up:
                c = up[c]
            return c

        for k in range(n, len(ids)):
            for i, _ in trie.linked(found[k], percent):
                x, y = top(roots[k]), top(roots[i])
                if x != y:
                    up[max(x, y)] = min(x, y)
                    out.append((min(ids[k], ids[i]), max(ids[k], ids[i])))
        return pa.table({"a": pa.array([o[0] for o in out], pa.int64()), "b": pa.array([o[1] for o in out], pa.int64())})

    return met.join(sets, "set_id").groupBy("main", "band", "i", "j").applyInArrow(run, "a long, b long")


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, linked): a's set walks the trie of its candidates b, in slices if there are many of them."""
    many = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias("slices")).where("slices > 1")
    met = pairs.join(many, "a", "left").select("a", F.pmod(F.xxhash64("b"), F.coalesce("slices", F.lit(1))).cast("int").alias("slice"), "b", F.lit(False).alias("head"))
    heads = met.select("a", "slice").distinct().select("a", "slice", F.col("a").alias("b"), F.lit(True).alias("head"))
    held = met.unionByName(heads).join(sets.withColumnRenamed("set_id", "b"), "b")

    def run(group: pa.Table) -> pa.Table:
        a, b, head = group.column("a")[0].as_py(), group.column("b").to_pylist(), group.column("head").to_pylist()
        found = [B.unpack(p.as_py(), rising=True)[0] for p in group.column("payload")]
        own = found[head.index(True)]
        under = [i for i, h in enumerate(head) if not h]
        hit = {i for i, _ in SetTrie([found[i] for i in under]).linked(own, percent)}
        return pa.table({"a": pa.array([a] * len(under), pa.int64()), "b": pa.array([b[i] for i in under], pa.int64()), "linked": pa.array([k in hit for k in range(len(under))], pa.bool_())})

    return held.groupBy("a", "slice").applyInArrow(run, "a long, b long, linked boolean")
