"""Repeated passages by blockwise suffix sorting with cover samples.

Suffixes are sorted one bucket at a time. Which bucket, and how long ties are resolved, follows from a sample of
positions that covers every window of ``length`` bytes: the leftmost of the window's 32-byte strings of least hash. The
sample plays the part of a difference cover and depends on the content of the window only, so that equal windows hold
their sample at the same offset; suffixes that tie for ``length`` bytes therefore tie at their samples, and are resolved
by the sample's rank (its 32-byte name) with the names of what lies before and after it. About one position in 35 is a
sample. Samples that occur once take no further part; the others travel with up to ``length`` bytes around them.

The sort needs names only: a window is repeated if an earlier one (smaller document id, or same document and earlier
start) has the same names. Names are 64-bit fingerprints within one sample rank; every pair that they call equal is held
against each other byte by byte before anything is removed.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import blocks as B
from .shared import release, stored

GRAM, CHUNK = 32, 1 << 19
#: Samples whose windows are named at a time; a rank that more of them share is named at once. Bytes that are held
#: against each other at a time, about.
SLICE, COMPARED = 1 << 16, 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_NAMES = np.random.default_rng(3).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * _ODD
    x ^= b
    x *= _STEP
    x ^= x >> np.uint64(29)
    return x


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hashes of all GRAM-byte strings, by doubling."""
    x = data.astype(np.uint64)
    for step in (1, 2, 4):
        x = x[:-step] | x[step:] << np.uint64(8 * step)
    for step in (8, 16):
        x = _mix(x[:-step], x[step:])
    return x * _ODD


def samples(data: np.ndarray, valid: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with the same sample: (sample's place, first start, last start, sample's hash).

    ``valid`` marks the starts of windows that lie in one document.
    """
    w, found = length - GRAM + 1, []
    low = np.uint64((1 << 20) - 1)
    for begin in range(0, max(0, len(data) - length + 1), CHUNK):
        part = data[begin : begin + CHUNK + length - 1]
        h = gram_hashes(part)
        m = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        size = 1
        while 2 * size <= w:
            m = np.minimum(m[:-size], m[size:])
            size *= 2
        if size < w:
            m = np.minimum(m[: -(w - size)], m[w - size :])
        at, ok = (m & low).astype(np.int64), valid[begin : begin + len(m)]
        new = ok.copy()
        new[1:] &= (at[1:] != at[:-1]) | ~ok[:-1]
        first = np.flatnonzero(new)
        if len(first) == 0:
            continue
        # A run ends where the sample changes or windows stop being valid.
        stop = np.flatnonzero(ok & np.concatenate([(at[1:] != at[:-1]) | ~ok[1:], [True]]))
        # Least hashes are small numbers; spread out they can be dealt by range.
        found.append((at[first] + begin, first + begin, stop + begin, h[at[first]] * _STEP))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found))


def repeated(h: np.ndarray, doc: np.ndarray, place: np.ndarray, low: np.ndarray, high: np.ndarray, pool: np.ndarray, left: np.ndarray, right: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(sample number, offset) of every window that an earlier equal one repeats.

    Sample i lies at ``place[i]`` of document ``doc[i]`` and answers for the windows that start ``low[i]`` to
    ``high[i]`` bytes before it. ``pool[left[i] - 1 - j]`` are the bytes before it and ``pool[right[i] + j]`` those after.
    """
    if len(h) == 0:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    order = np.lexsort((place, doc))
    rank = h[order]
    group = np.argsort(rank, kind="stable")
    srt = rank[group]
    same = np.concatenate([srt[1:] == srt[:-1], [False]])
    same[1:] |= same[:-1].copy()
    group, srt = group[same], srt[same]  # samples whose rank occurs again
    heads = np.flatnonzero(np.concatenate([[True], srt[1:] != srt[:-1]])) if len(srt) else np.zeros(0, np.int64)
    cuts = heads[np.unique(np.searchsorted(heads, np.arange(0, len(srt), SLICE)).clip(max=max(0, len(heads) - 1)))] if len(heads) else heads
    who, offset = [np.zeros(0, np.int32)], [np.zeros(0, np.uint8)]
    for begin, end in zip(cuts, [*cuts[1:], len(srt)]):
        live = order[np.sort(group[begin:end])]  # in the order of documents and places
        w, d = _repeated_slice(*(x[live] for x in (h, doc, place, low, high, left, right)), pool, length)
        who.append(live[w].astype(np.int32))
        offset.append(d)
    return np.concatenate(who), np.concatenate(offset).astype(np.int32)


def _repeated_slice(h: np.ndarray, doc: np.ndarray, place: np.ndarray, low: np.ndarray, high: np.ndarray, left: np.ndarray, right: np.ndarray, pool: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """``repeated`` for whole groups of a rank, in the order of documents and places.

    Windows of one name are held against each other byte by byte; should a name ever stand for two strings, the group
    is named again by the strings themselves.
    """
    for exact in (False, True):
        own, first, offset = _named(h, doc, place, low, high, left, right, pool, length, exact)
        if exact or _equal(own, first, offset, left, pool, length):
            return own, offset
    raise AssertionError


def _equal(own: np.ndarray, first: np.ndarray, offset: np.ndarray, left: np.ndarray, pool: np.ndarray, length: int) -> bool:
    """Whether all windows equal their first one. Windows of a pair at successive offsets are one stretch, read once."""
    order = np.lexsort((offset, first, own))
    o, f, d = own[order], first[order], offset[order].astype(np.int64)
    if len(o) == 0:
        return True
    head = np.flatnonzero(np.concatenate([[True], (o[1:] != o[:-1]) | (f[1:] != f[:-1]) | (d[1:] != d[:-1] + 1)]))
    last = np.concatenate([head[1:], [len(o)]]) - 1
    size = length + d[last] - d[head]
    a, b = left[o[head]] - d[last], left[f[head]] - d[last]
    step = max(1, COMPARED // (length + 256))
    for i in range(0, len(head), step):
        n = size[i : i + step]
        within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        if not np.array_equal(pool[np.repeat(a[i : i + step], n) + within], pool[np.repeat(b[i : i + step], n) + within]):
            return False
    return True


def _named(h: np.ndarray, doc: np.ndarray, place: np.ndarray, low: np.ndarray, high: np.ndarray, left: np.ndarray, right: np.ndarray, pool: np.ndarray, length: int, exact: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sample, sample of the first window of the same name, offset) of every later window."""
    span = length - GRAM
    power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(span, _STEP, np.uint64)]), dtype=np.uint64)
    after = np.zeros(len(h), np.uint64)
    for j in range(span if not exact else 0):  # names of all bytes after the sample that some window needs
        use = np.flatnonzero(span - low > j)
        after[use] += _NAMES[pool[right[use] + j]] * power[j]
    before, who, firsts, offset = np.zeros(len(h), np.uint64), [], [], []
    for d in range(span + 1):
        if d and not exact:
            use = np.flatnonzero(high >= d)
            before[use] += _NAMES[pool[left[use] - d]] * power[d]
            use = np.flatnonzero(low < d)
            after[use] -= _NAMES[pool[right[use] + span - d]] * power[span - d]
        use = np.flatnonzero((low <= d) & (high >= d))
        if len(use) < 2:
            continue
        if exact:
            strings: dict[bytes, int] = {}
            name = np.array([strings.setdefault(pool[x - d : x - d + length].tobytes(), len(strings)) for x in left[use].tolist()], np.uint64)
        else:
            name = _mix(_mix(h[use], before[use]), after[use])
        by = np.argsort(name, kind="stable")
        name = name[by]
        head = np.concatenate([[True], name[1:] != name[:-1]])
        first, own = use[by[np.flatnonzero(head)[np.cumsum(head) - 1]]], use[by]
        later = (doc[own] > doc[first]) | (doc[own] == doc[first]) & (place[own] > place[first])
        who.append(own[later].astype(np.int32))
        firsts.append(first[later].astype(np.int32))
        offset.append(np.full(int(later.sum()), d, np.uint8))
    none = np.zeros(0, np.int32)
    return (np.concatenate(who), np.concatenate(firsts), np.concatenate(offset)) if who else (none, none, np.zeros(0, np.uint8))


class _Block:
    """What of a block takes part: texts that don't repeat an earlier whole text of the block."""

    def __init__(self, payload: bytes, length: int):
        self.texts = t = B.unpack_texts(payload)
        self.data = np.frombuffer(t.data, np.uint8)
        least: dict[bytes, int] = {}
        ids, at = t.ids.tolist(), t.at.tolist()
        for i, text in zip(ids, t):
            least[text] = min(i, least.get(text, i))
        self.valid = np.ones(len(self.data), bool)
        self.whole = np.zeros(len(ids), bool)  # removed as a whole
        for n, text in enumerate(t):
            if ids[n] > least[text] and len(text) >= length:
                self.whole[n] = True
                self.valid[at[n] : at[n + 1]] = False
            else:
                self.valid[max(at[n], at[n + 1] - length + 1) : at[n + 1]] = False
        del least
        self.place, self.first, self.last, self.hash = samples(self.data, self.valid, length)

    def keys(self) -> np.ndarray:
        return np.unique(self.hash)


def runs(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers as runs: (first, length)."""
    starts = np.unique(starts)
    if len(starts) == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    head = np.flatnonzero(np.concatenate([[True], np.diff(starts) > 1]))
    return starts[head].astype(np.uint64), np.diff(np.concatenate([head, [len(starts)]])).astype(np.uint64)


def covered(first: np.ndarray, past: np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` bytes lie in a stretch from ``first`` to before ``past``; stretches may overlap.

    A byte each and little else, where counts of the stretches over each byte would take eight.
    """
    if len(first) == 0:
        return np.zeros(size, bool)
    first, past = np.sort(first), np.sort(past)
    apart = first[1:] > past[:-1]  # all that began before have ended
    begin, end = first[np.concatenate([[True], apart])], past[np.concatenate([apart, [True]])]
    edges = np.concatenate([[0], np.stack([begin, end], 1).ravel(), [size]])
    return np.repeat(np.arange(len(edges) - 1) % 2 == 1, np.diff(edges))


_ROWS = "kind int, bucket int, block long, payload binary"


def _rows(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary())
    return pa.table({n: pa.array([r[i] for r in rows], k) for i, (n, k) in enumerate(zip(("kind", "bucket", "block", "payload"), kinds))})


def remove_repeats(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = (), whole: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) and the columns ``carry``: each row's text without the bytes that earlier windows repeat.

    A byte goes if it lies in a string of ``length`` bytes that also starts earlier in ``docs``: in a smaller id, or in
    the same id at an earlier start; overlapping strings count, and all are judged on the input. ``kept`` (binary) joins
    the remaining UTF-8 bytes, ``n_spans`` counts maximal removed runs. Nothing matches across documents. ``whole``: of a
    character that is cut nothing stays in ``kept``.

    Null texts are empty. Rows with a null id match nothing and keep all bytes. Rows that repeat an id are compared by
    start alone, so equal rows keep each other. An empty table gives an empty one. ``length`` is 32 to 287 bytes; other
    lengths raise an error.
    """
    if not GRAM <= length <= GRAM + 255:
        raise ValueError(f"length is {GRAM} to {GRAM + 255}")
    table = B.blocks(docs, id_col, text_col, carry=carry)
    density = 2.2 / (length - GRAM + 2)
    scale = B.Scale.of(B.total_bytes(table) * density, 12)
    ship = B.Scale(8 * scale.buckets, 64)

    def keys_of(payload: bytes) -> B.Asked:
        keys = _Block(payload, length).keys()
        cut = np.unique(scale.cut(keys)) << np.uint64(64 - scale.bits)
        return cut, np.ones(len(cut), np.uint32)

    counted = B.totals(B.ask(table, scale, keys_of))

    def ship_shared(block: int, payload: bytes, answers: pa.Table) -> pa.Table:
        b = _Block(payload, length)
        row = np.searchsorted(b.texts.at, b.place, "right") - 1
        row_at, doc = b.texts.at[row], b.texts.ids[row]
        place, low, high = b.place - row_at, b.place - b.last, b.place - b.first
        who, offset = repeated(b.hash, doc, place, low, high, b.data, b.place, b.place + GRAM, length)
        out = [(0, 0, block, B.pack(*runs(b.place[who] - offset), rising=True))]
        # Windows that are not the block's first need no other block to be removed.
        left = (high - low + 1) - np.bincount(who, minlength=len(low))
        cut = np.unique(scale.cut(b.hash))
        elsewhere = B.told(answers) > 1
        shared = elsewhere[np.searchsorted(cut, scale.cut(b.hash))] if len(cut) else np.zeros(0, bool)
        pick = np.flatnonzero(shared & (left > 0))
        pick = pick[np.argsort(b.hash[pick], kind="stable")]
        bucket = (b.hash[pick] >> np.uint64(32)).astype(np.uint64) * np.uint64(ship.buckets) >> np.uint64(32)
        for k in np.unique(bucket).tolist():
            own = pick[bucket == k]
            before, after = high[own], length - GRAM - low[own]
            begin, size = b.place[own] - before, before + GRAM + after
            pool = b.data[np.repeat(begin - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())]
            fields = [b.hash[own], doc[own], place[own].astype(np.uint64), row_at[own].astype(np.uint64), low[own].astype(np.uint8), high[own].astype(np.uint8), pool]
            out.append((1, int(k), block, B.pack(*fields, rising=True, level=3)))
        return _rows(out)

    shipped = stored(B.tell(table, {0: counted}, ship_shared, _ROWS), "passages")
    release(docs.sparkSession)

    def sort_bucket(group: pa.Table) -> pa.Table:
        parts = [B.unpack(p.as_py(), rising=True) for p in group.column("payload")]
        h, doc, place, row_at, low, high, pool = (np.concatenate(x) for x in zip(*parts))
        place, row_at, low, high = (x.astype(np.int64) for x in (place, row_at, low, high))
        size = high + GRAM + length - GRAM - low
        left = np.concatenate([[0], np.cumsum(size)[:-1]]) + high
        who, offset = repeated(h, doc, place, low, high, pool, left, left + GRAM, length)
        block = np.repeat(np.array(group.column("block").to_pylist(), np.int64), [len(p[0]) for p in parts])
        out = []
        start, of = row_at[who] + place[who] - offset, block[who]
        by = np.argsort(of, kind="stable")
        for k, own in zip(np.unique(of).tolist(), np.split(start[by], np.flatnonzero(np.diff(of[by])) + 1)):
            out.append((0, 0, k, B.pack(*runs(own), rising=True)))
        return _rows(out)

    found = shipped.where("kind = 1").groupBy("bucket").applyInArrow(sort_bucket, _ROWS)
    answers = shipped.where("kind = 0").unionByName(found)

    def cut_out(block: int, payload: bytes, answers: pa.Table) -> pa.Table:
        b = B.unpack_texts(payload)
        told = [x.astype(np.int64) for p in answers.column("payload").to_pylist() for x in B.unpack(p, rising=True)]
        first, n = (np.concatenate([np.zeros(0, np.int64), *told[i::2]]) for i in (0, 1))
        gone = covered(first, first + n - 1 + length, len(b.data))
        least: dict[bytes, int] = {}
        for i, text in zip(b.ids.tolist(), b):
            least[text] = min(i, least.get(text, i))
        at, data, n_removed, n_spans, kept = b.at.tolist(), np.frombuffer(b.data, np.uint8), [], [], []
        for n, (i, text) in enumerate(zip(b.ids.tolist(), b)):
            g = gone[at[n] : at[n + 1]]
            if i > least[text] and len(text) >= length:
                removed, spans, rest = len(text), 1, b""
            elif not g.any():
                removed, spans, rest = 0, 0, text
            else:
                removed = int(g.sum())
                spans = int(g[0]) + int((g[1:] & ~g[:-1]).sum())
                rest = data[at[n] : at[n + 1]][~g].tobytes()
                rest = rest.decode("utf-8", "ignore").encode() if whole else rest
            n_removed.append(removed)
            n_spans.append(spans)
            kept.append(rest)
        out = pa.table({"doc_id": pa.array(b.ids, pa.int64()), "n_bytes": pa.array(np.diff(b.at), pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "n_spans": pa.array(n_spans, pa.int64()), "kept": pa.array(kept, pa.binary())})
        for name in carry:
            out = out.append_column(name, b.rest.column(name))
        return out

    schema = T.StructType([*T.StructType.fromDDL("doc_id long, n_bytes long, n_removed long, n_spans long, kept binary").fields, *(docs.schema[c] for c in carry)])
    out = B.tell(table, {0: answers}, cut_out, schema)
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    nameless = docs.where(F.col(id_col).isNull()).select(F.lit(None).cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), text.alias("kept"), *carry)
    return out.unionByName(nameless)

