"""Language-model scoring with a probabilistic suffix tree over words.

Order 0 is the smoothed word distribution. A context (the one or two words before) joins the tree if it is seen often
enough and passes a divergence test: the summed log ratio between its own next-word distribution, each occurrence left
out of its own count, and that of its parent, over all occurrences, has to exceed a bound. A state's distribution is
smoothed with its parent's as prior, which weighs as many
occurrences as different words follow the state. A word is scored in the longest suffix state of what precedes it.

All counts are over all learnt documents. Blocks of documents ask for the counts of their words, then of their word
pairs, then for the divergence sums of their contexts and, one word longer, again; nothing but answers to their own
questions reaches them, so no table of the vocabulary exists in one place.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import blocks as B
from .mixing import word_count
from .ngram_join import word_hash

#: Text of a block: the larger, the fewer blocks ask for the same key, and the more memory a worker needs.
BLOCK_BYTES = 12 << 20
#: Tokens whose sums and hashes are in memory at a time.
SLICE = 1 << 17
#: Bits that keys of words, and of contexts and grams, have to spare: two of them share a count with odds of 2**-bits
#: for each key, if there are as many keys as estimated (a word in 50 bytes, a context or gram in 8).
WORD_BITS, GRAM_BITS = 28, 24


#: Occurrences that a context needs, the bound of the divergence test (nats), the weight of the parent in the test, and
#: the weight of the parent in scoring, by word that follows the context.
@dataclass(frozen=True)
class Tests:
    least: int = 6
    bound: float = 10.0
    prior: float = 100.0
    back_off: float = 4.0


END = np.uint64(0x5851F42D4C957F2D)
_MULT = np.uint64(0x9E3779B97F4A7C15)


def join_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of a context followed by a word."""
    x = (a ^ a >> np.uint64(31)) * _MULT + b
    x ^= x >> np.uint64(29)
    return x * _MULT


def short(x: np.ndarray) -> np.ndarray:
    """Single precision without the last byte, which then takes no room."""
    return (x.astype(np.float32).view(np.uint32) + np.uint32(0x80) & np.uint32(0xFFFFFF00)).view(np.float32)


def pack_tokens(ids: np.ndarray, texts: list[bytes], learn: np.ndarray) -> bytes:
    """Distinct word hashes (rising) and, per document, the numbers of its words among them, each followed by END's."""
    number: dict[bytes, int] = {}
    tokens, size = [], []
    for t in texts:
        words = t.lower().split()
        size.append(len(words) + 1)
        tokens.append(np.fromiter((number.setdefault(w, len(number)) for w in words), np.uint32, len(words)))
        tokens.append(np.array([0xFFFFFFFF], np.uint32))
    hashes = np.append(np.fromiter(map(word_hash, number), np.uint64, len(number)), END)
    vocabulary, place = np.unique(hashes, return_inverse=True)
    flat = np.concatenate(tokens or [np.zeros(0, np.uint32)])
    flat = place.astype(np.uint32)[np.minimum(flat, len(number))]
    # The commonest words get the smallest numbers, which compress best; their hashes stay in rising order.
    often = np.argsort(-np.bincount(flat, minlength=len(vocabulary)), kind="stable").astype(np.uint32)
    code = np.empty_like(often)
    code[often] = np.arange(len(often), dtype=np.uint32)
    return B.pack(vocabulary, ids, np.array(size, np.uint32), learn.astype(np.uint8), code[flat], often, rising=True, level=6)


class _Tokens:
    def __init__(self, payload: bytes):
        self.vocabulary, self.ids, size, learn, code, often = B.unpack(payload, rising=True)
        self.token = often[code].astype(np.int32)
        size = size.astype(np.int64)
        self.start = np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.int64) if len(size) else np.zeros(0, np.int64)
        self.size, self.learn = size, learn.astype(bool)
        self.learnt = np.repeat(self.learn, size)  # by token
        self.place = np.arange(len(self.token), dtype=np.int32) - np.repeat(self.start.astype(np.int32), size)  # in its document

    def words(self) -> B.Asked:
        n = np.bincount(self.token[self.learnt], minlength=len(self.vocabulary))
        return self.vocabulary, n.astype(np.uint32)


def _slices(n: int) -> Iterator[slice]:
    return (slice(i, i + SLICE) for i in range(0, n, SLICE))


class _Level:
    """The contexts of some words' length: which tokens have one, and the distinct (context, word) keys.

    A token has a few numbers of 4 bytes here: all that is longer is kept by distinct key, or made for a slice of the tokens at a time.
    """

    def __init__(self, tokens: _Tokens, at: np.ndarray, names: np.ndarray, context: np.ndarray):
        """``at``: tokens in such a context; ``context``: the numbers of theirs among ``names``, rising distinct hashes."""
        self.at, self.names, self.context, self.learnt = at, names, context, tokens.learnt[at]
        hashes = np.empty(len(at), np.uint64)
        for some in _slices(len(at)):
            hashes[some] = join_hash(names[context[some]], tokens.vocabulary[tokens.token[at[some]]])
        # np.unique with its inverse, which would take twice the memory.
        order = np.argsort(hashes)
        hashes = hashes[order]
        new = np.ones(len(at), bool)
        np.not_equal(hashes[1:], hashes[:-1], out=new[1:])
        self.keys = hashes[new]
        del hashes
        self.of = np.empty(len(at), np.int32)
        self.of[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
        self.seen = self.count = np.zeros(0)  # occurrences of the names, counts of the keys

    def asked(self) -> B.Asked:
        return self.keys, np.bincount(self.of[self.learnt], minlength=len(self.keys)).astype(np.uint32)

    def often(self, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens of the level in contexts seen often enough, those contexts, and by name their numbers."""
        at = np.flatnonzero((self.seen >= least)[self.context]).astype(np.int32)
        used = np.zeros(len(self.names), bool)
        used[self.context[at]] = True
        return at, self.names[used], np.cumsum(used, dtype=np.int32) - np.int32(1)

    def gains(self, tests: Tests, prob: np.ndarray) -> B.Asked:
        """The block's contexts with their divergence sums (each learnt occurrence left out of its own counts) and, as
        the imaginary part, their share of the number of distinct words that follow; both to 16 binary digits.

        ``prob``: each token's probability one level below."""
        at, contexts, number = self.often(tests.least)
        at = at[self.learnt[at]]
        follow, gain = np.zeros(len(contexts)), np.zeros(len(contexts))
        for some in _slices(len(at)):
            own = at[some]
            state, count = number[self.context[own]], self.count[self.of[own]].astype(np.float64)
            # Occurrences over their counts add up to the number of distinct words that follow.
            np.add.at(follow, state, 1.0 / count)
            c, n, p = count - 1.0, self.seen[self.context[own]].astype(np.float64) - 1.0, prob[self.at[own]]
            np.add.at(gain, state, np.log((c + tests.prior * p) / ((n + tests.prior) * p)))
        return contexts, (short(gain) + 1j * short(follow)).astype(np.complex64)

    def grow(self, tests: Tests, follow: np.ndarray, prob: np.ndarray) -> None:
        """Move ``prob`` from the level below to this one, where ``follow`` (words that follow, by context) is over 0."""
        at, _, number = self.often(tests.least)
        for some in _slices(len(at)):
            own = at[some]
            prior = follow[number[self.context[own]]].astype(np.float64)
            own, prior = own[prior > 0], tests.back_off * prior[prior > 0]
            place = self.at[own]
            prob[place] = (self.count[self.of[own]] + prior * prob[place]) / (self.seen[self.context[own]] + prior)


def _levels(t: _Tokens, answers: pa.Table, stats: tuple[float, float], depth: int, tests: Tests) -> tuple[list[_Level], np.ndarray, np.ndarray]:
    """The levels that can be formed, word counts, and each token's probability in its longest known state.

    Questions: 0 the counts of words, 2k-1 the counts of contexts of k words with the next word, 2k how many distinct
    words follow the contexts of k words that pass the divergence test (0: they do not). All pairs are counted; of longer
    contexts only those that are seen often enough.
    """
    have = set(answers.column("question").unique().to_pylist())
    count = B.told(answers, 0).astype(np.float64)
    prob = ((count + 0.1) / (stats[0] + 0.1 * (stats[1] + 1)))[t.token]
    levels: list[_Level] = []
    for k in range(1, depth + 1):
        if k == 1:
            level = pairs(t)
            level.seen = count
        else:
            # The context of k words ends a gram of the level below, whose count is the context's.
            below = levels[-1]
            of = np.full(len(t.token), -1, np.int32)
            of[below.at] = below.of
            at = np.flatnonzero(t.place >= k).astype(np.int32)
            context = of[at - 1]
            del of
            keep = (context >= 0) & (below.count >= tests.least)[context]
            at, context = at[keep], context[keep]
            del keep
            level = _Level(t, at, below.keys, context)
            level.seen = below.count
        levels.append(level)
        if 2 * k - 1 not in have:
            break
        level.count = B.told(answers, 2 * k - 1)
        if 2 * k in have:
            level.grow(tests, B.told(answers, 2 * k), prob)
    return levels, count, prob


def pairs(t: _Tokens) -> _Level:
    at = np.flatnonzero(t.place >= 1).astype(np.int32)
    return _Level(t, at, t.vocabulary, t.token[at - 1])


def _sums(t: _Tokens, answers: pa.Table, stats: tuple[float, float], depth: int, tests: Tests) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By document: known tokens, and the log10 probabilities of order 0 and of the tree."""
    count, prob = _levels(t, answers, stats, depth, tests)[1:]
    add = lambda x: np.add.reduceat(x, t.start) if len(t.start) else np.zeros(0)
    base = np.log10((count + 0.1) / (stats[0] + 0.1 * (stats[1] + 1)))
    return add((count > 0).astype(np.int32)[t.token]), add(base[t.token]), add(np.log10(prob, out=prob))


def _asked(block: int, rows: list[tuple[int, B.Scale, B.Asked]]) -> pa.Table:
    fields = pa.schema([("question", pa.int32()), ("bucket", pa.int32()), ("block", pa.int64()), ("payload", pa.binary())])
    parts = [(q, B.asked_rows(block, scale, *own)) for q, scale, own in rows]
    return pa.concat_tables([fields.empty_table(), *(pa.table({"question": pa.array([q] * p.num_rows, pa.int32()), **{c: p.column(c) for c in ("bucket", "block", "payload")}}) for q, p in parts)])


_ASKS = "question int, bucket int, block long, payload binary"


def score(docs: DataFrame, learn: Column, depth: int = 2, tests: Tests = Tests(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every whole text.

    Learns from the rows where ``learn`` holds (null: not) and scores all. Tokens are the words between ASCII white
    space, A-Z lower-cased, and one end; null texts are empty and have the end only. ``n_known`` counts tokens seen in
    learnt rows, ``train_tokens`` all tokens learnt, ``base_score`` and ``score`` are log10 probabilities of order 0 and
    of the tree. With nothing to learn from all tokens are alike unknown. Rows with a null id are not learnt and get
    null scores; rows that repeat an id are scored each. Words are told apart by 64-bit
    hashes cut to WORD_BITS to spare, contexts and grams to GRAM_BITS, so a few may share counts. Contexts have up to ``depth`` words.
    """
    flag = F.coalesce(learn, F.lit(False))
    marked = docs.select(F.col(id_col), F.concat(F.when(flag, F.lit("1")).otherwise("0"), F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("_t"))

    def make(ids: np.ndarray, texts: list[bytes]) -> bytes:
        return pack_tokens(ids, [t[1:] for t in texts], np.array([t[:1] == b"1" for t in texts]))

    table = B.blocks(marked, id_col, "_t", make, size=BLOCK_BYTES, placed=True)
    n_bytes = B.total_bytes(table)
    words_scale = B.Scale.of(n_bytes / 50, WORD_BITS)  # the counts of words have to be exact
    grams = B.Scale(B.Scale.of(n_bytes / 12, 0).buckets, B.Scale.of(n_bytes / 8, GRAM_BITS).bits)
    few = B.Scale(max(1, grams.buckets // 4), grams.bits)

    def once(asked: DataFrame, number: int, before: DataFrame | None = None) -> DataFrame:
        return B.placed_answers(B.totals(asked).withColumn("question", F.lit(number)), table, before)

    # Every answer is moved once, to the bucket of the block that asked; later rounds read it in place.
    answers = once(B.ask(table, words_scale, lambda p: _Tokens(p).words()), 0)
    sums = [B.unpack(r[0]) for r in answers.where("block < 0").select("payload").toLocalIterator()]
    stats = (float(sum(s[1][0] for s in sums)), float(sum(s[0][0] for s in sums)))
    answers = once(B.ask(table, grams, lambda p: pairs(_Tokens(p)).asked()), 1, answers)

    def asks(level: int):
        """Divergence sums of this level, and counts of the next, which need no more."""

        def run(block: int, payload: bytes, told: pa.Table) -> pa.Table:
            levels, _, prob = _levels(_Tokens(payload), told, stats, min(level + 1, depth), tests)
            rows = [(2 * level, few, own.gains(tests, prob)) for own in levels[level - 1 : level]]  # none: texts without a word
            if level < depth:
                rows += [(2 * level + 1, grams, own.asked()) for own in levels[level : level + 1]]
            return _asked(block, rows)

        return run

    def grown(sums: np.ndarray) -> np.ndarray:
        return np.where(sums.real > tests.bound, sums.imag, 0).astype(np.float32)

    for level in range(1, depth + 1):
        told = B.totals(B.tell_placed(table, answers, asks(level), _ASKS), ("question", "bucket"), {2 * level: grown})
        answers = B.placed_answers(told, table, answers)

    def final(block: int, payload: bytes, told: pa.Table) -> pa.Table:
        t = _Tokens(payload)
        n_known, base, own = _sums(t, told, stats, depth, tests)
        return pa.table({
            "doc_id": pa.array(t.ids, pa.int64()), "held_out": pa.array(~t.learn), "n_tokens": pa.array(t.size, pa.int64()),
            "n_known": pa.array(n_known.astype(np.int64)), "train_tokens": pa.array(np.full(len(t.ids), int(stats[0])), pa.int64()),
            "base_score": pa.array(base.astype(np.float64)), "score": pa.array(own.astype(np.float64)),
        })

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    out = B.tell_placed(table, answers, final, schema)
    nameless = docs.where(F.col(id_col).isNull()).select(
        F.lit(None).cast("long").alias("doc_id"), F.lit(True).alias("held_out"), (word_count(F.col(text_col)) + 1).alias("n_tokens"),
        F.lit(None).cast("long").alias("n_known"), F.lit(int(stats[0])).cast("long").alias("train_tokens"), F.lit(None).cast("double").alias("base_score"), F.lit(None).cast("double").alias("score"),
    )
    return out.unionByName(nameless)

