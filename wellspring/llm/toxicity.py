"""Toxicity: a support vector machine on a gappy subsequence string kernel with Nyström landmarks.

Two windows of words are alike as far as their words share subsequences of four letters (a word's two ends are letters
too), each weighing ``DECAY`` for every letter that its span leaves out, so that an insult with letters or marks put into
it stays near the insult. The machine is trained on windows of the labelled texts under their texts' labels: first all,
then, since few windows of a toxic text are toxic, the likeliest of each toxic text against the likeliest and some others
of each clean one (multiple instances). A window's Nyström features are its kernels with landmark windows times the
inverse root of the landmarks' own kernel matrix; as the kernel is a product of explicit feature vectors, landmarks and
machine fold into one weight for each four letters. A text is judged by its worst windows.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import svm
from .blocks import trim
from .langid import sample

DECAY, SPAN, WIDTH, KEPT_WORDS = 0.6, 6, 26, 400_000
BITS = 20
#: Words of a window, at every word; windows of a toxic and a clean text in the later rounds, rounds, windows of a label in the first.
WINDOW, WORST, OTHERS, ROUNDS, FIRST = 3, 3, 2, 4, 12_000
_OFFSETS = [(j, k, m) for j in range(1, SPAN) for k in range(j + 1, SPAN) for m in range(k + 1, SPAN)]
_LETTERS = re.compile(r"[^\W\d_]+")
_SPELT = re.compile(r"(?<![^\W_])(?:[^\W\d_][\W_]{1,2}){3,}[^\W\d_](?![^\W_])")


def words_of(text: str) -> list[str]:
    """Words of letters only, marks and digits inside left out, long ones in pieces; letters spelt one by one are joined.

    A single letter has no subsequence of four, with its ends, and is left out.
    """
    text = text.lower()
    words = ["".join(_LETTERS.findall(w)) if not w.isalpha() else w for w in text.split()]
    words = [w for w in words if len(w) > 1] + ["".join(_LETTERS.findall(m)) for m in _SPELT.findall(text)]
    return [p for w in words for p in pieces(w)] if any(len(w) > WIDTH - 2 for w in words) else words


def codes_of(words: Sequence[str]) -> np.ndarray:
    """(word, WIDTH) letters as 1 to 61 between the ends 62 and 63; 0 beyond the end."""
    joined = np.frombuffer("".join(("\1" + w[: WIDTH - 2] + "\2").ljust(WIDTH, "\0") for w in words).encode("utf-32-le"), np.uint32).reshape(len(words), WIDTH)
    other = 27 + joined * np.uint32(2654435761) % np.uint32(35)
    return np.select([joined == 0, joined < 3, (joined >= 97) & (joined <= 122)], [np.uint32(0), joined + np.uint32(61), joined - np.uint32(96)], other).astype(np.uint32)


def subsequences(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of every word the hashed four-letter subsequences of a span up to SPAN, and their weights at length 1."""
    wide = np.pad(codes, ((0, 0), (0, SPAN)))
    ids, weight = [], []
    for j, k, m in _OFFSETS:
        b, c, d = (wide[:, i : i + WIDTH] for i in (j, k, m))
        ids.append(((((codes << 6 | b) << 6 | c) << 6 | d) * np.uint32(2654435761) >> np.uint32(32 - BITS)).astype(np.int32))
        weight.append(np.where(d > 0, DECAY ** (m - 3), 0.0).astype(np.float32))
    ids, weight = np.concatenate(ids, 1), np.concatenate(weight, 1)
    return ids, weight / np.maximum(1e-9, np.sqrt((weight**2).sum(1, keepdims=True)))


def pieces(word: str) -> list[str]:
    """A word over WIDTH letters in overlapping pieces, so that none of it is left out."""
    own, step = WIDTH - 2, WIDTH - 2 - SPAN
    return [word[i : i + own] for i in range(0, max(1, len(word) - SPAN), step)] if len(word) > own else [word]


class Landmarks:
    """Kernels with a few windows, over the subsequences that any of them has."""

    def __init__(self, windows: Sequence[Sequence[str]]):
        ids, weight = subsequences(codes_of([w for own in windows for w in own]))
        of = np.repeat(np.arange(len(windows)), [len(own) for own in windows])
        self.ids = np.unique(ids)
        self.column = np.zeros(1 << BITS, np.int32)
        self.column[self.ids] = np.arange(1, len(self.ids) + 1)
        self.base = np.zeros((len(self.ids) + 1, len(windows)), np.float32)  # row 0: what no landmark has
        for row, values, i in zip(self.column[ids], weight, of.tolist()):
            np.add.at(self.base[:, i], row, values / np.float32(np.sqrt(WINDOW)))


class Kernels:
    """Kernels of words with landmark windows, some landmarks at a time."""

    def __init__(self, windows: Sequence[Sequence[str]], step: int = 60):
        self.parts = [Landmarks(windows[i : i + step]) for i in range(0, len(windows), step)]

    def words(self, words: Sequence[str]) -> np.ndarray:
        out = []
        for i in range(0, len(words), 200):
            ids, weight = subsequences(codes_of(words[i : i + 200]))
            out.append(np.concatenate([np.matmul(weight[:, None, :], p.base[p.column[ids]])[:, 0] for p in self.parts], 1))
        return np.concatenate(out)

    def windows(self, windows: Sequence[Sequence[str]]) -> np.ndarray:
        words = sorted({w for own in windows for w in own})
        at, k = {w: i for i, w in enumerate(words)}, self.words(words)
        return np.array([k[[at[w] for w in own]].sum(0) for own in windows]) / np.float32(np.sqrt(WINDOW))

    def folded(self, weights: np.ndarray) -> np.ndarray:
        """One weight for each four letters from one for each landmark."""
        beta, begin = np.zeros(1 << BITS, np.float32), 0
        for p in self.parts:
            beta[p.ids] += (p.base @ weights[begin : begin + p.base.shape[1]].astype(np.float32))[1:]
            begin += p.base.shape[1]
        return beta


def window_at(words: Sequence[str], i: int) -> tuple[str, ...]:
    return tuple(words[i : i + WINDOW])


def n_windows(words: Sequence[str]) -> int:
    return max(1, len(words) - WINDOW + 1) if words else 0


class Model:
    """``beta``: a weight for each four letters, and the calibration of a text's worst windows."""

    def __init__(self, texts: Sequence[str], labels: Sequence[int], landmarks: int = 480, seed: int = 5):
        rnd, y = random.Random(seed), np.array(labels)
        self.beta, self.bias = np.zeros(1 << BITS, np.float32), 0.0
        self.calibration = np.array([0, 0, 0, 0, -3.0])
        own = dict(zip(texts, labels))  # copies count once
        if not 0 < y.sum() < len(y):
            return
        each = {c: 1 + FIRST // max(1, sum(1 for v in own.values() if v == c)) for c in (0, 1)}
        for turn in range(ROUNDS):
            scorer, taken = Scorer(self), ([], [])
            for text, label in own.items():
                words = words_of(text)
                n = n_windows(words)
                if turn == 0:
                    pick = rnd.sample(range(n), min(n, each[label]))
                else:
                    pick = np.argsort(-scorer.windows([words])[0], kind="stable")[: WORST if label else OTHERS].tolist()
                    pick += [] if label else rnd.sample(range(n), min(n, OTHERS))
                taken[label].extend(window_at(words, i) for i in pick)
            bad, good = taken[1], taken[0]
            if not bad or not good:
                break
            chosen = rnd.sample(bad, min(len(bad), 2 * landmarks // 3)) + rnd.sample(good, min(len(good), landmarks // 3))
            marks = Kernels(chosen)
            value, vector = np.linalg.eigh(marks.windows(chosen).astype(np.float64))
            root = vector @ np.diag(1 / np.sqrt(np.maximum(value, 1e-2))) @ vector.T
            z, every = marks.windows(bad + good) @ root.astype(np.float32), np.arange(len(root))
            w, self.bias = svm.fit([(every, r) for r in z], [1] * len(bad) + [-1] * len(good), len(root), epochs=10, ridge=1e-4)
            self.beta = marks.folded(root @ w)
        self.calibration = svm.logistic(Scorer(self).features(list(texts)), y.astype(float))


class Scorer:
    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def _learn(self, new: list[str]) -> None:
        for i in range(0, len(new), 4000):
            part = new[i : i + 4000]
            ids, weight = subsequences(codes_of(part))
            self.known.update(zip(part, (self.model.beta[ids] * weight).sum(1).tolist()))

    def windows(self, words: Sequence[Sequence[str]]) -> list[np.ndarray]:
        """Of every text the scores of its windows."""
        distinct = set().union(*words)
        if len(self.known) + len(distinct) > KEPT_WORDS:
            self.known = {}
        self._learn(sorted(distinct.difference(self.known)))
        out = []
        for own in words:
            s = np.fromiter(map(self.known.__getitem__, own), np.float64, len(own))
            total = np.concatenate([[0.0], np.cumsum(np.pad(s, (0, max(0, WINDOW - len(s)))))])
            out.append((total[WINDOW:] - total[:-WINDOW]) / np.sqrt(WINDOW) + self.model.bias if len(s) else np.zeros(0))
        return out

    def features(self, texts: Sequence[str]) -> np.ndarray:
        """Of every text: its worst window, the second worst, the mean of the five worst, and the share of windows over 0."""
        out = np.zeros((len(texts), 4))
        for begin in range(0, len(texts), 256):
            for i, s in enumerate(self.windows([words_of(t) for t in texts[begin : begin + 256]]), begin):
                top = np.sort(s[s.argpartition(-5)[-5:]] if len(s) > 5 else np.concatenate([s, np.full(5 - len(s), -1.0)]))[::-1]
                out[i] = np.clip(top[0], -2, 3), np.clip(top[1], -2, 3), np.clip(top.mean(), -2, 3), (s > 0).mean() * 10 if len(s) else 0
        return out

    def scores(self, texts: Sequence[str]) -> list[float]:
        x = np.column_stack([self.features(texts), np.ones(len(texts))])
        return (1 / (1 + np.exp(-np.clip(x @ self.model.calibration, -30, 30)))).tolist()


def train(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", rows_per_label: int = 2500) -> Model:
    """Fit on a bounded sample: about ``rows_per_label`` labelled documents of each label. Null labels and texts don't count.

    The sample of ids is what is joined with the documents, so no text is shuffled for documents outside it.
    """
    known = labels.where(F.col(label_col).isin(0, 1)).groupBy(id_col).agg(F.max(label_col).alias(label_col))
    few = sample(known, rows_per_label, id_col, label_col)
    got = documents.select(id_col, text_col).where(F.col(text_col).isNotNull()).join(F.broadcast(few), id_col).orderBy(id_col, text_col).collect()
    return Model([r[1] for r in got], [int(r[2]) for r in got])


def score(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``df`` with ``score`` (0 to 1, higher: likelier toxic) and ``predicted`` (1 from 0.5 on) of every whole text.

    Null and empty texts have no words and get the score of that. Columns of these names are replaced. A map over
    partitions; the model (1,048,576 weights) goes by broadcast.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(sent.value)
        for batch in batches:
            yield pd.Series([x for i in range(0, len(batch), 256) for x in scorer.scores([t or "" for t in batch.iloc[i : i + 256]])], dtype="float64")
        del scorer
        trim()

    out = df.drop("score", "predicted").withColumn("score", F.pandas_udf(run, "double")(text_col))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
