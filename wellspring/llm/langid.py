"""Language identification: the family first, then one-versus-one linear support vector machines within it."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import svm
from .blocks import trim

#: ISO 639-1 codes by family. Languages that aren't listed form a family each.
FAMILIES = {
    "germanic": ("da", "de", "en", "is", "nb", "nl", "nn", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "pt", "ro"),
    "slavic": ("be", "bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
}
UNDETERMINED = "und"
BITS, LONGEST, KEPT_WORDS = 16, 4, 400_000


def family_of(lang: str, families: Mapping[str, Sequence[str]] = FAMILIES) -> str:
    return next((f for f, langs in families.items() if lang in langs), lang)


def words_of(text: str) -> list[str]:
    """Lower-cased words that hold a letter."""
    return [w for w in text.lower().split() if (w.upper() != w if w.isascii() else any(c.isalpha() for c in w))]


def word_features(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte 1- to 4-grams of each word between spaces: (ids, number of the word), word by word within a length."""
    raw = [b" " + w.encode("utf-8", "replace") + b" " for w in words]
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    b = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint32)
    of = np.repeat(np.arange(len(raw)), size)
    ids, own, code = [], [], b
    for n in range(1, LONGEST + 1):
        if n > 1:
            code = code[:-1] * np.uint32(0x01000193) ^ b[n - 1 :]
        if len(code) == 0:
            break
        inside = of[: len(code)] == of[n - 1 :]
        mixed = ((code + np.uint32(n)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
        ids.append(mixed[inside])
        own.append(of[: len(code)][inside])
    return np.concatenate(ids), np.concatenate(own)


def row_of(text: str) -> svm.Row:
    """Square roots of the n-gram counts of a whole text, at length 1."""
    words = words_of(text)
    if not words:
        return np.zeros(0, np.int64), np.zeros(0)
    ids, n = np.unique(word_features(words)[0], return_counts=True)
    x = n / n.sum()
    return ids.astype(np.int64), x / np.linalg.norm(x)


class Model:
    """Per pair of families, and per pair of languages in a family, a linear machine; machines vote by margin."""

    def __init__(self, texts: Sequence[str], langs: Sequence[str], families: Mapping[str, Sequence[str]] = FAMILIES):
        rows = [row_of(t) for t in texts]
        keep = [i for i, r in enumerate(rows) if len(r[0])]
        rows, langs = [rows[i] for i in keep], [langs[i] for i in keep]
        self.members: dict[str, list[str]] = {}
        for lang in sorted(set(langs)):
            self.members.setdefault(family_of(lang, families), []).append(lang)
        kin = [family_of(x, families) for x in langs]
        self.pairs: list[tuple[str, str]] = []
        weights, self.bias = [], []
        for names, own in [(sorted(self.members), kin), *((m, langs) for m in self.members.values())]:
            for a, b in combinations(names, 2):
                pick = [i for i, x in enumerate(own) if x in (a, b)]
                w, bias = svm.fit([rows[i] for i in pick], [1 if own[i] == a else -1 for i in pick], 1 << BITS)
                self.pairs.append((a, b))
                weights.append(w)
                self.bias.append(bias)
        self.weights = np.array(weights, np.float32).T if weights else np.zeros((1 << BITS, 0), np.float32)
        self.at = {p: i for i, p in enumerate(self.pairs)}

    def _best(self, names: Sequence[str], margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each row: index of the name with the most votes (margin breaks ties), and its least probability in a duel."""
        votes, least = np.zeros((len(margins), len(names))), np.ones((len(margins), len(names)))
        for a, b in combinations(range(len(names)), 2):
            m = margins[:, self.at[names[a], names[b]]]
            p = 1 / (1 + np.exp(-np.clip(3 * m, -30, 30)))
            votes[:, a] += (m >= 0) + 0.01 * np.tanh(m)
            votes[:, b] += (m < 0) - 0.01 * np.tanh(m)
            least[:, a] = np.minimum(least[:, a], p)
            least[:, b] = np.minimum(least[:, b], 1 - p)
        best = votes.argmax(1)
        return best, least[np.arange(len(best)), best]

    def predict(self, margins: np.ndarray) -> tuple[list[str], np.ndarray]:
        names = sorted(self.members)
        family, p = self._best(names, margins)
        out, score = np.empty(len(margins), object), p.copy()
        for f, name in enumerate(names):
            if len(pick := np.flatnonzero(family == f)):
                lang, q = self._best(self.members[name], margins[pick])
                out[pick] = np.array(self.members[name], object)[lang]
                score[pick] = p[pick] * q
        return out.tolist(), score


class Scorer:
    """Margins of whole texts from the summed weights of their words; words seen before are looked up."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}
        self.sums = np.zeros((0, model.weights.shape[1] + 1), np.float32)

    def _learn(self, new: list[str]) -> None:
        ids, own = word_features(new)
        sums = np.zeros((len(new), self.sums.shape[1]), np.float32)
        for c in range(self.model.weights.shape[1]):
            sums[:, c] = np.bincount(own, self.model.weights[ids, c], len(new))
        sums[:, -1] = np.bincount(own, minlength=len(new))
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
        self.sums = np.concatenate([self.sums, sums])

    def predict(self, texts: Sequence[str]) -> tuple[list[str], list[float]]:
        words = [words_of(t) for t in texts]
        distinct = set().union(*words)
        if len(self.known) + len(distinct) > KEPT_WORDS:
            self.known, self.sums = {}, self.sums[:0]
        if new := sorted(distinct.difference(self.known)):
            self._learn(new)
        size = np.fromiter(map(len, words), np.int64, len(words))
        at = np.fromiter((i for w in words for i in map(self.known.__getitem__, w)), np.int64, int(size.sum()))
        full = np.flatnonzero(size)
        lang, score = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        if len(full) and self.model.members:
            starts = np.concatenate([[0], np.cumsum(size[full])[:-1]])
            total = np.add.reduceat(self.sums[at].astype(np.float64), starts, 0)
            margins = total[:, :-1] / total[:, -1:] * STRETCH + np.array(self.model.bias)
            for i, name, p in zip(full.tolist(), *self.model.predict(margins)):
                lang[i], score[i] = name, float(p)
        return lang, score


#: One over the usual length of a text's relative n-gram counts. Signs matter, not this scale; it shapes the score only.
STRETCH = 12.0


def sample(df: DataFrame, rows: int, key_col: str, by_col: str, seed: int = 11) -> DataFrame:
    """About ``rows`` rows of each value of ``by_col`` (all, if fewer), chosen by a seeded hash of ``key_col``."""
    counts = {r[0]: r[1] for r in df.groupBy(by_col).count().collect()}
    if len(counts) > 1000:
        raise ValueError(f"{by_col} has {len(counts)} values; labels have fewer")
    if not counts:
        return df.limit(0)
    share = F.create_map(*[F.lit(x) for v, n in counts.items() for x in (v, min(1.0, rows / n))])
    dice = F.pmod(F.xxhash64(F.lit(seed), key_col), F.lit(1 << 53)) / float(1 << 53)
    return df.where(dice < share[F.col(by_col)])


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows_per_lang: int = 700) -> Model:
    """Fit on a bounded sample: about ``rows_per_lang`` rows of each language with a text. Null texts and labels don't count."""
    have = labelled.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(id_col, text_col, lang_col)
    got = sample(have, rows_per_lang, id_col, lang_col).orderBy(id_col, text_col).collect()
    return Model([r[1] for r in got], [r[2] for r in got])


def predict(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``df`` with ``lang_pred`` and ``score`` (0 to 1) of every whole text; nothing but the text is read.

    ``und`` with score 0 where the text is null, empty or has no letter, or where nothing was learnt. Columns of these
    names are replaced; repeated rows are predicted alike. The model (65,536 weights a machine) goes by broadcast.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        trim()
        scorer = Scorer(sent.value)
        for batch in batches:
            parts = [scorer.predict([t or "" for t in batch.iloc[i : i + 256]]) for i in range(0, len(batch), 256)]
            yield pd.DataFrame({"lang_pred": [x for p in parts for x in p[0]], "score": [x for p in parts for x in p[1]]})
        del scorer
        trim()

    out = F.pandas_udf(run, "lang_pred string, score double")
    return df.drop("lang_pred", "score").withColumn("_p", out(text_col)).select("*", "_p.*").drop("_p")
