"""URL filters: rules by host and path prefix, and character models of accepted and rejected URLs for the rest."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

#: Distinct n-grams that a task counts before it hands them on.
GRAMS = 300_000
#: Digits after the point of a difference: so many steps tell two URLs apart.
DIGITS = 6
Rule = tuple[str, str, str]  # verdict, host, path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; '' for null or without ``://``."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; '' for null or without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest matching rule as host + path, or null. A rule holds for its host and all subdomains of it."""
    ranked = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))
    hits = [
        F.when(((host == h) | host.endswith("." + h)) & path.startswith(p), F.lit(h + p)) for _, h, p in ranked
    ]
    return F.coalesce(*hits) if hits else F.lit(None).cast("string")


class MarkovModel:
    """Smoothed characters of variable order: counts for every context up to ``order``, each blended with the shorter."""

    def __init__(self, texts: Sequence[str], order: int = 5, blend: float = 2.0):
        self.order, self.blend = order, blend
        self.learn(grams(Counter(texts), order))

    def learn(self, seen: Mapping[str, int]) -> None:
        """Take the counts of a corpus: of each context together with the character after it."""
        self.seen, self.total = dict(seen), Counter()
        for gram, n in self.seen.items():
            self.total[gram[:-1]] += n

    def log10(self, text: str) -> float:
        padded, out = text + "\0", 0.0
        for i, c in enumerate(padded):
            p = 1 / 1024  # below order 0: any of many characters
            for k in range(min(self.order, i) + 1):
                context = padded[i - k : i]
                if context not in self.total:
                    break
                p = (self.seen.get(context + c, 0) + self.blend * p) / (self.total[context] + self.blend)
            out += math.log10(p)
        return out


def grams(texts: Mapping[str, int], order: int) -> Counter:
    """Of texts and how often each occurs, the counts of every context up to ``order`` with the character after it."""
    out: Counter = Counter()
    for text, n in texts.items():
        padded = text + "\0"
        for i in range(len(padded)):
            for k in range(min(order, i) + 1):
                out[padded[i - k : i + 1]] += n
    return out


def plain(url: str | None) -> str:
    """What the models read: scheme and mark off, lower case, of a number its first digit and its length."""
    return re.sub(r"(?<=\d)\d", "0", (url or "").partition("://")[2].lower())


def best_bound(points: Iterable[tuple[float, int, int]]) -> float:
    """From (difference, accepted, rejected): the bound with the best balanced accuracy; of equals the one nearest to 0."""
    points = sorted(points)
    n_allow, n_block = max(1, sum(p[1] for p in points)), max(1, sum(p[2] for p in points))
    best, bound, allowed, blocked = (-1.0, 0.0), 0.0, 0, n_block
    for i, (x, a, b) in enumerate(points):
        allowed, blocked = allowed + a, blocked - b
        middle = (x + (points[i + 1][0] if i + 1 < len(points) else x + 0.1)) / 2
        now = (allowed / n_allow + blocked / n_block, -abs(middle))
        if now > best:
            best, bound = now, middle
    return bound


class UrlRatio:
    """Log-likelihood difference per character between the models of rejected and accepted URLs, over a calibrated bound."""

    def __init__(self, accepted: Sequence[str], rejected: Sequence[str], order: int = 5):
        # Every fifth labelled URL calibrates and isn't learnt.
        learn = lambda xs: [plain(x) for i, x in enumerate(xs) if i % 5]
        self.allow, self.block = MarkovModel(learn(accepted), order), MarkovModel(learn(rejected), order)
        held: dict[float, list[int]] = {}
        for y, xs in enumerate((accepted[::5], rejected[::5])):
            for x in xs:
                held.setdefault(self.difference(plain(x)), [0, 0])[y] += 1
        self.bound = best_bound((x, *n) for x, n in held.items())

    def difference(self, text: str) -> float:
        return round((self.block.log10(text) - self.allow.log10(text)) / (len(text) + 1), DIGITS)

    def blocks(self, url: str | None) -> bool:
        return self.difference(plain(url)) > self.bound


def train(labelled: DataFrame, url_col: str = "url", order: int = 5) -> UrlRatio | None:
    """``UrlRatio`` of all distinct URLs of ``labelled`` (``url_col``, ``verdict``) in the order of their hashes.

    Every n-gram is counted and every fifth URL of a verdict calibrates, whatever their number; the driver gets a row
    for each distinct n-gram and each distinct difference. None without URLs of both verdicts.
    """
    h = F.xxhash64(url_col)
    # Places in the order of hashes: those in a part of the hashes' range, after the numbers in the parts before it.
    urls = stored(labelled.select(F.col(url_col).alias("url"), (F.col("verdict") == "block").alias("block"), h.alias("h"), F.shiftright(h, 52).alias("part")).distinct(), "urls")
    parts = urls.groupBy("block", "part").count().collect()
    if {r.block for r in parts} != {True, False}:
        return None
    before, n = [], {True: 0, False: 0}
    for r in sorted(parts, key=lambda r: r.part):
        before.append((r.block, r.part, n[r.block]))
        n[r.block] += r["count"]
    first = F.broadcast(urls.sparkSession.createDataFrame(before, "block boolean, part long, before long"))
    place = F.row_number().over(Window.partitionBy("block", "part").orderBy("h", "url")) - 1 + F.col("before")
    dealt = urls.join(first, ["block", "part"]).select("url", "block", (place % 5 == 0).alias("held"))

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: tuple[Counter, Counter] = Counter(), Counter()
        rows = lambda: pd.DataFrame([(b == 1, g, n) for b in (0, 1) for g, n in kept[b].items()], columns=["block", "gram", "n"])
        for batch in batches:
            for b in (0, 1):
                own = batch["url"][batch["block"] == bool(b)].map(plain)
                kept[b].update(grams(Counter(own), order))
            if len(kept[0]) + len(kept[1]) > GRAMS:
                yield rows()
                kept = Counter(), Counter()
        if any(kept):
            yield rows()

    seen = dealt.where("NOT held").select("url", "block").mapInPandas(counted, "block boolean, gram string, n long").groupBy("block", "gram").agg(F.sum("n").alias("n")).toPandas()
    model = UrlRatio((), (), order)
    for own, block in ((model.allow, False), (model.block, True)):
        of = seen[seen["block"] == block]
        own.learn(dict(zip(of["gram"], of["n"].tolist())))
    sent = urls.sparkSession.sparkContext.broadcast(model)

    def difference(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda u: sent.value.difference(plain(u))).astype("float64")

    held = dealt.where("held").select(F.pandas_udf(difference, "double")("url").alias("x"), F.col("block").cast("int").alias("b"))
    points = held.groupBy("x").agg(F.sum(1 - F.col("b")).alias("accepted"), F.sum("b").alias("rejected")).toPandas()
    model.bound = best_bound(zip(*(points[c].tolist() for c in ("x", "accepted", "rejected"))))
    return model


def judge(df: DataFrame, rules: Sequence[Rule], url_col: str = "url", order: int = 5) -> DataFrame:
    """``df`` with ``host``, ``path``, ``rule``, ``ratio`` (log10 per character, over the bound: blocked; null where a rule decides) and ``verdict``.

    The models learn from all distinct URLs that a rule decides (``train``). Without URLs of both verdicts nothing is
    learnt and everything that no rule decides is allowed. Null and malformed URLs have empty host and path and no rule,
    and are judged as the empty string by the models. Repeated rows are judged alike; other columns pass through, those
    of the same names are replaced. A map over partitions without a shuffle, after the fit.
    """
    verdict_of = {h + p: v for v, h, p in rules}
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    df = df.drop("host", "path", "rule", "ratio", "verdict")
    ruled = df.withColumns({"host": host, "path": path}).withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    given = F.create_map(*[F.lit(x) for kv in verdict_of.items() for x in kv]) if rules else F.create_map().cast("map<string,string>")
    model = train(ruled.where("rule IS NOT NULL").select(url_col, given[F.col("rule")].alias("verdict")), url_col, order)
    sent = df.sparkSession.sparkContext.broadcast(model)

    def ratio(urls: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = sent.value
        for batch in urls:
            yield batch.map(lambda u: None if u is None else model.difference(plain(u)) - model.bound if model else 0.0).astype("float64")

    score = F.pandas_udf(ratio, "double")
    out = ruled.withColumn("ratio", score(F.when(F.col("rule").isNull(), F.coalesce(url_col, F.lit("")))))
    return out.withColumn("verdict", F.coalesce(given[F.col("rule")], F.when(F.col("ratio") > 0, "block").otherwise("allow")))
