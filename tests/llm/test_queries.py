"""Every registered opN query and the pipeline over one small set of tables, each held against a brute-force version."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from wellspring.llm import bpe, langid, mixing, neardup, ngram_join, pst, queries, shared, suffix_dedup, topk, toxicity, url_filter

from . import brute

SYLLABLES = {"en": "the of and ing tion wh th er".split(), "de": "der und sch ung keit ein zu ch".split(), "fr": "le des eau tion é que ou vi".split(), "es": "el los ción ado que ñ ar ll".split()}
INSULTS = ("wretchling", "foulsnout", "dungbrain")


def documents(n=260, seed=11):
    rnd, rows = random.Random(seed), []
    vocab = {x: ["".join(rnd.choice(s) for _ in range(rnd.randint(1, 3))) for _ in range(60)] for x, s in SYLLABLES.items()}
    say = lambda x, k: " ".join(rnd.choice(vocab[x]) for _ in range(k))
    passage = say("en", 45)
    for i in range(n):
        lang = rnd.choice(list(SYLLABLES))
        kind = i % 7
        text = say(lang, rnd.randint(1, 70))
        if kind == 1 and rows:
            text, lang = rows[-1][1], rows[-1][2]
        elif kind == 2 and len(rows) > 2:
            w = (rows[-2][1] or "").split()
            w[rnd.randrange(len(w))] = "changed"
            text, lang = " ".join(w), rows[-2][2]
        elif kind == 3:
            text = text + "\n" + passage
        rows.append((i, text, lang, rnd.choice(["src0", "src1", "src2", None])))
    rows += [(n, None, "en", "src0"), (n + 1, "", None, None), (n + 2, " \t\n", "en", "src1"), (n + 3, "… ½ 12", "de", "src1"), (n + 4, "y" * 40_000, "en", "src9"), (n + 5, " ".join(f"w{i % 300}" for i in range(9000)), "en", "src0")]
    return rows


ROWS = documents()
TOXIC = {i: (int(i % 5 == 0), f"{t} {INSULTS[i % 3]} {INSULTS[(i + 1) % 3]}" if i % 5 == 0 and t else t) for i, t, _, _ in ROWS}
VECTORS = []
URLS = [f"https://{h}/{p}/{i}" for i, (h, p) in enumerate((h, p) for h in ("shop.com", "a.example.com", "x.net", "example.net", "y.org", "z.info") for p in ("en", "de/81", "es", "en/7", "fr/old") for _ in range(6))] + [None, "", "no scheme", "http://", "HTTP://UP.COM/en/1?x=/"]


def vectors():
    rnd = np.random.default_rng(4)
    base = rnd.normal(size=(50, 12))
    return [(i, (base[i % 50] + 0.05 * rnd.normal(size=12) * (i % 3)).tolist()) for i in range(300)]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("sf"))
    docs = [(i, TOXIC[i][1], lang, source) for i, _, lang, source in ROWS]
    spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in docs], "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(i, 1, TOXIC[i][0]) for i, *_ in ROWS], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame(vectors() + [(900, None), (901, [0.0] * 12), (1000, [float("nan")] * 12)], "vec_id long, embedding array<float>").write.parquet(f"{at}/embeddings.parquet")
    spark.createDataFrame([(i, u, "") for i, u in enumerate(URLS)], "page_id long, url string, html string").write.parquet(f"{at}/pages.parquet")
    return at, docs


def got(spark, tables, name):
    df = queries.queries()[name](spark, tables[0])
    return df.columns, df.collect()


def test_op1(spark, tables):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer_path())
    rows = {r.doc_id: r for r in got(spark, tables, "op1_bpe")[1]}
    for i, text, *_ in tables[1]:
        ids = t.encode(text or "", add_special_tokens=False).ids
        assert rows[i].n_tokens == len(ids) and rows[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert rows[i].decoded_sha256 == hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_op2(spark, tables):
    rows = got(spark, tables, "op2_topk")[1]
    single = [(i, np.array(v, np.float32).astype(float).tolist()) for i, v in vectors()]
    zero = [(901, [0.0] * 12)]
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in rows} == brute.top_k(single + zero)


def test_op3(spark, tables):
    rows = [(i, t) for i, t, *_ in tables[1]]
    want, sizes = brute.suffix_tree_scores(rows)
    base = brute.base_scores(rows)
    for r in got(spark, tables, "op3_lm_score")[1]:
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == base[r.doc_id][:4]
        assert r.base_score == pytest.approx(base[r.doc_id][4]) and r.score == pytest.approx(want[r.doc_id], rel=1e-4)
    assert sizes[1] and sizes[2]  # contexts of one and of two words are in the tree


def test_op4(spark, tables):
    rows = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got(spark, tables, "op4_embedding_dedup")[1]}
    want = brute.cosine([(i, np.array(v, np.float32).astype(float).tolist()) for i, v in vectors()])
    assert rows == {i: (n, c, i == c) for i, (n, c) in want.items()} | {i: (0, i, True) for i in (900, 901, 1000)}


def test_op5(spark, tables):
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got(spark, tables, "op5_ngram_join")[1]} == brute.jaccard([(i, t) for i, t, *_ in tables[1]])


def test_op6(spark, tables):
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got(spark, tables, "op6_suffix_dedup")[1]} == brute.repeats([(i, t) for i, t, *_ in tables[1]])


def test_op7(spark, tables):
    source = {i: s for i, _, _, s in tables[1]}
    rows = got(spark, tables, "op7_mixing")[1]
    sizes, taken = {}, {}
    for r in rows:
        assert r["size"] == len(brute.words({i: t for i, t, *_ in tables[1]}[r.doc_id])) and 0 <= r.taken <= 2 * r["size"]
        sizes[source[r.doc_id]] = sizes.get(source[r.doc_id], 0) + r["size"]
        taken[source[r.doc_id]] = taken.get(source[r.doc_id], 0) + r.taken
    want = brute.targets(sizes)
    assert all(r.target == pytest.approx(want[source[r.doc_id]]) and r.source_size == sizes[source[r.doc_id]] for r in rows)
    for s, t in want.items():  # as near as whole documents allow, each taken once more or not
        own, whole = [r["size"] for r in rows if source[r.doc_id] == s], int(round(t)) // max(1, sizes[s])
        sums = 1
        for n in own:
            sums |= sums << n
        assert abs(taken[s] - t) <= min(abs(whole * sizes[s] + k - t) for k in range(sum(own) + 1) if sums >> k & 1) + 1


def test_op8(spark, tables):
    rows = {r.doc_id: r for r in got(spark, tables, "op8_toxicity")[1]}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in rows}
    assert all(r.held_out == held[i] and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for i, r in rows.items())
    bad = [i for i in rows if held[i] and TOXIC[i][0] and TOXIC[i][1]]
    good = [i for i in rows if held[i] and not TOXIC[i][0]]
    assert sum(rows[i].predicted for i in bad) >= 0.9 * len(bad) and sum(rows[i].predicted for i in good) <= 0.1 * len(good)


def test_string_kernel_equals_brute_force():
    words = ["foulsnout", "foul-snout".replace("-", "x"), "ab", "the", "wretchling", "zuéñ"]
    kernel = toxicity.Kernels([(w,) for w in words]).windows([(w,) for w in words])
    features = [brute.gapped(w) for w in words]
    want = [[sum(x * b.get(k, 0.0) for k, x in a.items()) / toxicity.WINDOW for b in features] for a in features]
    assert np.allclose(kernel, want, atol=2e-3)
    assert kernel[0, 1] > kernel[0, 4] and kernel[0, 1] > 0.5 * kernel[0, 0]


def test_op9(spark, tables):
    rows = {r.doc_id: r for r in got(spark, tables, "op9_langid")[1]}
    lang = {i: x for i, _, x, _ in ROWS}
    letter = {i: bool(t and any(c.isalpha() for c in t)) for i, t, *_ in tables[1]}
    assert all((rows[i].lang_pred == "und") == (not letter[i]) for i in rows)
    long = [i for i, t, *_ in tables[1] if letter[i] and rows[i].held_out and len(t.split()) > 8 and i < len(ROWS) - 6]
    assert len(long) > 20 and sum(rows[i].lang_pred == lang[i] for i in long) >= 0.95 * len(long)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in rows.items())


def test_op10(spark, tables):
    rows = {r.page_id: r for r in got(spark, tables, "op10_url_filter")[1]}
    ruled = {i: (*brute.host_and_path(u), *brute.rule(*brute.host_and_path(u), queries.URL_RULES)) for i, u in enumerate(URLS)}
    learnt = {v: sorted({URLS[i] for i, r in ruled.items() if r[3] == v}) for v in ("allow", "block")}
    order = {r.u: i for i, r in enumerate(spark.createDataFrame([(u,) for v in learnt.values() for u in v], "u string").orderBy(F.xxhash64("u"), "u").collect())}
    model = url_filter.UrlRatio(*(sorted(learnt[v], key=order.get) for v in ("allow", "block")))
    for i, u in enumerate(URLS):
        host, path, rule, verdict = ruled[i]
        assert (rows[i].host, rows[i].path, rows[i].rule) == (host, path, rule)
        assert rows[i].verdict == (verdict or ("block" if model.blocks(u) else "allow"))
    assert {r.verdict for r in rows.values() if r.rule is None} <= {"allow", "block"}


def test_url_models_learn_from_all_urls(spark):
    """More URLs of a verdict than any sample would hold, and repeated rows, which count once."""
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(4))
    labelled = {"block": sorted({f"http://{word()}.com/en/{word()}" for _ in range(8600)}), "allow": sorted({f"http://{word()}.net/de/{word()}" for _ in range(300)})}
    fresh = [f"http://{word()}.info/{word()}" for _ in range(50)]
    df = spark.createDataFrame([(u,) for u in [*labelled["block"], *labelled["allow"], *labelled["allow"], *fresh]], "url string").repartition(5)
    order = {r.url: i for i, r in enumerate(df.distinct().orderBy(F.xxhash64("url"), "url").collect())}
    model = url_filter.UrlRatio(*(sorted(labelled[v], key=order.get) for v in ("allow", "block")))
    got = {r.url: r.ratio for r in url_filter.judge(df, queries.URL_RULES).where("rule IS NULL").collect()}
    assert len(labelled["block"]) > 8000 and got.keys() == set(fresh)
    assert all(got[u] == pytest.approx(model.difference(url_filter.plain(u)) - model.bound, abs=1e-9) for u in fresh)


def test_markov_model_is_a_distribution():
    m = url_filter.MarkovModel(["abab", "abba"], 2)
    total = sum(10 ** m.log10(a) for a in ("", "a", "b", "ab", "aba", "abab", "abba"))
    assert 0.3 < total < 1 and m.log10("abab") > m.log10("bbbb") > m.log10("zzzz")


def test_pipeline(spark, tables):
    out = corpus_pipeline.run(spark, tables[0]).collect()
    docs = {i: t for i, t, *_ in tables[1]}
    letters = [(i, t) for i, t in docs.items() if t and any(c.isalpha() for c in t)]
    classes = brute.jaccard(letters)
    first = sorted(i for i, (_, c) in classes.items() if i == c)
    assert {r.doc_id for r in out} <= set(first) and all(r.round_trip for r in out)
    assert not spark.createDataFrame(out).where("n_tokens * 4 <> length(ids)").take(1)


def test_rows_that_repeat_an_id(spark):
    rows = [(1, "a b c d e f g", "en", "s"), (1, "a b c d e f g", "en", "s"), (1, "p q r s t u v w", "en", "t"), (2, "k l m n o p q r", "de", None)]
    df = spark.createDataFrame([(*r, len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted((r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, df, "").collect()) == sorted({(i, t) for i, t, *_ in rows})
    assert corpus_pipeline.repeated_passages(spark, df, "").count() == 4


def test_repeated_passages_hold_one_python_worker_a_task(spark, capsys):
    """Whole characters, null texts and counts as before, without a second Python step on top of the cut."""
    passage = "".join(chr(233 + i % 90) + "xy " for i in range(40))  # two bytes of a character may part
    rows = [(1, "head " + passage), (2, "\u00ea" + passage + "tail"), (3, "z" + passage[1:] + "\u4e2d"), (4, None), (5, ""), (None, passage), (None, None)]
    docs = spark.createDataFrame([(*r, "en", "s", 7) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.repeated_passages(spark, docs, "")
    cut = suffix_dedup.remove_repeats(docs, 100, carry=("text",)).collect()
    kept = {(r.doc_id, r.text if r.n_removed == 0 else bytes(r.kept).decode("utf-8", "ignore"), r.n_removed > 0) for r in cut}
    want = {(i, t, len(t) if removed else 7) for i, t, removed in kept}
    assert {(r.doc_id, r.text, r.n_chars) for r in out.collect()} == want and sum(r.n_removed > 0 for r in cut) == 2
    out.explain()
    plan = capsys.readouterr().out
    assert "FlatMapCoGroupsInArrow" in plan and "ArrowEvalPython" not in plan


@pytest.mark.parametrize("name", ["op1_bpe", "op2_topk", "op3_lm_score", "op4_embedding_dedup", "op5_ngram_join", "op6_suffix_dedup", "op7_mixing", "op8_toxicity", "op9_langid", "op10_url_filter"])
def test_empty_tables(spark, tables, tmp_path, name):
    for t in ("documents", "labels", "embeddings", "pages"):
        spark.read.parquet(f"{tables[0]}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert queries.queries()[name](spark, str(tmp_path)).collect() == []


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "the und of", "en", "s", 3, b"x", "y", 0.5, 7, "h")], "doc_id long, text string, lang string, source string, n_tokens long, ids binary, decoded string, score double, predicted int, lang_pred string")
    path = queries.tokenizer_path()
    out = bpe.decode(bpe.encode(df, path), path)
    assert out.first().decoded == "the und of" and out.columns.count("n_tokens") == 1
    model = langid.Model(["the of", "der und"], ["en", "de"])
    assert langid.predict(df, model).columns.count("score") == 1 and toxicity.score(df, toxicity.Model(["a b"], [0])).columns.count("predicted") == 1
    more = df.withColumn("size", F.lit(1)).withColumn("key", F.lit("k")).withColumn("taken", F.lit(2)).withColumn("block", F.lit(1)).withColumn("payload", F.lit(b"z"))
    assert mixing.mix(more).count() == suffix_dedup.remove_repeats(more).count() == ngram_join.jaccard_classes(more).count() == pst.score(more, F.lit(True)).count() == 1


def test_one_language_or_one_verdict(spark):
    model = langid.Model(["the of and"], ["en"])
    df = spark.createDataFrame([(1, "der und"), (2, None)], "doc_id long, text string")
    assert [r.lang_pred for r in langid.predict(df, model).orderBy("doc_id").collect()] == ["en", "und"]
    pages = spark.createDataFrame([(1, "http://a.com/en/1"), (2, "http://b.info/x")], "page_id long, url string")
    assert [r.verdict for r in url_filter.judge(pages, queries.URL_RULES).orderBy("page_id").collect()] == ["block", "allow"]


def test_large_components_have_exact_scores(spark):
    rows = [(i, [float(2**20 + i), float(-(2**20)) + i]) for i in range(0, 30)]
    got = {(r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 10 == 0, 3).collect()}
    want = set()
    for q, v in rows[::10]:
        best = sorted((-sum(int(1024 * a) * int(1024 * b) for a, b in zip(v, w)), i) for i, w in rows if i != q)[:3]
        want |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(best)}
    assert got == want


def test_knapsack_of_very_long_texts():
    lengths = np.array([1, 3, 400, 90_001, 700_000])
    take = mixing.fit(lengths, np.array([5, 7, 900, 4, 3]), 1_234_567)
    assert abs(int((take * lengths).sum()) - 1_234_567) == 137  # the nearest there is


def test_vectors_of_many_lengths(spark):
    rows = [(i, [1.0] * (1 + i // 2)) for i in range(160)]
    out = {r.vec_id: (r.n_links, r.component_id) for r in neardup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert out == {i: (1, i - i % 2) for i in range(160)}


def test_equal_names_of_different_strings_remove_nothing(spark, monkeypatch):
    rnd = random.Random(8)
    base = "".join(rnd.choice("abcdefgh ") for _ in range(900))
    rows = [(i, "".join(base[(a := rnd.randrange(700)) : a + rnd.randrange(60, 200)] + rnd.choice("xyz") for _ in range(4))) for i in range(12)]
    want = brute.repeats(rows)
    monkeypatch.setattr(suffix_dedup, "_NAMES", np.ones(256, np.uint64))  # names depend on nothing but the sample
    data = np.frombuffer("".join(t for _, t in rows).encode(), np.uint8)
    at = np.cumsum([0, *(len(t) for _, t in rows)])
    valid = np.ones(len(data), bool)
    for a, b in zip(at, at[1:]):
        valid[max(a, b - 99) : b] = False
    place, first, last, h = suffix_dedup.samples(data, valid, 100)
    doc = np.searchsorted(at, place, "right") - 1
    who, offset = suffix_dedup.repeated(h, doc, place - at[doc], place - last, place - first, data, place, place + suffix_dedup.GRAM, 100)
    gone = np.zeros(len(data), bool)
    for w, o in zip(who, offset):
        gone[place[w] - o : place[w] - o + 100] = True
    assert [int(gone[a:b].sum()) for a, b in zip(at, at[1:])] == [want[i][1] for i, _ in rows]


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    session = lambda master, path: SimpleNamespace(conf=SimpleNamespace(get=lambda *_: path), sparkContext=SimpleNamespace(master=master, applicationId="a"))
    assert shared.shared_dir(session("spark://host:7077", "hdfs://x/y/")) == "hdfs://x/y" and shared.shared_dir(session("local[4]", None))
    for master in ("spark://host:7077", "local-cluster[2,1,1024]", "yarn"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared.shared_dir(session(master, None))
