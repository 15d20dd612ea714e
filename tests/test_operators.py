"""Literal fixtures for the operators, and all registered queries against their SQL."""

from __future__ import annotations

from itertools import permutations

import duckdb
import pytest
from pyspark.sql import functions as F

from wellspring import registry
from wellspring.functions import exprs as E
from wellspring.operators import assign as A
from wellspring.operators import barcodes as B
from wellspring.operators import expression as X
from wellspring.operators import intervals as I
from wellspring.operators import isoform as M
from wellspring.plans.views import view
from wellspring.sources import formats as S

SF = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")


def value(spark, column):
    return spark.range(1).select(column).first()[0]


def text(x):
    return "NULL" if x is None or x != x else f"{float(x):.6f}" if isinstance(x, (int, float)) and not isinstance(x, bool) else str(list(x)) if isinstance(x, list) else str(x)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_equals_sql(spark, name):
    if name not in registry.oracle_sql():
        pytest.skip("no SQL")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = registry.queries()[name](spark, SF)
    cur = con.execute(registry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    want = sorted([text(r[names.index(c)]) for c in sorted(names)] for r in cur.fetchall())
    assert sorted([text(r[c]) for c in sorted(names)] for r in df.collect()) == want


def test_views_hold_all_parts_suppliers_and_customers(spark):
    sf = SF.replace("0.001", "0.01")
    rows = {t: spark.read.parquet(f"{sf}/{t}.parquet") for t in ("part", "supplier", "customer")}
    assert view(spark, sf, "exons").count() == 3 * rows["part"].count()
    assert view(spark, sf, "observed").agg(F.sum("n")).first()[0] == rows["customer"].count()
    for name, table, key in (("genes", "part", "p_partkey % 50"), ("wells", "supplier", "s_suppkey % 48"), ("expected", "supplier", "s_suppkey % 768"), ("whitelist", "supplier", "s_suppkey % 256")):
        assert view(spark, sf, name).count() == rows[table].selectExpr(key).distinct().count(), name
    genes = {r.gene for r in registry.queries()["i10_segments"](spark, sf).collect()}
    assert genes == {r.gene for r in view(spark, sf, "exons").collect()}


def test_quality_strings_hold_whole_texts(spark):
    texts = {r.doc_id: "".join(c for c in r.text or "" if " " <= c <= "~") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = view(spark, SF, "quals").collect()
    assert sum(len(r.q1) + len(r.q2) for r in rows) == sum(map(len, texts.values())) and {r.doc_id for r in rows} == set(texts)
    long = max(texts, key=lambda i: len(texts[i]))
    assert sorted(r.q1 + r.q2 for r in rows if r.doc_id == long) == sorted(texts[long][i : i + 100] for i in range(0, len(texts[long]), 100))


def test_hamming(spark):
    h = lambda a, b: value(spark, E.hamming(F.lit(a), F.lit(b)))
    assert (h("ATTGCGCAATG", "ATTGCGCAATA"), h("TTTGCGCAATA", "ATTGCGCAATG"), h("A", "AC")) == (1, 2, 1)


def test_representatives(spark):
    got = [r[0] for r in spark.createDataFrame([(f,) for f in (99, 147, 69, 137, 355, 2147, 0)], "f int").select(E.is_representative(F.col("f"))).collect()]
    assert got == [True, False, True, False, False, False, True]


def test_cigar_blocks(spark):
    got = value(spark, E.cigar_blocks(F.lit(100), F.lit("5S150M250N20M3I30M2D10M")))
    assert [tuple(b) for b in got] == [(100, 250), (500, 520), (520, 550), (552, 562)]


@pytest.mark.parametrize("t, want", [(0, {}), (1, {"AAAT": "AAAA"}), (2, {"AAAT": "AAAA", "AATT": "AAAA"})])
def test_umi_clusters(spark, t, want):
    rows = spark.createDataFrame([("w", "AAAA", 10), ("w", "AAAT", 1), ("w", "AATT", 1), ("w", "TTTT", 1)], "well string, umi string, n long")
    assert {r.umi: r.parent for r in X.cluster(rows, ["well"], t).where("umi <> parent").collect()} == want


def test_joint_umis(spark):
    c = spark.createDataFrame([("w", "G1", "E", "AAAA")] * 10 + [("w", "G1", "E", "AAAT")] + [("w", "G1", "N", "AAAA")] * 2, "well string, gene string, re string, umi string")
    got = {r.ftype: r.n for r in X.umi_matrix(X.clustered(X.umi_types(c), ["well", "gene"])).collect()}
    assert got == {"exon": 1, "intron": 1, "inex": 1}


def test_introns_are_clipped_and_bounded(spark):
    ex = lambda rows: spark.createDataFrame([("chr1", "+", *r) for r in rows], "chrom string, strand string, gene string, start long, end long")
    clip = A.introns(ex([("A", 100, 120), ("A", 200, 220), ("B", 150, 160), ("B", 400, 420)]))
    assert {(r.gene, r.start, r.end) for r in clip.collect()} == {("A", 121, 149), ("B", 221, 399)}
    assert A.introns(ex([("S", 100, 120), ("S", 126, 140)])).isEmpty()
    assert A.introns(ex([("L", 1000, 1020), ("L", 101050, 101070)])).isEmpty()


def test_interval_algebra(spark):
    mk = lambda rows: spark.createDataFrame([("k", a, b) for a, b in rows], "k string, start long, end long")
    out = lambda df: sorted((r.start, r.end) for r in df.collect())
    assert out(I.from_positions(spark.createDataFrame([("k", p) for p in (1, 2, 3, 5, 6, 10)], "k string, pos long"), ["k"])) == [(1, 3), (5, 6), (10, 10)]
    assert out(I.merge(mk([(1, 5), (4, 8), (10, 15), (16, 17)]), ["k"])) == [(1, 8), (10, 17)]
    assert out(I.difference(mk([(1, 10), (20, 30)]), mk([(5, 8), (25, 40)]), ["k"])) == [(1, 4), (9, 10), (20, 24)]


def test_transcript_segments(spark):
    ex = spark.createDataFrame([("g", "T1", 100, 200), ("g", "T2", 150, 250)], "gene string, tx string, start long, end long")
    seg = I.segments(ex, ["gene"], "tx")
    assert {(tuple(r.members), r.start, r.end) for r in seg.collect()} == {(("T1",), 100, 149), (("T1", "T2"), 150, 200), (("T2",), 201, 250)}
    mol = spark.createDataFrame([("m1", "g", 110, 180), ("m2", "g", 160, 170), ("m3", "g", 140, 204), ("m4", "g", 100, 240)], "molecule string, gene string, b_start long, b_end long")
    assert {r.molecule: r.transcripts for r in M.compatible(mol, seg).collect()} == {"m1": ["T1"], "m2": ["T1", "T2"], "m3": ["T1"], "m4": None}


def test_gene_body_projection(spark):
    ex = spark.createDataFrame([("plus", "t1", "chr1", "+", 1, 100), ("minus", "t2", "chr2", "-", 1, 100)], "gene string, tx string, chrom string, strand string, start long, end long")
    reads = spark.createDataFrame([("a", "chr1", "+", "UMI", 1, 10), ("b", "chr2", "-", "Internal", 91, 100)], "qname string, chrom string, strand string, source string, b_start long, b_end long")
    got = {(r.source, r.bin): r.coverage for r in A.gene_body_coverage(reads, A.gene_models(ex)).collect()}
    assert got == {(s, b): 1.0 for s in ("UMI", "Internal") for b in range(10)}


def test_consensus(spark):
    rows = [("m", 1, "A", 30), ("m", 2, "C", 20), ("m", 2, "C", 30), ("m", 3, "G", 35), ("m", 3, "T", 10)]
    got = {r.pos: (r.base, r.qual) for r in M.consensus(spark.createDataFrame(rows, "molecule string, pos long, base string, qual int")).collect()}
    assert got[1][0] == "A" and got[1][1] >= 29 and got[2][0] == "C" and got[2][1] >= 35 and got[3][0] == "G"


def test_consensus_of_equally_likely_bases_does_not_hang_on_the_order_of_reads(spark):
    """Both bases have the same qualities, so that A, the first of them, is called in whatever order they are added up."""
    orders = sorted(set(permutations([(b, q) for b in "AT" for q in (3, 11, 20)])))
    rows = [(f"m{k:03d}", 0, b, q) for k, order in enumerate(orders) for b, q in order]
    calls = M.consensus(spark.createDataFrame(rows, "molecule string, pos long, base string, qual int").coalesce(1)).collect()
    assert len(calls) == len(orders) and {(r.base, r.qual) for r in calls} == {("A", 3)}


def test_quantification(spark):
    rows = spark.createDataFrame([("c", ["T1"], 10), ("c", ["T1", "T2"], 5)], "well string, transcripts array<string>, reads long")
    assert {r.tx: (r.unique_molecules, r.fractional, r.total_reads) for r in M.quantify(rows).collect()} == {"T1": (1, 1.5, 15), "T2": (0, 0.5, 5)}


def test_top_barcodes_keep_the_tail(spark):
    bc = spark.createDataFrame([("A" * 20, 100), ("A" * 19 + "T", 12), ("G" * 20, 11)], "XC string, n long")
    assert [r.keep for r in B.select_top(bc, 1, 10).orderBy("rank").collect()] == [True, False, False]


def test_discovery(spark):
    c = spark.createDataFrame([("manual", "9", "P1A1", "A" * 20, "umi"), ("manual", "9", "P1A1", "C" * 20, "internal"), ("manual", "10", "P1A2", "G" * 20, "umi")], "candidate_type string, candidate_id string, wellID string, barcode string, barcode_type string")
    bc = spark.createDataFrame([("A" * 20, 100), ("C" * 19 + "A", 80), ("G" * 20, 5)], "XC string, n long")
    got = B.discovery_selection(B.discovery_summary(B.discovery_matches(bc, c))).collect()
    assert [(r.candidate_id, r.reads, r.exact_reads, r.hamming1_reads) for r in got] == [("9", 180, 100, 80)]


def test_fastq(spark, tmp_path):
    good, bad = tmp_path / "a_R1.fastq", tmp_path / "bad.fastq"
    good.write_text("@r1/1 x\nACGT\n+\nIIII\n@r2/1\nAC\n+\nII\n")
    bad.write_text("@r1\nACGT\n+\n")
    rows = S.fastq(spark, str(good))
    assert sorted((r.rec_no, r.id, r.seq) for r in rows.collect()) == [(0, "r1", "ACGT"), (1, "r2", "AC")]
    with pytest.raises(Exception, match="Incomplete FASTQ record 1"):
        S.fastq(spark, str(bad)).collect()
    with pytest.raises(Exception, match="mate ID mismatch"):
        S.mates(rows, rows.withColumn("id", F.lit("other"))).collect()


def test_gtf_sam_and_lists(spark, tmp_path):
    (tmp_path / "a.gtf").write_text('#x\nchr1\ts\texon\t5\t9\t.\t+\t.\tgene_id "g1"; transcript_id "t1";\n')
    (tmp_path / "a.sam").write_text("@SQ\tSN:chr1\tLN:9\nq\t99\tchr1\t5\t60\t4M\t=\t1\t0\tACGT\tIIII\tCB:Z:W1\tUR:Z:AC\n")
    (tmp_path / "w.txt").write_text("acgt, tt\nACGT\n")
    assert tuple(S.gtf(spark, str(tmp_path / "a.gtf")).drop("line_no").first()) == ("chr1", 5, 9, "+", "g1", "t1", "g1")
    r = S.sam(spark, str(tmp_path / "a.sam")).first()
    assert (r.qname, r.flag, r.pos, r.CB, r.UR, r.GX) == ("q", 99, 4, "W1", "AC", None)
    assert {x.barcode for x in S.word_list(spark, str(tmp_path / "w.txt")).collect()} == {"ACGT", "TT"}


def test_streaming_counts_equal_batch(spark, tmp_path):
    from wellspring.streaming import counts

    df = spark.read.parquet(f"{SF}/events.parquet").select("event_type")
    df.write.parquet(str(tmp_path / "in"))
    q = counts.to_memory(counts.running_counts(counts.landing(spark, str(tmp_path / "in"), "event_type string"), "event_type"), "events_n", str(tmp_path / "ck"))
    q.awaitTermination(60)
    assert {tuple(r) for r in spark.table("events_n").collect()} == {tuple(r) for r in df.groupBy("event_type").count().collect()}
