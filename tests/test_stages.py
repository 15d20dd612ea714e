"""Literal fixtures for the first stage, run files, bundles, annotations, stitching, reports, and a run from end to end."""

from __future__ import annotations

import gzip
import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from wellspring import __main__ as cli
from wellspring import run as runs
from wellspring.operators import annotation as N
from wellspring.operators import barcodes as B
from wellspring.operators import coverage as C
from wellspring.operators import expression as X
from wellspring.operators import isoform as M
from wellspring.operators import reads as R
from wellspring.operators import report as P
from wellspring.operators import stitch as T
from wellspring.sources import bam, bundles, formats, sheets


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    (path.parent / f".{path.name}.crc").unlink(missing_ok=True)
    (gzip.open(path, "wt") if path.name.endswith(".gz") else open(path, "w")).write(text)
    return str(path)


def fastq(records):
    return "".join(f"@{n} x\n{s}\n+\n{q}\n" for n, s, q in records)


def test_layouts_and_patterns():
    assert R.parse_layout("BC(1-4,7-8); UMI(9-16)") == {"BC": [(0, 4), (6, 8)], "UMI": [(8, 16)]}
    assert R.parse_layout(["cDNA(11-100)", "odd"]) == {"cDNA": [(10, 100)]} and R.configured_length("BC(1-4,7-8);UMI(9-16)") == 16
    assert R.parse_pattern("ATT;2") == ("ATT", 2) and R.parse_pattern("ATT") == ("ATT", 1) and R.parse_pattern("character(0)") is None


def test_switching_pattern_changes_the_layout_only(spark):
    layout = R.parse_layout("UMI(12-15);cDNA(16-20)")
    rows = spark.createDataFrame([("ATTGCGCAATGACGTCCCCC", "I" * 20), ("ATTGCGCAATCACGTCCCCC", "I" * 20), ("GGGGGGGGGGGACGTCCCCC", "I" * 20)], "seq1 string, qual1 string")
    out = R.filter_pairs(rows, [layout], [R.parse_pattern(R.SWITCH)], (1, 20), (1, 20)).collect()
    assert [(r.UR, r.cDNA1_seq, r.keep) for r in out] == [("ACGT", "CCCCC", True), ("ACGT", "CCCCC", True), ("", "GGGGGGGGGGGACGTCCCCC", True)]


def test_fixed_barcodes_have_best_quality(spark):
    rows = spark.createDataFrame([("ACGTAA", "!!!!II", "TTTT"), ("ACGTAA", "!!!!II", None)], "seq1 string, qual1 string, well_bc string")
    out = R.filter_pairs(rows, [R.parse_layout("BC(1-4);cDNA(5-6)")], [], (1, 20), (1, 20), "well_bc").collect()
    assert [(r.CR, r.CY, r.keep) for r in out] == [("TTTT", "IIII", True), ("ACGT", "!!!!", False)]


def test_read_layout_follows_from_lengths(spark):
    of = lambda *x: spark.createDataFrame([(i, *p) for i, p in enumerate(x)], "pair_no long, len1 long, len2 long")
    assert R.infer_layout(of((100, 120), (100, 120)), False) == ("read_embedded_barcode", ["cDNA(11-100)", "UMI(1-10)"], ["cDNA(1-100)", "BC(101-120)"])
    assert R.infer_layout(of((100, 100)), True)[0] == "samplesheet_barcode"
    for lengths, sheet in ((((100, 120), (90, 120)), False), (((100, 120),), True), (((100, 100),), False), (((9, 29),), False), (((100, 110),), False), ((), False)):
        with pytest.raises(ValueError):
            R.infer_layout(of(*lengths), sheet)


def test_fastq_in_splits_equals_whole_files(spark, tmp_path):
    rnd, records = random.Random(1), {}
    for name in ("a_R1.fastq", "b_R1.fastq.gz"):
        records[name] = [(f"r{i}", s, "I" * len(s)) for i, s in ((i, "ACGT" * rnd.randint(1, 9)) for i in range(300))]
        write(tmp_path / name, fastq(records[name]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        rows = formats.fastq(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    for name, want in records.items():
        own = sorted((r.rec_no, r.id, r.seq, r.qual) for r in rows if r.file.endswith(name))
        assert own == [(i, *w) for i, w in enumerate(want)]


def test_pairs_of_several_files(spark, tmp_path):
    for k in "ab":
        write(tmp_path / f"{k}_R1.fastq", fastq([(f"{k}{i}/1", "ACGT", "IIII") for i in range(3)]))
        write(tmp_path / f"{k}_R2.fastq", fastq([(f"{k}{i}/2", "TTGG", "IIII") for i in range(3)]))
    listing = sheets.fastq_pairs(sheets.files(spark, str(tmp_path)))
    assert [(r.pair_no, r.read1.rsplit("/")[-1], r.read2.rsplit("/")[-1]) for r in listing.orderBy("pair_no").collect()] == [(0, "a_R1.fastq", "a_R2.fastq"), (1, "b_R1.fastq", "b_R2.fastq")]
    got = formats.pairs(spark, listing)
    assert sorted((r.pair_no, r.rec_no, r.id1, r.seq2) for r in got.collect()) == [(p, i, f"{k}{i}", "TTGG") for p, k in enumerate("ab") for i in range(3)]
    assert [(r.len1, r.len2) for r in sheets.read_lengths(got).collect()] == [(4, 4)] * 2
    assert R.first_pairs(got, 4).count() == 4 and R.first_pairs(got, 0).count() == 6
    (tmp_path / "b_R2.fastq").unlink()
    with pytest.raises(Exception, match="missing second mate"):
        sheets.fastq_pairs(sheets.files(spark, str(tmp_path))).collect()


def test_grouped_files():
    assert sheets.grouped_files({"file2": "x2, y2", "file1": "x1,y1"}) == [("x1", "x2"), ("y1", "y2")]
    with pytest.raises(ValueError):
        sheets.grouped_files(["a,b", "c"])


def test_samplesheets(spark, tmp_path):
    good = write(tmp_path / "s.csv", "read1,read2,barcode\na_R1.fq,a_R2.fq, acgt \n/x/b_R1.fq,/x/b_R2.fq,TTTT\n")
    rows = sheets.samplesheet(spark, good, "/d")
    assert {tuple(r) for r in rows.collect()} == {("/d/a_R1.fq", "/d/a_R2.fq", "ACGT"), ("/x/b_R1.fq", "/x/b_R2.fq", "TTTT")}
    expected = sheets.expected_table(spark, write(tmp_path / "e.tsv", "wellID\tumi_barcodes\tinternal_barcodes\nP1A1\tACGT,CCCC\tTTTT\n"))
    assert {(r.barcode, r.wellID, r.kind) for r in sheets.resolve_samplesheet(rows, expected).collect()} == {("ACGT", "P1A1", "umi"), ("TTTT", "P1A1", "internal")}
    assert sheets.resolve_samplesheet(rows, expected, discover=True).columns == ["read1", "read2", "barcode"]
    for text, what in (("read1,read2\na,b\n", "lacks barcode"), ("read1,read2,barcode\n", "no rows"), ("read1,read2,barcode\na,b,\n", "empty barcode"), ("read1,read2,barcode\na,b,C\na,b,G\n", "repeated pair"), ("read1,read2,barcode\na,b,GGGG\n", "not expected")):
        with pytest.raises(Exception, match=what):
            sheets.resolve_samplesheet(sheets.samplesheet(spark, write(tmp_path / "bad.csv", text)), expected).collect()


def test_barcode_tables(spark, tmp_path):
    read = lambda text: sheets.custom_table(spark, write(tmp_path / "c.tsv", text))
    rows = read("﻿wellID\tumi\tinternal\np1a1\tac, gt\t\n\nP1A2\t\tTT\n")
    assert {(r.wellID, r.kind, r.barcode) for r in rows.collect()} == {("P1A1", "umi", "AC"), ("P1A1", "umi", "GT"), ("P1A2", "internal", "TT")}
    for text, what in (("P1A1\tAC\n", "too few columns in line 1"), ("\tAC\tGT\n", "empty well"), ("P1A1\t,\t \n", "no barcode in line 1"), ("P1A1\tAC\t\nP1A2\tAC\t\n", "barcode AC belongs to P1A1 and P1A2"), ("P1A1\tAC\tAC\n", "belongs to")):
        with pytest.raises(Exception, match=what):
            read(text).collect()
    table = sheets.expected_table(spark, write(tmp_path / "e.tsv", "wellID\tu\ti\nP1A10\tA\tC\nP1A2\tA\tG\n"))
    assert [r.well for r in sheets.wells_of(table).orderBy("no").collect()] == ["P1A2", "P1A10"]
    assert {(r.barcode, r.wellID, r.kind) for r in sheets.id_map(table).collect()} == {("A", "P1A2", "umi"), ("C", "P1A10", "internal"), ("G", "P1A2", "internal")}
    bins = sheets.binning_map(spark, write(tmp_path / "b.csv", "x,trueBC,falseBC\n1,aa,ab\n2,cc,ab\n3,,zz\n"))
    assert {tuple(r) for r in bins.collect()} == {("AB", "CC")}
    stats = sheets.barcode_counts(spark, write(tmp_path / "n.txt", "ac 3\nAC\t4\nGT x\nalone\n"))
    assert {tuple(r) for r in stats.collect()} == {("AC", 7)}
    mapped = sheets.mapped_reads(spark, write(tmp_path / "m.txt", "Status\tx.bam\nAssigned\t10\nUnassigned_Unmapped\t4\nUnassigned_NoFeatures\t3\nbad\tx\n"))
    assert mapped.first().mapped == 13
    assert {r.name for r in sheets.names(spark, write(tmp_path / "l.txt", " a \n\nb\na\n")).collect()} == {"a", "b"}
    groups = sheets.sample_groups(spark, write(tmp_path / "g.tsv", "sample\tgroup\ns1\ta\ns2\tb\n"))
    assert {tuple(r) for r in groups.collect()} == {("s1", "a"), ("s2", "b")}
    with pytest.raises(Exception, match="repeated sample"):
        sheets.sample_groups(spark, write(tmp_path / "g2.tsv", "sample\tgroup\ns1\ta\ns1\tb\n")).collect()


def test_barcode_dictionaries(spark):
    manual = sheets.manual_records(spark, {"1": [["aa", "cc"], ["gg", "tt"], ["x", "y"]]})
    assert sorted((r.wellID, r.barcode, r.barcode_type) for r in manual.collect()) == sorted(("MANUAL1", b + i, k) for k, bs in (("umi", ("AA", "CC")), ("internal", ("GG", "TT"))) for b in bs for i in "XY")
    auto = sheets.auto_records(spark, {"plate2": {"A1": ["ac", ["gt", "tt"]]}}, ["2"])
    assert {(r.wellID, r.barcode, r.barcode_type) for r in auto.collect()} == {("P2A1", "AC", "umi"), ("P2A1", "GT", "internal"), ("P2A1", "TT", "internal")}
    assert [tuple(r) for r in sheets.expected_lines(auto).collect()] == [("P2A1", "AC", "GT,TT")]
    with pytest.raises(ValueError):
        sheets.auto_records(spark, {}, ["7"])


def test_bundles_are_plain_gzipped_files(spark, tmp_path):
    c = spark.createDataFrame([("BC2", "G2", 2), ("BC2", "G1", 1), ("BC1", "G2", 3), ("BC1", "G3", 0), ("BC9", "G1", 5)], "well string, gene string, n long").repartition(3)
    at = str(tmp_path / "b")
    bundles.write_mex(c, ["G1", "G2", "G3"], ["BC1", "BC2"], at, {"G1": "one"})
    assert gzip.open(f"{at}/matrix.mtx.gz", "rt").read() == "%%MatrixMarket matrix coordinate integer general\n3 2 3\n2 1 3\n1 2 1\n2 2 2\n"
    assert gzip.open(f"{at}/features.tsv.gz", "rt").read() == "G1\tone\tGene Expression\nG2\tG2\tGene Expression\nG3\tG3\tGene Expression\n"
    assert gzip.open(f"{at}/barcodes.tsv.gz", "rt").read() == "BC1\nBC2\n"
    assert {tuple(r) for r in bundles.read_mex(spark, at).collect()} == {("BC2", "G2", 2), ("BC2", "G1", 1), ("BC1", "G2", 3)}
    assert bundles.check_bundle(spark, at) == (3, 2, 3) and bundles.check_gzip(spark, f"{at}/matrix.mtx.gz") > 0
    head = "%%MatrixMarket matrix coordinate integer general\n"
    for body, what in (("3 2 3\n9 1 1\n1 1 1\n2 2 2\n", "inside the matrix"), ("3 2 9\n1 1 1\n", "9 declared"), ("4 2 1\n1 1 1\n", "axes are 3 x 2"), ("3 -2 1\n", "three dimensions"), ("3 2 1\n1 1 x\n", "whole numbers"), ("3 2 1\n1 1 -1\n", "whole numbers")):
        write(tmp_path / "b" / "matrix.mtx.gz", head + body)
        with pytest.raises(ValueError, match=what):
            bundles.check_bundle(spark, at)
    write(tmp_path / "b" / "features.tsv.gz", "G1\nG2\tb\n")
    assert [(r.gene, r.name, r.kind) for r in bundles.features(spark, at).orderBy("gene_no").collect()] == [("G1", "G1", "Gene Expression"), ("G2", "b", "Gene Expression")]
    (tmp_path / "cut.gz").write_bytes(gzip.compress(b"x\n" * 5000)[:-30])
    with pytest.raises(ValueError):
        bundles.check_gzip(spark, str(tmp_path / "cut.gz"))


def test_counts_are_checked(spark):
    mk = lambda *rows: spark.createDataFrame(rows, "gene string, sample string, n double")
    assert bundles.check_counts(mk(("g", "s", 2.0))).count() == 1
    for rows in ([("g", "s", 1.5)], [("g", "s", -1.0)], [("g", "s", 1.0), ("g", "s", 2.0)], [("", "s", 1.0)]):
        with pytest.raises(Exception):
            bundles.check_counts(mk(*rows)).collect()


def test_tables_reports_and_layers(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0, None), ("b", 0.25, 3)], "name string, share double, n int")
    bundles.write_tsv(df.orderBy("name"), str(tmp_path / "t.tsv"), {"share": "%.4f"})
    assert (tmp_path / "t.tsv").read_text() == "name\tshare\tn\na\t1.0000\t\nb\t0.2500\t3\n"
    bundles.write_report(df.select("name"), df.select("n"), str(tmp_path / "r.txt"))
    assert (tmp_path / "r.txt").read_text().startswith("[summary]\nname\n")
    assert json.loads(bundles.to_json(df, "name").first().value) == {"a": {"share": 1.0}, "b": {"share": 0.25, "n": 3}}
    layers = {k: spark.createDataFrame([("w", "g", i)], "well string, gene string, n int") for i, k in enumerate(("exon", "intron"))}
    bundles.write_layers(layers, str(tmp_path / "l"))
    known = lambda x: spark.createDataFrame([(x,)], "k string")
    bundles.check_layers(spark, str(tmp_path / "l"), known("g"), known("w"), ("exon", "intron"))
    with pytest.raises(ValueError, match="missing"):
        bundles.check_layers(spark, str(tmp_path / "l"), known("g"), known("w"), ("inex",))
    with pytest.raises(ValueError, match="unknown gene"):
        bundles.check_layers(spark, str(tmp_path / "l"), known("h"), known("w"), ("exon",))
    s = spark.createDataFrame([("auto", "2", 5, 2), ("manual", "1", 5, 2), ("auto", "1", 9, 1)], "candidate_type string, candidate_id string, reads long, expected long")
    assert [(r.candidate_type, r.candidate_id) for r in bundles.discovery_order(s).collect()] == [("auto", "1"), ("manual", "1"), ("auto", "2")]
    with pytest.raises(Exception, match="absent: b"):
        bundles.assert_same_names(df, df.where("name = 'a'"), "name", "absent").collect()


GTF = "".join(f'chr1\tx\t{f}\t{s}\t{e}\t.\t{d}\t.\tgene_id "{g}"; transcript_id "{t}"; gene_name "n{g}";\n' for f, s, e, d, g, t in (
    ("gene", 100, 900, "+", "B", "B1"), ("exon", 100, 220, "+", "B", "B1"), ("exon", 400, 520, "+", "B", "B1"), ("exon", 100, 220, "+", "B", "B2"), ("exon", 600, 900, "+", "B", "B2"),
    ("gene", 1000, 1500, "-", "A", "A1"), ("exon", 1000, 1100, "-", "A", "A1"), ("exon", 1300, 1500, "-", "A", "A1")))


def test_annotation(spark, tmp_path):
    path = write(tmp_path / "a.gtf", "#!x\n" + GTF)
    ex = formats.gtf(spark, path)
    assert [(r.gene, r.name, r.gene_no) for r in N.genes(ex).orderBy("gene_no").collect()] == [("B", "nB", 1), ("A", "nA", 2)]
    contigs = spark.createDataFrame([("chr1", 0)], "chrom string, tid int")
    regions = N.gene_regions(formats.gtf(spark, path, "gene"), contigs)
    assert [(r.gene, r.start, r.end) for r in regions.collect()] == [("B", 100, 900), ("A", 1000, 1500)]
    only = spark.createDataFrame([("A",)], "gene string")
    assert [r.gene for r in N.gene_regions(formats.gtf(spark, path, "gene"), contigs, "chr1", only).collect()] == ["A"]
    index = spark.createDataFrame([("chr1", 5000), ("spike", 700)], "chrom string, length long")
    more = N.with_extra_contigs(ex, index, spark.createDataFrame([("spike",)], "chrom string"))
    assert [(r.start, r.end, r.gene_id) for r in more.where("chrom = 'spike'").collect()] == [(1, 700, "spike")]
    with pytest.raises(Exception, match="missing from the index"):
        N.with_extra_contigs(ex, index, spark.createDataFrame([("other",)], "chrom string")).collect()
    exons = ex.select("chrom", "strand", F.col("gene_id").alias("gene"), F.col("transcript_id").alias("tx"), "start", "end")
    order = N.genes(ex)
    bundles.write_saf(N.saf(exons, contigs, order=order), str(tmp_path / "s"))
    lines = (tmp_path / "s.combined.saf").read_text().splitlines()
    assert lines[:2] == ["GeneID\tChr\tStart\tEnd\tStrand", "B\tchr1\t100\t220\t+"] and "A__INTRON__\tchr1\t1101\t1299\t-" in lines
    assert len((tmp_path / "s.intron.saf").read_text().splitlines()) == 4
    reach = {r.gene: (r.start, r.end) for r in N.extended(exons, 50, 10).groupBy("gene").agg(F.min("start").alias("start"), F.max("end").alias("end")).collect()}
    assert reach == {"B": (100, 950), "A": (950, 1500)}
    iso, skip = N.transcript_indices(exons.select("gene", "tx", "start", "end"))
    assert {(r.gene, tuple(r.members), r.start, r.end) for r in skip.collect()} == {("B", ("B1", "B2"), 220, 398), ("B", ("B2",), 399, 598), ("A", ("A1",), 1100, 1298)}
    text = N.index_entries(iso)
    assert {(r.gene, r.transcripts, r.intervals) for r in text.where("gene = 'A'").collect()} == {("A", "A1", "[999,1099] | [1299,1499]")}
    assert sorted(N.read_index(text).collect()) == sorted(iso.select("gene", "members", "start", "end").collect())
    legacy = spark.createDataFrame([("g", "[10,20] | odd | [9,3]", "t2, t1")], "gene string, intervals string, transcripts string")
    assert [tuple(r) for r in N.read_index(legacy, "exon").collect()] == [("g", ["t2", "t1"], 9, 19)] and [r.end for r in N.read_index(legacy, "refskip").collect()] == [18]


def test_junctions_tell_isoforms_apart(spark):
    ex = spark.createDataFrame([("g", "T1", 1, 100), ("g", "T1", 201, 300), ("g", "T2", 1, 100), ("g", "T2", 151, 300)], "gene string, tx string, start long, end long")
    iso, skip = N.transcript_indices(ex)
    mk = lambda *rows: spark.createDataFrame(rows, "molecule string, gene string, b_start long, b_end long")
    covered = mk(("m1", "g", 50, 99), ("m1", "g", 200, 250), ("m2", "g", 50, 99))
    out = {r.molecule: r.transcripts for r in M.compatible(covered, iso, mk(("m1", "g", 100, 199)), skip).collect()}
    assert out == {"m1": ["T1"], "m2": ["T1", "T2"]}
    assert {r.molecule: r.transcripts for r in M.compatible(covered, iso).collect()} == {"m1": ["T1", "T2"], "m2": ["T1", "T2"]}


def test_molecules_are_stitched(spark):
    rows = [("q1", 99, "chr1", 100, "4M10N4M", "ACGTACGT", "IIIIIIII"), ("q1", 147, "chr1", 114, "2M2D3M", "ACTTT", "IIIII"), ("q2", 99, "chr1", 102, "2S3M", "GGGTA", "##I##")]
    df = spark.createDataFrame([(*r, "W1", "AAAA", None, None, "G1", "E") for r in rows] + [("q3", 355, "chr1", 1, "4M", "ACGT", "IIII", "W1", "AAAA", None, None, "G1", "E"), ("q4", 163, "chr1", 1, "4M", "ACGT", "IIII", "W1", "CCCC", None, None, "G1", "E"), ("q5", 99, "chr1", 1, "4M", "ACGT", "IIII", "W1", " ", None, None, "G1", "E"), ("q6", 99, "chr1", 1, "4M", "ACGT", "IIII", "W1", "GGGG", "G1", "G2", None, None)], "qname string, flag int, rname string, pos long, cigar string, seq string, qual string, CB string, UB string, GE string, GI string, GX string, RE string")
    out = T.stitch(df).collect()
    # Molecule CCCC has no read 1, the blank UMI and the read of two genes are no molecules.
    r = out[0]
    assert len(out) == 1 and r.qname == "W1:G1:AAAA" and r.flag == 0 and r.pos == 100 and (r.NR, r.ER, r.IR) == (2, 2, 0)
    covered = {100, 101, 102, 103, 104, 114, 115, 116, 117, 118, 119, 120}
    assert len(r.seq) == len(r.qual) == len(covered) and r.seq[:4] == "ACGT" and r.cigar == "5M9N7M" and r.NC == 1
    line = T.sam_lines(T.stitch(df)).first().value.split("\t")
    assert line[:6] == ["W1:G1:AAAA", "0", "chr1", "101", "255", "5M9N7M"] and "NC:i:1" in line
    single = df.where("qname = 'q2'").withColumn("flag", F.lit(16))
    assert [x.flag for x in T.stitch(single, paired=False).collect()] == [16]


def test_coverage_sample_is_the_seeded_hash(spark):
    rows = spark.createDataFrame([(f"read{i}",) for i in range(500)], "qname string")
    got = {r.qname for r in rows.where(C.sampled(F.col("qname"), F.lit(0.3), 42, F.lit("UMI"))).collect()}
    share = lambda n: int.from_bytes(hashlib.blake2b(f"42|UMI|{n}".encode(), digest_size=8).digest(), "big") / float(1 << 64)
    assert got == {f"read{i}" for i in range(500) if share(f"read{i}") < 0.3}
    assert rows.where(C.sampled(F.col("qname"), F.lit(1.0))).count() == 500


def test_umi_clusters_equal_the_greedy_definition(spark):
    rnd, rows = random.Random(3), []
    for g in range(6):
        for umi in {"".join(rnd.choice("ACGT") for _ in range(rnd.choice((4, 5)))) for _ in range(80)}:
            rows.append(("w", f"g{g}", umi, rnd.randint(1, 5)))
    df = spark.createDataFrame(rows, "well string, gene string, umi string, n long")
    far = lambda a, b: sum(x != y for x, y in zip(a, b)) if len(a) == len(b) else 99
    for t in (1, 2):
        want = {}
        for g in range(6):
            centres = []
            for _, umi in sorted((-n, u) for _, k, u, n in rows if k == f"g{g}"):
                near = [c for c in centres if far(c, umi) <= t]
                want[f"g{g}", umi] = near[0] if near else umi
                centres += [] if near else [umi]
        assert {(r.gene, r.umi): r.parent for r in X.cluster(df, ["well", "gene"], t).collect()} == want


@pytest.mark.parametrize("length, distance", [(4, 2), (6, 3), (9, 3), (16, 4)])
def test_near_matches_equal_all_pairs(spark, length, distance):
    rnd = random.Random(length)
    true = ["".join(rnd.choice("ACGT") for _ in range(length)) for _ in range(40)]
    seen = true[:5] + ["".join(c if rnd.random() < 0.85 else rnd.choice("ACGT") for c in rnd.choice(true)) for _ in range(60)]
    mk = lambda x: spark.createDataFrame([(b,) for b in set(x)], "barcode string")
    far = lambda a, b: sum(x != y for x, y in zip(a, b))
    want = set()
    for o in set(seen):
        best = min(far(o, t) for t in true)
        want |= {(t, o, best) for t in set(true) if far(o, t) == best and best <= distance}
    assert {tuple(r) for r in B.near_matches(mk(true), mk(seen), distance).collect()} == want


def test_discovery_from_end_to_end(spark):
    c = spark.createDataFrame([("manual", "9", "P1A1", "A" * 20, "umi"), ("manual", "9", "P1A1", "C" * 20, "internal"), ("auto", "1", "P1A2", "G" * 20, "umi"), ("auto", "1", "P1A2", "T" * 20, "umi")], "candidate_type string, candidate_id string, wellID string, barcode string, barcode_type string")
    seen = lambda *x: spark.createDataFrame(x, "XC string, n long")
    _, _, records = B.discover(seen(("A" * 20, 100), ("C" * 19 + "A", 80), ("G" * 20, 5), ("T" * 20, 5)), c)
    assert {r.barcode for r in records.collect()} == {"A" * 20, "C" * 20}
    with pytest.raises(ValueError, match="auto and manual"):
        B.discover(seen(*((x * 20, 10) for x in "ACGT")), c)
    with pytest.raises(ValueError, match="no candidate is sure"):
        B.discover(seen(("A" * 20, 10)), c)


def test_binary_alignments(spark, tmp_path):
    import struct

    def record(name, flag, ref, pos, cigar, seq, qual, tags):
        ops = b"".join(struct.pack("<I", n << 4 | bam.OPERATIONS.index(o)) for n, o in cigar)
        codes = [bam.BASES.index(c) for c in seq] + [0] * (len(seq) % 2)
        packed = bytes(a << 4 | b for a, b in zip(codes[::2], codes[1::2]))
        body = struct.pack("<iiBBHHHiiii", ref, pos, len(name) + 1, 60, 0, len(cigar), flag, len(seq), -1, -1, 0) + name.encode() + b"\0" + ops + packed + bytes(ord(q) - 33 for q in qual) + tags
        return struct.pack("<i", len(body)) + body

    head = b"@SQ\tSN:chr1\tLN:900\n"
    data = b"BAM\1" + struct.pack("<i", len(head)) + head + struct.pack("<i", 1) + struct.pack("<i", 5) + b"chr1\0" + struct.pack("<i", 900)
    rows = [(f"q{i}", 16 * (i % 2), 0 if i % 3 else -1, i, [(3, "M"), (5, "N"), (2, "M")], "ACGTN", "IIIII", b"CBZW1\0NHC\3XBBs\2\0\0\0aabbREAE") for i in range(9000)]
    data += b"".join(record(*r) for r in rows)
    (tmp_path / "a.bam").write_bytes(b"".join(gzip.compress(data[i : i + 60_000]) for i in range(0, len(data), 60_000)) + gzip.compress(b""))
    got = bam.bam(spark, str(tmp_path / "a.bam")).collect()
    assert [(r.qname, r.flag, r.rname, r.pos, r.cigar, r.seq, r.qual, r.CB, r.RE, r.GX) for r in got] == [(n, f, "chr1" if ref == 0 else "*", p, "3M5N2M", s, q, "W1", "E", None) for n, f, ref, p, _, s, q, _ in rows]
    (tmp_path / "b.bam").write_bytes(gzip.compress(data[:-7]))
    with pytest.raises(Exception, match="ends inside"):
        bam.bam(spark, str(tmp_path / "b.bam")).collect()


def test_headers_sorted_records_and_first_ones(spark, tmp_path):
    head = "@HD\tVN:1.6\n@SQ\tSN:chr2\tLN:9\n@SQ\tSN:chr1\tLN:5\n"
    rows = [("b", "chr2", 5), ("a", "chr1", 9), ("c", "chr1", 2)]
    path = write(tmp_path / "x.sam", head + "".join(f"{q}\t0\t{c}\t{p}\t60\t1M\t*\t0\t0\tA\tI\tNH:i:3\n" for q, c, p in rows))
    assert [r.rname for r in formats.contigs(spark, path).collect()] == ["chr2", "chr1"]
    sorted_rows = formats.coordinate_sorted(formats.sam(spark, path, ("NH",)), 2)
    assert [(r.qname, r.NH) for r in sorted_rows.collect()] == [("c", "3"), ("a", "3"), ("b", "3")]
    assert [r.qname for r in formats.numbered_first(sorted_rows, "rname", "pos").orderBy("qname").collect()] == ["b", "c"]


def test_isoform_files(spark, tmp_path):
    rows = spark.createDataFrame([("c1", ["T1"], 10, "m1"), ("c1", ["T1", "T2"], 5, "m2"), ("c2", None, 1, "m3")], "well string, transcripts array<string>, reads long, molecule string")
    axis = lambda *x: spark.createDataFrame([(n, i + 1) for i, n in enumerate(x)], "name string, no long")
    bundles.write_isoforms(M.quantify(rows), rows, axis("T1", "T2"), axis("c1", "c2"), str(tmp_path))
    assert gzip.open(tmp_path / "matrix.mtx.gz", "rt").read().splitlines()[1:] == ["2 2 2", "1 1 1.500000", "2 1 0.500000"]
    assert (tmp_path / "counts.tsv").read_text().splitlines()[1] == "c1\tT1\t1\t1.500000\t15" and (tmp_path / "molecules.tsv").read_text().splitlines()[2] == "m2\t5\tT1,T2"


def test_changes_in_order(spark):
    df = spark.createDataFrame([("a", -3.0, None), ("b", 1.0, 0.1), ("c", 2.0, 0.5)], "gene string, log2fc double, padj double")
    assert [r.gene for r in X.ordered_changes(df).collect()] == ["b", "c", "a"] and [r.gene for r in X.ordered_changes(df.drop("padj")).collect()] == ["a", "c", "b"]
    norm = spark.createDataFrame([("g", "s1", 1.0)], "gene string, sample string, norm double")
    groups = spark.createDataFrame([("s1", "a"), ("s2", "b")], "sample string, grp string")
    with pytest.raises(Exception, match="sample without counts: s2"):
        X.fold_changes(norm, groups, "a", "b").collect()


def test_report_parts(spark):
    assert P.json_literal({"a": "</script>&"}) == '{"a": "\\u003c/script\\u003e\\u0026"}'
    df = spark.createDataFrame([("1,234.6",), ("x",), (None,)], "v string")
    assert [tuple(r) for r in df.select(P.to_number(F.col("v")), P.shown(F.col("v"), "int"), P.shown(F.col("v"), "pct")).collect()] == [(1234.6, "1,235", "123460.0%"), (None, "NA", "NA"), (None, "NA", "NA")]
    page = P.html("<t>", {"rows": df})
    assert "&lt;t&gt;" in page and "1,234.6" in page
    with pytest.raises(ValueError):
        P.html("t", {"rows": df}, most=2)
    quality = spark.createDataFrame([("R1", 1000, 900, 0.9), ("BC", 100, 50, 0.5)], "metric string, total_bases long, q30_bases long, q30_rate double")
    seen = spark.createDataFrame([("A", 60)], "XC string, n long")
    rows = {r.metric: r.value for r in P.sequencing_quality(None, quality, 10, seen).collect()}
    assert rows["Total sequencing reads"] == "100" and rows["Valid barcode rate"] == "60.0%" and rows["Unused barcode reads"] == "NA" and rows["Cell barcode Q30"] == "50.0%" and rows["UMI Q30"] == "NA"
    assert P.versioned(spark.createDataFrame([(1,)], "schema_version int")).count() == 1
    with pytest.raises(Exception, match="unknown schema version 2"):
        P.versioned(spark.createDataFrame([(2,)], "schema_version int")).collect()


def test_command_line():
    assert cli.checked(["--config", "c.json", "--set", "limit=5", "--plate", "1, 2"]).plate == "1, 2"
    assert cli.settings(cli.checked(["--config", "c.json", "--set", "limit=5", "--plate", "1, 2"]), {"a": 1}) == {"a": 1, "limit": 5, "plate": ["1", "2"]}
    for bad in ([], ["--config", "c", "--resume", "d"], ["--config", "c", "--stage", "Counting"], ["--config", "c", "--manual", "1", "--plate", "2"], ["--resume", "d", "--stage", "Counting", "--last", "Mapping"], ["--config", "c", "--isoform-index-only", "--isoform-matrix"], ["--config", "c", "--isoform-matrix", "--skip-isoforms"]):
        with pytest.raises(SystemExit):
            cli.checked(bad)


def test_a_run_from_end_to_end(spark, tmp_path):
    rnd, out = random.Random(5), tmp_path / "out"
    wells = {"ACGTACGTACGTACGTACGT": "P1A1", "TTGGTTGGTTGGTTGGTTGG": "P1A2"}
    first, second, sam, truth = [], [], ["@SQ\tSN:chr1\tLN:5000"], {}
    for i in range(60):
        bc, gene = rnd.choice(sorted(wells)), rnd.choice("AB")
        umi = rnd.choice(("AAAAAAAAAA", "CCCCCCCCCC", "GGGGGTTTTT"))
        shown = bc[:-1] + "C" if i % 10 == 0 else bc
        first.append((f"r{i}/1", umi + "A" * 20, "I" * 30))
        second.append((f"r{i}/2", "C" * 30 + shown, "I" * 50))
        at = 1020 if gene == "A" else 420
        sam.append(f"r{i}\t0\tchr1\t{at}\t60\t20M\t*\t0\t0\t{'A' * 20}\t{'I' * 20}")
        truth.setdefault((wells[bc], gene), set()).add(umi)
    write(tmp_path / "fq" / "x_R1.fastq.gz", fastq(first))
    write(tmp_path / "fq" / "x_R2.fastq.gz", fastq(second))
    config = {"project": "p", "out_dir": str(out), "fastqs": str(tmp_path / "fq"), "expected": write(tmp_path / "e.tsv", "wellID\tumi\tinternal\n" + "".join(f"{w}\t{b}\t\n" for b, w in wells.items())), "alignments": write(tmp_path / "a.sam", "\n".join(sam) + "\n"), "gtf": write(tmp_path / "a.gtf", GTF)}
    run = runs.Run(spark, config)
    with pytest.raises(RuntimeError, match="has not been done"):
        runs.start(run, runs.COUNTING)
    runs.start(run)
    got = {(r.well, r.gene): r.n for r in bundles.read_mex(spark, run.at("expression/p.exon.umi")).collect()}
    assert got == {k: len(v) for k, v in truth.items()}
    assert sum(r.n for r in bundles.read_mex(spark, run.at("expression/p.exon.read")).collect()) == 60
    assert "p" in (out / "p.report.html").read_text() and (out / "stats/p.stats.tsv").read_text().startswith("well\t")
    delivered = runs.deliver(run)
    assert any(f["path"].endswith("p.exon.umi/matrix.mtx.gz") and f["sha256"] for f in delivered["files"])
    assert runs.artifact(run.files, "p", "stats", ".stats.tsv") == "stats/p.stats.tsv" and runs.artifact(run.files, "q", "stats", ".stats.tsv") is None
    again = runs.Run(spark, runs.load_config(spark, str(out)))
    runs.start(again, runs.SUMMARISING)
    with pytest.raises(RuntimeError, match="another configuration"):
        runs.start(runs.Run(spark, config | {"introns": False}), runs.SUMMARISING)
    with pytest.raises(ValueError, match="holds the run of p"):
        runs.start(runs.Run(spark, config | {"project": "other"}))
    (out / "stats" / "p.stats.tsv").write_text("")
    with pytest.raises(RuntimeError, match="missing, empty or changed"):
        runs.check_manifest(run, runs.SUMMARISING)
    run.files.write("run.lock", json.dumps({"pid": 1, "host": "elsewhere"}))
    with pytest.raises(RuntimeError, match="is locked by"):
        runs.start(again, runs.SUMMARISING)
    assert runs.preflight(runs.Run(spark, {"project": "p", "out_dir": str(out)})) != []
