"""Queries of the first stage, annotations, coverage, stitching and reports, each with independent SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as E
from ..operators import annotation as N
from ..operators import assign as A
from ..operators import coverage as C
from ..operators import expression as X
from ..operators import intervals as I
from ..operators import isoform as M
from ..operators import qc as Q
from ..operators import reads as R
from ..operators import report as P
from ..operators import stitch as T
from ..sources import sheets as S
from .registered import BODIES, COVERED, ELIGIBLE, INTRONS, LOCI, MATRIX, MODELS, OVERLAP, STATS, SUMMARY, blocks, categorised, eligible, query, rounded

# The first stage

PAIRS = """pairs AS (SELECT qname, bc || umi || substr(gene, 2) AS seq1, repeat(chr(cast(33 + phred as int)), 11) AS qual1, umi || bc AS seq2, repeat(chr(cast(34 + phred as int)), 8) AS qual2,
    CASE WHEN source = 'UMI' THEN gene END AS fixed FROM reads),
    cut AS (SELECT *, coalesce(fixed, substr(seq1, 1, 4)) AS "CR", CASE WHEN fixed IS NULL THEN substr(qual1, 1, 4) ELSE 'IIII' END AS "CY", substr(seq1, 5, 4) AS "UR", substr(qual1, 5, 4) AS "UY" FROM pairs),
    judged AS (SELECT *, seq2 LIKE 'A%' AND len(list_filter(range(1, 5), lambda i: ascii(substr("CY", i, 1)) - 33 < 20)) < 2 AND len(list_filter(range(1, 5), lambda i: ascii(substr("UY", i, 1)) - 33 < 10)) < 3 AS keep FROM cut)"""
LAYOUTS = (R.parse_layout("BC(1-4);UMI(5-8);cDNA(9-11)"), R.parse_layout(["cDNA(2-8)"]))


def pairs(v) -> DataFrame:
    quality = lambda more, n: F.repeat(F.char(F.col("phred") + 33 + more), F.lit(n))
    return v("reads").select(
        "qname", F.concat("bc", "umi", F.substring("gene", 2, 3)).alias("seq1"), quality(0, 11).alias("qual1"), F.concat("umi", "bc").alias("seq2"), quality(1, 8).alias("qual2"),
        F.when(F.col("source") == "UMI", F.col("gene")).alias("fixed"),
    )


def filtered(v) -> DataFrame:
    return R.filter_pairs(pairs(v), LAYOUTS, (None, R.parse_pattern("A")), (2, 20), (3, 10), "fixed")


@query("p04_filter_pairs", 'SELECT qname, "CR", "CY", "UR", "UY", keep FROM judged', PAIRS)
def _(v):
    return filtered(v).select("qname", "CR", "CY", "UR", "UY", "keep")


@query("p06_fixed_barcodes", """SELECT "CR", "CY", count(*) AS n FROM judged WHERE fixed IS NOT NULL AND keep GROUP BY 1, 2""", PAIRS)
def _(v):
    return filtered(v).where("keep AND fixed IS NOT NULL").groupBy("CR", "CY").agg(F.count(F.lit(1)).alias("n"))


@query("s07_unmapped_records", """SELECT qname, 77 AS flag, substr(seq1, 9, 3) AS seq, substr(qual1, 9, 3) AS qual, "CR", "UR" FROM judged WHERE keep
    UNION ALL SELECT qname, 141, substr(seq2, 2, 7), substr(qual2, 2, 7), "CR", "UR" FROM judged WHERE keep""", PAIRS)
def _(v):
    return R.unmapped_records(filtered(v).where("keep")).select("qname", "flag", "seq", "qual", "CR", "UR")


@query("p08_first_pairs", "SELECT qname, seq1 FROM pairs ORDER BY qname, seq1 LIMIT 500", PAIRS)
def _(v):
    return R.first_pairs(pairs(v), 500, ("qname", "seq1")).select("qname", "seq1")


@query("a04_layout", "SELECT CASE WHEN arg_min(flag, qname) = 4 THEN 'SE' ELSE 'PE' END AS layout FROM reads")
def _(v):
    return R.layout_of(v("reads"), ("qname",))


@query("a34_modal_length", "SELECT l AS length FROM (SELECT length(d) AS l FROM (SELECT q1 || q2 AS d FROM quals WHERE length(q1 || q2) > 0 ORDER BY doc_id, d LIMIT 1000)) GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1")
def _(v):
    return R.modal_length(v("quals").select("doc_id", F.concat("q1", "q2").alias("seq")), 1000, ("doc_id", "seq"))


@query("a03_merged_stats", "SELECT upper(barcode) AS barcode, cast(sum(n) as bigint) AS n FROM (SELECT lower(bc) AS barcode, count(*) AS n FROM reads GROUP BY bc, chrom) GROUP BY 1")
def _(v):
    return R.merged_stats(v("reads").groupBy(F.lower("bc").alias("barcode"), "chrom").agg(F.count(F.lit(1)).alias("n")))


@query("a03_merged_quality", """SELECT metric, total_bases, q30_bases, q30_rate FROM (SELECT re AS metric, cast(sum(length(umi)) as bigint) AS total_bases, cast(sum(CASE WHEN phred >= 30 THEN 4 ELSE 0 END) as bigint) AS q30_bases,
    round(sum(CASE WHEN phred >= 30 THEN 4 ELSE 0 END) / sum(length(umi)), 6) AS q30_rate FROM reads GROUP BY 1)""")
def _(v):
    parts = v("reads").groupBy(F.col("re").alias("metric"), "chrom").agg(F.sum(F.length("umi")).alias("total_bases"), F.sum(F.when(F.col("phred") >= 30, 4).otherwise(0)).alias("q30_bases"))
    return rounded(R.merged_quality(parts), "q30_rate")


@query("a12_merged_categories", 'SELECT well, "Exon", "Intron", umi_reads FROM stats', STATS)
def _(v):
    each = [Q.read_stats(categorised(v).where(F.col("source") == s)) for s in ("UMI", "Internal")]
    return R.merged_categories(each[0].unionByName(each[1]), ["Exon", "Intron", "umi_reads"])


@query("p11_corrected_once", """SELECT qname, CASE WHEN done THEN 'old' ELSE bc END AS "CC", CASE WHEN done THEN 'X' ELSE well END AS "CB" FROM (SELECT qname, min(bc) AS bc, min(well) AS well, min(phred) < 20 AS done FROM reads GROUP BY 1)""")
def _(v):
    own = v("reads").groupBy("qname").agg(*[F.min(c).alias(c) for c in ("bc", "well", "phred")])
    done = F.col("phred") < 20
    rows = own.select("qname", F.when(done, "old").alias("CC"), F.when(done, "X").alias("CB"))
    new = own.select("qname", F.col("bc").alias("CC"), F.col("well").alias("CB"))
    return R.corrected_once(rows, new).select("qname", "CC", "CB")


def tagged(v) -> DataFrame:
    return v("reads").select("qname", "source", (F.col("source") == "Internal").alias("is_internal"), F.when(F.col("phred") > 5, F.col("well")).alias("CB"), F.when(F.col("source") == "UMI", F.col("umi")).alias("UR"))


@query("p12_streams", """SELECT qname, 'umi' AS stream FROM reads WHERE source <> 'Internal' OR phred <= 5 UNION ALL SELECT qname, 'internal' FROM reads WHERE source = 'Internal'""")
def _(v):
    a, b = R.streams(tagged(v))
    return a.select("qname", F.lit("umi").alias("stream")).unionByName(b.select("qname", F.lit("internal").alias("stream")))


@query("p13_with_umi", "SELECT qname, source = 'UMI' AS has_umi FROM reads")
def _(v):
    a, b = R.with_umi(tagged(v))
    return a.select("qname", F.lit(True).alias("has_umi")).unionByName(b.select("qname", F.lit(False).alias("has_umi")))


@query("j05_samplesheet_wells", """SELECT barcode, min("wellID") AS "wellID", min(kind) AS kind FROM expected GROUP BY 1 HAVING count(*) = 1""")
def _(v):
    own = v("expected")
    single = own.groupBy("barcode").agg(F.count(F.lit(1)).alias("k")).where("k = 1").select("barcode")
    return S.resolve_samplesheet(single, own.join(single, "barcode", "left_semi")).select("barcode", "wellID", "kind")


@query("s14_id_map", """SELECT barcode, arg_max("wellID", "wellID" || kind) AS "wellID", arg_max(kind, "wellID" || kind) AS kind FROM expected GROUP BY 1""")
def _(v):
    order = F.dense_rank().over(Window.partitionBy("barcode").orderBy("wellID", F.col("kind")))
    return S.id_map(v("expected").withColumn("line_no", order).withColumn("at", F.lit(0)))


@query("s25_expected_lines", """SELECT "wellID", coalesce(string_agg(barcode, ',' ORDER BY barcode) FILTER (kind = 'umi'), '') AS umi_barcodes, coalesce(string_agg(barcode, ',' ORDER BY barcode) FILTER (kind = 'internal'), '') AS internal_barcodes FROM expected GROUP BY 1""")
def _(v):
    return S.expected_lines(v("expected").withColumnRenamed("kind", "barcode_type"), ("wellID",))


# Annotation

KEY = ["chrom", "strand"]


@query("i02_merge_touching", """SELECT chrom, strand, min("start") AS "start", max("end") AS "end" FROM (SELECT *, sum(new) OVER (PARTITION BY chrom, strand ORDER BY "start", "end" ROWS UNBOUNDED PRECEDING) AS isl FROM
    (SELECT *, CASE WHEN "start" > coalesce(max("end") OVER (PARTITION BY chrom, strand ORDER BY "start", "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -9) THEN 1 ELSE 0 END AS new FROM exons)) GROUP BY chrom, strand, isl""")
def _(v):
    return I.merge(v("exons").select("chrom", "strand", "start", "end"), KEY, gap=0)


def two_sets(v) -> tuple[DataFrame, DataFrame]:
    rows = v("exons").select("chrom", "start", "end", "strand")
    return (rows.where(F.col("strand") == s).drop("strand") for s in "+-")


SETS = """pos AS (SELECT DISTINCT chrom, strand, unnest(generate_series("start", "end")) AS posn FROM exons),
    both_sets AS (SELECT coalesce(a.chrom, b.chrom) AS chrom, coalesce(a.posn, b.posn) AS posn, a.posn IS NOT NULL AS a, b.posn IS NOT NULL AS b FROM (SELECT * FROM pos WHERE strand = '+') a
    FULL JOIN (SELECT * FROM pos WHERE strand = '-') b ON a.chrom = b.chrom AND a.posn = b.posn)"""
RUNS = """SELECT chrom, min(posn) AS "start", max(posn) AS "end" FROM (SELECT chrom, posn, posn - row_number() OVER (PARTITION BY chrom ORDER BY posn) AS isl FROM both_sets WHERE {}) GROUP BY chrom, isl"""


@query("i03_intersect", RUNS.format("a AND b"), SETS)
def _(v):
    return I.intersect(*two_sets(v), ["chrom"])


@query("i05_difference", RUNS.format("a AND NOT b"), SETS)
def _(v):
    return I.difference(*two_sets(v), ["chrom"])


@query("i05_union", RUNS.format("a OR b"), SETS)
def _(v):
    return I.union(*two_sets(v), ["chrom"])


@query("i05_extent", """SELECT chrom, strand, count(DISTINCT isl) AS n, count(*) AS bases, min(posn) AS first, max(posn) AS last FROM (SELECT *, posn - row_number() OVER (PARTITION BY chrom, strand ORDER BY posn) AS isl FROM pos) GROUP BY 1, 2""", SETS)
def _(v):
    return I.extent(v("exons").select("chrom", "strand", "start", "end"), KEY)


@query("i05_internal_gaps", """SELECT chrom, min(posn) AS "start", max(posn) AS "end" FROM (SELECT chrom, posn, posn - row_number() OVER (PARTITION BY chrom ORDER BY posn) AS isl FROM
    (SELECT s.chrom, s.posn FROM (SELECT chrom, unnest(generate_series(0, max(posn) + 5)) AS posn FROM pos GROUP BY 1) s LEFT JOIN (SELECT DISTINCT chrom, posn FROM pos) p ON s.chrom = p.chrom AND s.posn = p.posn WHERE p.posn IS NULL)) GROUP BY chrom, isl""", SETS)
def _(v):
    rows = v("exons").select("chrom", "start", "end")
    return I.internal_gaps(rows, rows.groupBy("chrom").agg(F.lit(0).cast("long").alias("start"), (F.max("end") + 5).alias("end")), ["chrom"])


@query("r18_overlaps", """SELECT gene, count(CASE WHEN "start" <= 9000 AND 8000 <= "end" THEN 1 END) AS hit, count(CASE WHEN 8100 BETWEEN "start" AND "end" THEN 1 END) AS point FROM exons GROUP BY 1""")
def _(v):
    meets = lambda a, b: F.count(F.when(I.overlaps(F.col("start"), F.col("end"), F.lit(a), F.lit(b)), 1))
    return v("exons").groupBy("gene").agg(meets(8000, 9000).alias("hit"), meets(8100, 8100).alias("point"))


MERGED = """ex2 AS (SELECT chrom, strand, gene, min(posn) AS s, max(posn) AS e FROM (SELECT *, posn - row_number() OVER (PARTITION BY chrom, strand, gene ORDER BY posn) AS isl FROM bases) GROUP BY chrom, strand, gene, isl)"""


@query("i08_saf", """SELECT gene AS "GeneID", chrom AS "Chr", s AS "Start", e AS "End", strand AS "Strand" FROM ex2 UNION ALL SELECT gene || '__INTRON__', chrom, "start", "end", strand FROM introns""", COVERED, LOCI, BODIES, *INTRONS, MERGED)
def _(v):
    return N.saf(v("exons")).select("GeneID", "Chr", "Start", "End", "Strand")


@query("s17_saf_kinds", """SELECT intron, count(*) AS n, cast(sum(len) as bigint) AS bases FROM (SELECT false AS intron, e - s + 1 AS len FROM ex2 UNION ALL SELECT true, "end" - "start" + 1 FROM introns) GROUP BY 1""", COVERED, LOCI, BODIES, *INTRONS, MERGED)
def _(v):
    return N.saf(v("exons")).groupBy("intron").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("End") - F.col("Start") + 1).cast("long").alias("bases"))


@query("s16_interval_index", """SELECT chrom, bin, gene, intron, count(*) AS n FROM (SELECT chrom, gene, intron, unnest(generate_series(s // 1000, e // 1000)) AS bin FROM
    (SELECT chrom, gene, false AS intron, s, e FROM ex2 UNION ALL SELECT chrom, gene, true, "start", "end" FROM introns)) GROUP BY 1, 2, 3, 4""", COVERED, LOCI, BODIES, *INTRONS, MERGED)
def _(v):
    return N.interval_index(N.saf(v("exons")), 1000).groupBy("chrom", "bin", "gene", "intron").agg(F.count(F.lit(1)).alias("n"))


TIPS = """tips AS (SELECT gene, chrom, strand, CASE WHEN strand = '-' THEN -"start" ELSE "end" END AS tip FROM exons),
    tip AS (SELECT gene, any_value(chrom) AS chrom, any_value(strand) AS strand, max(tip) AS tip FROM tips GROUP BY 1),
    edges AS (SELECT DISTINCT chrom, strand, CASE WHEN strand = '-' THEN -hi ELSE lo END AS edge FROM (SELECT chrom, strand, min(posn) AS lo, max(posn) AS hi FROM (SELECT *, posn - r AS isl FROM loci) GROUP BY chrom, strand, isl)),
    reach AS (SELECT t.gene, t.tip, min(e.edge) - t.tip AS gap FROM tip t LEFT JOIN edges e ON e.chrom = t.chrom AND e.strand = t.strand AND e.edge > t.tip GROUP BY 1, 2)"""


@query("i08_extended_tips", """SELECT gene, cast(tip + CASE WHEN gap IS NULL OR gap > 110 THEN 100 WHEN gap <= 10 THEN 0 ELSE gap - 10 END as bigint) AS tip FROM reach""", COVERED, LOCI, TIPS)
def _(v):
    out = N.extended(v("exons").select("chrom", "strand", "gene", "start", "end"), 100, 10)
    return out.groupBy("gene").agg(F.max(F.when(F.col("strand") == "-", -F.col("start")).otherwise(F.col("end"))).cast("long").alias("tip"))


@query("i11_junction_index", """SELECT gene, members, cast(count(*) as bigint) AS bases FROM (SELECT gene, posn, list_sort(list(DISTINCT tx)) AS members FROM (SELECT gene, tx, unnest(generate_series(s, e)) AS posn FROM
    (SELECT gene, tx, "end" - 1 + 1 AS s, lead("start") OVER (PARTITION BY gene, tx ORDER BY "start", "end") - 2 AS e FROM exons) WHERE s <= e) GROUP BY 1, 2) GROUP BY 1, 2""")
def _(v):
    inner = N.transcript_indices(v("exons").select("gene", "tx", "start", "end"))[1]
    return inner.groupBy("gene", "members").agg(F.sum(F.col("end") - F.col("start") + 1).cast("long").alias("bases"))


@query("s29_index_round_trip", """SELECT gene, members, cast(count(*) as bigint) AS bases FROM (SELECT gene, posn, list_sort(list(DISTINCT tx)) AS members FROM (SELECT gene, tx, unnest(generate_series("start", "end")) AS posn FROM exons) GROUP BY 1, 2) GROUP BY 1, 2""")
def _(v):
    entries = N.transcript_indices(v("exons").select("gene", "tx", "start", "end"))[0]
    back = N.read_index(N.index_entries(entries))
    return back.groupBy("gene", "members").agg(F.sum(F.col("end") - F.col("start") + 1).cast("long").alias("bases"))


@query("i12_gene_clusters", """SELECT chrom, gene, cast(sum(new) OVER (PARTITION BY chrom ORDER BY s, e, gene ROWS UNBOUNDED PRECEDING) as int) AS cluster FROM (SELECT *, CASE WHEN coalesce(s > max(e) OVER (PARTITION BY chrom ORDER BY s, e, gene ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1, true) THEN 1 ELSE 0 END AS new
    FROM (SELECT chrom, gene, min("start") AS s, min("start") + 500 AS e FROM exons GROUP BY 1, 2))""")
def _(v):
    regions = v("exons").groupBy("chrom", "gene").agg(F.min("start").alias("start"), (F.min("start") + 500).alias("end"))
    return N.clusters(regions).select("chrom", "gene", "cluster")


@query("p18_resolved_tags", """SELECT qname, coalesce(CASE WHEN phred > 10 THEN gene END, CASE WHEN phred > 5 THEN 'G' || umi END) AS gene, CASE WHEN phred > 10 THEN 'E' WHEN phred > 5 THEN 'N' END AS kind FROM reads""")
def _(v):
    tags = F.array(F.lit(""), F.when(F.col("phred") > 5, F.concat(F.lit("G"), "umi", F.lit(N.INTRON))), F.when(F.col("phred") > 10, F.col("gene")), F.when(F.col("phred") > 10, F.lit("later")))
    gene, kind, _c = N.resolve_tags(tags)
    return v("reads").select("qname", gene.alias("gene"), kind.alias("kind"))


@query("p20_opposite_strand", "SELECT qname, gene, overlap, ties FROM stop", COVERED, OVERLAP, """sov AS (SELECT qname, gene, cast(sum(least(b_end, e) - greatest(b_start, s) + 1) as bigint) AS overlap FROM blk JOIN ex ON blk.chrom = ex.chrom AND blk.strand <> ex.strand AND b_start <= e AND s <= b_end GROUP BY 1, 2),
    stop AS (SELECT *, count(*) OVER (PARTITION BY qname) AS ties FROM (SELECT *, rank() OVER (PARTITION BY qname ORDER BY overlap DESC) AS r FROM sov) WHERE r = 1)""")
def _(v):
    return A.best_gene(blocks(v), I.merge(v("exons"), [*KEY, "gene"]), 2)


@query("p21_gene_names", "SELECT r.qname, r.gene, coalesce(g.name, r.gene) AS gene_name FROM reads r LEFT JOIN (SELECT gene, 'name-' || gene AS name FROM genes WHERE gene < 'G025') g ON r.gene = g.gene")
def _(v):
    known = v("genes").where("gene < 'G025'").withColumn("name", F.concat(F.lit("name-"), "gene"))
    return N.named(v("reads").select("qname", "gene"), known)


@query("p34_assigned_gene", """SELECT qname, CASE WHEN e IS NOT NULL AND i IS NOT NULL AND e <> i THEN NULL ELSE coalesce(e, i) END AS gene, e IS NOT NULL AS exonic, i IS NOT NULL AS intronic FROM
    (SELECT qname, coalesce(CASE WHEN phred > 40 THEN gene END, CASE WHEN re = 'E' THEN gene END) AS e, coalesce(CASE WHEN phred > 45 THEN 'G001' END, CASE WHEN re = 'N' THEN gene END) AS i FROM reads)""")
def _(v):
    gene, e, i = M.assigned_gene(F.when(F.col("phred") > 40, F.col("gene")), F.when(F.col("phred") > 45, F.lit("G001")), F.col("gene"), F.col("re"))
    return v("reads").select("qname", gene.alias("gene"), e.alias("exonic"), i.alias("intronic"))


# Coverage


@query("a33_primary_mapped", "SELECT count(*) AS mapped FROM reads WHERE (flag & 2308) = 0 AND (flag & 64) <> 0")
def _(v):
    return C.primary_mapped(v("reads"))


@query("p15_primary", "SELECT flag, (flag & 4) = 0 AND (flag & 2304) = 0 AND ((flag & 1) = 0 OR (flag & 64) <> 0) AS counts FROM (SELECT DISTINCT flag FROM reads)")
def _(v):
    return v("reads").select("flag").distinct().withColumn("counts", C.is_primary(F.col("flag")))


@query("p25_sampling_fraction", "SELECT well, least(1.0::double, 100.0::double / count(*)) AS fraction FROM reads GROUP BY 1")
def _(v):
    return v("reads").groupBy("well").agg(F.count(F.lit(1)).alias("n")).select("well", C.sampling_fraction(F.col("n"), 100).alias("fraction"))


COVERAGE = """spots AS (SELECT t.gene, t.chrom, t.posn, t.strand, b.length, row_number() OVER (PARTITION BY t.gene ORDER BY CASE WHEN t.strand = '-' THEN -t.posn ELSE t.posn END) - 1 AS t FROM txb t JOIN best b ON t.gene = b.gene AND t.tx = b.tx),
    bestex AS (SELECT gene, chrom, posn FROM txb JOIN best USING (gene, tx)),
    hits AS (SELECT qname, gene, count(*) AS overlap FROM (SELECT DISTINCT qname, chrom, source, b_start, b_end FROM reads) r JOIN bestex x ON r.chrom = x.chrom AND x.posn BETWEEN r.b_start AND r.b_end GROUP BY 1, 2),
    firsts AS (SELECT qname, min(gene) AS gene FROM (SELECT *, rank() OVER (PARTITION BY qname ORDER BY overlap DESC) AS rk FROM hits) WHERE rk = 1 GROUP BY 1 HAVING count(*) = 1),
    cov AS (SELECT r.source, b.bin, sum(1.0 / ((b.bin + 1) * s.length // 100 - b.bin * s.length // 100)) AS coverage FROM (SELECT DISTINCT qname, chrom, source, b_start, b_end FROM reads) r JOIN firsts f ON r.qname = f.qname
    JOIN spots s ON s.gene = f.gene AND s.chrom = r.chrom AND s.posn BETWEEN r.b_start AND r.b_end JOIN (SELECT unnest(range(0, 100)) AS bin) b ON s.t >= b.bin * s.length // 100 AND s.t < (b.bin + 1) * s.length // 100 GROUP BY 1, 2)"""


def body_coverage(v) -> DataFrame:
    return A.gene_body_coverage(blocks(v), A.gene_models(v("exons")))


@query("a25_gene_body_coverage", "SELECT source, cast(bin as int) AS bin, round(coverage, 6) AS coverage FROM cov", MODELS, COVERAGE)
def _(v):
    return rounded(body_coverage(v), "coverage")


@query("w04_exon_offsets", """SELECT gene, cast(sum(before) as bigint) AS before FROM (SELECT gene, isl, min(t) AS before FROM (SELECT *, row_number() OVER (PARTITION BY gene ORDER BY posn) - posn AS isl FROM
    (SELECT t.gene, t.posn, row_number() OVER (PARTITION BY t.gene ORDER BY CASE WHEN t.strand = '-' THEN -t.posn ELSE t.posn END) - 1 AS t FROM txb t JOIN best b ON t.gene = b.gene AND t.tx = b.tx)) GROUP BY 1, 2) GROUP BY 1""", MODELS)
def _(v):
    return A.gene_models(v("exons")).groupBy("gene").agg(F.sum("before").cast("long").alias("before"))


PADDED = """counted AS (SELECT source, b_start % 97 AS bin, cast(count(*) as double) AS coverage FROM reads GROUP BY 1, 2),
    filled AS (SELECT s.source, b.bin, coalesce(c.coverage, 0) AS coverage FROM (SELECT DISTINCT source FROM reads) s, (SELECT unnest(range(0, 100)) AS bin) b LEFT JOIN counted c ON c.source = s.source AND c.bin = b.bin),
    smooth AS (SELECT f.source, f.bin, f.coverage, sum(g.coverage) / 7 AS smooth FROM filled f, (SELECT unnest(range(-3, 4)) AS d) o, filled g WHERE g.source = f.source AND g.bin = least(99, greatest(0, f.bin + o.d)) GROUP BY 1, 2, 3)"""


@query("w08_smoothed_curve", "SELECT source, cast(bin as int) AS bin, coverage, round(smooth, 6) AS smooth, round(smooth / max(smooth) OVER (PARTITION BY source), 6) AS max_norm FROM smooth", PADDED)
def _(v):
    bins = v("reads").groupBy("source", (F.col("b_start") % 97).cast("int").alias("bin")).agg(F.count(F.lit(1)).cast("double").alias("coverage"))
    return rounded(C.curve(bins), "smooth", "max_norm")


# Stitching

ALIGNED = """al AS (SELECT qname, well || '-' || gene || '-' || umi AS molecule, b_start AS pos, 5 + phred AS m1, 1 + phred % 7 AS d, 10 + phred % 50 AS skip, b_end % 9 AS m2 FROM reads WHERE re = 'E')"""
ALIGNED_SPARK = "concat('2S', 5 + phred, 'M', 1 + phred % 7, 'D', 10 + phred % 50, 'N', 1 + b_end % 9, 'M')"


def aligned(v) -> DataFrame:
    return v("reads").where("re = 'E'").select("qname", F.concat_ws("-", "well", "gene", "umi").alias("molecule"), F.col("b_start").alias("pos"), F.expr(ALIGNED_SPARK).alias("cigar"))


@query("p16_cigar_blocks", """SELECT qname, pos AS s, pos + m1 AS e FROM al UNION ALL SELECT qname, pos + m1 + d + skip, pos + m1 + d + skip + 1 + m2 FROM al""", ALIGNED)
def _(v):
    return aligned(v).select("qname", F.explode(E.cigar_blocks(F.col("pos"), F.col("cigar"))).alias("b")).select("qname", F.col("b.start").alias("s"), F.col("b.end").alias("e"))


@query("p17_skipped", "SELECT qname, cast(pos + m1 + d as bigint) AS s, cast(pos + m1 + d + skip - 1 as bigint) AS e FROM al", ALIGNED)
def _(v):
    return T.skipped(aligned(v), "qname").select("qname", F.col("start").alias("s"), F.col("end").alias("e"))


SPELT = """cov2 AS (SELECT DISTINCT molecule, unnest(generate_series(pos, pos + m1 - 1)) AS p FROM al UNION SELECT molecule, unnest(generate_series(pos + m1 + d + skip, pos + m1 + d + skip + m2)) FROM al),
    skp AS (SELECT DISTINCT molecule, unnest(generate_series(pos + m1 + d, pos + m1 + d + skip - 1)) AS p FROM al),
    spanned AS (SELECT molecule, min(p) AS lo, max(p) AS hi, unnest(generate_series(min(p), max(p))) AS p FROM cov2 GROUP BY 1),
    letters AS (SELECT s.molecule, s.lo, s.p, CASE WHEN c.p IS NOT NULL THEN 'M' WHEN k.p IS NOT NULL THEN 'N' ELSE 'D' END AS op, c.p IS NOT NULL AND k.p IS NOT NULL AS clash FROM spanned s LEFT JOIN cov2 c ON s.molecule = c.molecule AND s.p = c.p LEFT JOIN skp k ON s.molecule = k.molecule AND s.p = k.p),
    parts AS (SELECT molecule, lo, op, min(p) AS place, count(*) AS n, count(CASE WHEN clash THEN 1 END) AS clash FROM (SELECT *, p - row_number() OVER (PARTITION BY molecule, op ORDER BY p) AS isl FROM letters) GROUP BY molecule, lo, op, isl)"""


@query("p37_synthesised_cigar", "SELECT molecule, lo AS pos, string_agg(n || op, '' ORDER BY place) AS cigar, cast(sum(clash) as bigint) AS conflict FROM parts GROUP BY 1, 2", ALIGNED, SPELT)
def _(v):
    rows = aligned(v)
    covered = rows.select("molecule", F.explode(E.cigar_blocks(F.col("pos"), F.col("cigar"))).alias("b")).select("molecule", F.col("b.start").alias("start"), (F.col("b.end") - 1).alias("end"))
    return T.synthesised(covered, T.skipped(rows, "molecule"))


@query("p35_usable_reads", """SELECT qname, gene, CASE WHEN (flag & 16) <> 0 THEN '-' ELSE '+' END AS strand, (flag & 64) <> 0 AS first FROM reads WHERE (flag & 2308) = 0 AND (flag & 11) = 3 AND re IN ('E', 'N') AND well <> 'P1A1'""")
def _(v):
    none = F.lit(None).cast("string")
    rows = v("reads").select("qname", "flag", F.col("well").alias("CB"), F.col("umi").alias("UB"), none.alias("GE"), none.alias("GI"), F.col("gene").alias("GX"), F.col("re").alias("RE"))
    return T.usable(rows, v("wells").where("well <> 'P1A1'").withColumnRenamed("well", "cell")).select("qname", "gene", "strand", "first")


# Reports


@query("a21_matrix_stats", "SELECT well, cast(sum(n) as bigint) AS umis, count(*) AS genes FROM (SELECT well, gene, n FROM matrix WHERE ftype = 'exon') GROUP BY 1", ELIGIBLE, MATRIX)
def _(v):
    return P.matrix_stats(X.read_matrix(eligible(v)).where("ftype = 'exon'"))


@query("a26_category_shares", """SELECT category, round(n / sum(n) OVER (), 6) AS share FROM (SELECT unnest(['Exon', 'Intron', 'Intergenic', 'Ambiguity', 'Unmapped', 'Unused BC']) AS category,
    unnest([sum("Exon"), sum("Intron"), sum("Intergenic"), sum("Ambiguity"), sum("Unmapped"), 0]) AS n FROM stats)""", STATS)
def _(v):
    return rounded(P.category_shares(Q.read_stats(categorised(v))), "share")


@query("a26_cell_shares", """SELECT well, 'Exon' AS category, round("Exon" / t, 6) AS share FROM (SELECT *, "Exon" + "Intron" + "Intergenic" + "Ambiguity" + "Unmapped" AS t FROM stats) WHERE t > 0""", STATS)
def _(v):
    return rounded(P.cell_shares(Q.read_stats(categorised(v))).where("category = 'Exon'"), "share")


@query("r13_read_counts", "SELECT cast(sum(umi_reads + internal_reads) as bigint) AS total, cast(sum(umi_reads + internal_reads) as bigint) AS valid, cast(0 as bigint) AS unused, cast(1 as double) AS valid_rate FROM stats", STATS)
def _(v):
    return P.read_counts(Q.read_stats(categorised(v)), Q.CATEGORIES)


@query("a29_sequencing_quality", """SELECT no, metric, value FROM (SELECT unnest([1, 2, 3, 4, 5, 6, 7, 8]) AS no, unnest(['Total sequencing reads', 'Valid barcode reads', 'Unused barcode reads', 'Valid barcode rate', 'Cell barcode Q30', 'UMI Q30', 'Read1 cDNA Q30', 'Read2 cDNA Q30']) AS metric,
    unnest([format('{:,}', count(*)), format('{:,}', count(*)), '0', '100.0%', printf('%.1f%%', 100.0 * (SELECT q FROM rates WHERE re = 'E')), printf('%.1f%%', 100.0 * (SELECT q FROM rates WHERE re = 'N')), 'NA', 'NA']) AS value FROM reads)""",
       "rates AS (SELECT re, avg(CASE WHEN phred >= 30 THEN 1.0 ELSE 0.0 END) AS q FROM reads GROUP BY 1)")
def _(v):
    name = F.when(F.col("re") == "E", "BC").when(F.col("re") == "N", "UMI").otherwise("R1")
    quality = v("reads").groupBy(name.alias("metric")).agg(F.count(F.lit(1)).alias("total_bases"), F.count(F.when(F.col("phred") >= 30, 1)).alias("q30_bases"))
    quality = quality.withColumn("q30_rate", E.ratio(F.col("q30_bases"), F.col("total_bases")))
    return P.sequencing_quality(P.read_counts(Q.read_stats(categorised(v)), Q.CATEGORIES), quality).select("no", "metric", "value")


@query("r09_distributions", """SELECT k.ftype, [quantile_cont(coalesce(s.genes, 0), 0.25), quantile_cont(coalesce(s.genes, 0), 0.5), quantile_cont(coalesce(s.genes, 0), 0.75)] AS genes,
    [quantile_cont(coalesce(s.total, 0), 0.25), quantile_cont(coalesce(s.total, 0), 0.5), quantile_cont(coalesce(s.total, 0), 0.75)] AS umis FROM (SELECT unnest(['exon', 'intron', 'inex']) AS ftype) k CROSS JOIN wells w LEFT JOIN summary s ON s.well = w.well AND s.ftype = k.ftype GROUP BY 1""", ELIGIBLE, MATRIX, SUMMARY)
def _(v):
    return P.distributions(X.cell_summary(X.read_matrix(eligible(v))), v("wells"))


@query("r12_series", "SELECT p, round(n * 100.0, 6) AS n, round(last(n ORDER BY p) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) * 100.0, 6) AS headline_n FROM (SELECT phred AS p, count(*) / 1000.0 AS n FROM reads GROUP BY 1)")
def _(v):
    rows = v("reads").groupBy(F.col("phred").alias("p")).agg((F.count(F.lit(1)) / 1000.0).alias("n"))
    return rounded(P.series(rows, "p", {"n": 100.0}), "n", "headline_n")


@query("p33_formats", """SELECT well, format('{:,}', n) AS whole, printf('%.1f%%', n / 1000.0 * 100) AS pct FROM (SELECT well, count(*) AS n FROM reads GROUP BY 1)""")
def _(v):
    rows = v("reads").groupBy("well").agg(F.count(F.lit(1)).alias("n"))
    return rows.select("well", P.shown(F.col("n"), "int").alias("whole"), P.shown(F.col("n") / 1000.0, "pct").alias("pct"))


# Sets


@query("u01_concatenated", "SELECT qname, 0 AS part FROM reads WHERE source = 'Internal' UNION ALL SELECT qname, 1 FROM reads WHERE source = 'UMI'")
def _(v):
    part = lambda s, i: v("reads").where(F.col("source") == s).select("qname", F.lit(i).alias("part"))
    return part("Internal", 0).unionByName(part("UMI", 1))


@query("u03_common_transcripts", """SELECT gene, list_sort(list(tx)) AS common FROM (SELECT gene, tx FROM exons GROUP BY 1, 2 HAVING count(DISTINCT "start") >= 2) GROUP BY 1""")
def _(v):
    per = v("exons").groupBy("gene").agg(F.collect_set("tx").alias("every"))
    many = v("exons").groupBy("gene", "tx").agg(F.count_distinct("start").alias("k")).where("k >= 2").groupBy("gene").agg(F.collect_set("tx").alias("own"))
    return per.join(many, "gene").select("gene", F.sort_array(F.array_intersect("every", "own")).alias("common"))


@query("u04_missing_genes", "SELECT gene FROM (SELECT DISTINCT 'G' || lpad(cast(cast(substr(gene, 2) as int) + 25 as string), 3, '0') AS gene FROM reads) WHERE gene NOT IN (SELECT gene FROM genes)")
def _(v):
    moved = v("reads").select(F.concat(F.lit("G"), F.lpad((F.substring("gene", 2, 3).cast("int") + 25).cast("string"), 3, "0")).alias("gene")).distinct()
    return moved.join(v("genes"), "gene", "left_anti")


@query("u05_ordered_unique", """SELECT well, list(umi ORDER BY first) AS umis FROM (SELECT well, umi, min(qname) AS first FROM reads WHERE phred = 7 GROUP BY 1, 2) GROUP BY 1""")
def _(v):
    rows = v("reads").where("phred = 7").groupBy("well").agg(F.sort_array(F.collect_list(F.struct("qname", "umi"))).alias("l"))
    return rows.select("well", F.array_distinct(F.transform("l", lambda x: x["umi"])).alias("umis"))


@query("a05_select_knee_listed", """SELECT "XC", n, keep AND "XC" IN (SELECT barcode FROM whitelist) AS keep FROM (SELECT "XC", n, n >= (SELECT cutoff FROM cut3) OR ((SELECT count(*) FROM observed WHERE n >= (SELECT cutoff FROM cut3)) < 10 AND rk <= 100) AS keep FROM ranked3)""",
       """ranked3 AS (SELECT *, row_number() OVER (ORDER BY n DESC, "XC") AS rk FROM observed), lim3 AS (SELECT max(rk) AS x1, log10(max(n)) AS y0, log10(min(n)) AS y1 FROM ranked3),
       cut3 AS (SELECT n AS cutoff FROM ranked3, lim3 ORDER BY round(abs((y1 - y0) * (rk - 1) - (x1 - 1) * (log10(n) - y0)), 9) DESC, rk LIMIT 1)""")
def _(v):
    from ..operators import barcodes as B

    return B.select_knee_listed(v("observed"), v("whitelist"), 1).select("XC", "n", "keep")
