"""One query per operator, each with independent SQL; doubles are rounded to 6 places on both sides."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import exprs as E
from ..operators import assign as A
from ..operators import barcodes as B
from ..operators import expression as X
from ..operators import intervals as I
from ..operators import isoform as M
from ..operators import qc as Q
from .views import view, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str, *ctes: str):
    """Register what takes ``v``, a function from a view's name to its DataFrame."""

    def add(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(lambda n: view(spark, sf_dir, n))
        ORACLE[name] = with_views(sql, *ctes)
        return fn

    return add


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in cols})


REP = "((flag & 2304) = 0 AND ((flag & 1) = 0 OR (flag & 64) <> 0))"
ELIGIBLE = f"eligible AS (SELECT * FROM reads WHERE re IN ('E', 'N') AND {REP} AND (flag & 4) = 0 AND well IN (SELECT well FROM wells) AND gene IN (SELECT gene FROM genes))"
FTYPE = "CASE WHEN re = 'N' THEN 'intron' ELSE 'exon' END"
MATRIX = f"matrix AS (SELECT well, gene, {FTYPE} AS ftype, count(*) AS n FROM eligible GROUP BY 1, 2, 3)"
UMIS = f"umis AS (SELECT well, gene, {FTYPE} AS ftype, umi, count(*) AS n FROM eligible GROUP BY 1, 2, 3, 4)"
POOL = "pool AS (SELECT well, gene, umi, sum(n) AS n, row_number() OVER (PARTITION BY well, gene ORDER BY sum(n) DESC, umi) AS rk FROM umis GROUP BY 1, 2, 3)"
FOLD = """fold AS (SELECT well, gene, rk, [umi] AS cs FROM pool WHERE rk = 1 UNION ALL
    SELECT p.well, p.gene, p.rk, CASE WHEN len(list_filter(f.cs, lambda k: hamming(k, p.umi) <= 1)) > 0 THEN f.cs ELSE list_append(f.cs, p.umi) END
    FROM fold f JOIN pool p ON p.well = f.well AND p.gene = f.gene AND p.rk = f.rk + 1)"""
PARENTS = """centres AS (SELECT well, gene, arg_max(cs, rk) AS cs FROM fold GROUP BY 1, 2),
    parents AS (SELECT p.well, p.gene, p.umi, list_filter(c.cs, lambda k: hamming(k, p.umi) <= 1)[1] AS parent FROM pool p JOIN centres c ON p.well = c.well AND p.gene = c.gene)"""
CLUSTERED = (ELIGIBLE, UMIS, POOL, FOLD, PARENTS)


def eligible(v) -> DataFrame:
    return X.eligible(v("reads"), v("wells"), v("genes"))


# Matrices and UMIs


@query("a13_read_matrix", "SELECT well, gene, ftype, n FROM matrix", ELIGIBLE, MATRIX)
def _(v):
    return X.read_matrix(eligible(v))


@query("a19_inex_matrix", "SELECT * FROM matrix UNION ALL SELECT well, gene, 'inex', cast(sum(n) as bigint) FROM matrix GROUP BY 1, 2", ELIGIBLE, MATRIX)
def _(v):
    return X.both_types(X.read_matrix(eligible(v)))


@query("a14_umi_counts", "SELECT * FROM umis", ELIGIBLE, UMIS)
def _(v):
    return X.umi_counts(eligible(v))


@query("a15_global_umis", f"SELECT well, umi, count(*) AS n FROM reads WHERE {REP} AND (flag & 4) = 0 AND well IN (SELECT well FROM wells) GROUP BY 1, 2")
def _(v):
    rows = v("reads").where(E.is_representative(F.col("flag")) & E.is_mapped(F.col("flag"))).join(v("wells"), "well", "left_semi")
    return rows.groupBy("well", "umi").agg(F.count(F.lit(1)).alias("n"))


@query("g01_umi_parents", "SELECT * FROM parents", *CLUSTERED)
def _(v):
    return X.cluster(X.umi_counts(eligible(v)), ["well", "gene"])


@query("a16_umi_matrix", """SELECT well, gene, ftype, count(DISTINCT parent) AS n FROM umis JOIN parents USING (well, gene, umi) GROUP BY 1, 2, 3
    UNION ALL SELECT well, gene, 'inex', count(DISTINCT parent) FROM parents GROUP BY 1, 2""", *CLUSTERED)
def _(v):
    return X.umi_matrix(X.clustered(X.umi_types(eligible(v)), ["well", "gene"]))


@query("a17_umi_frequency", "SELECT reads, count(*) AS freq FROM (SELECT cast(sum(n) as bigint) AS reads FROM umis JOIN parents USING (well, gene, umi) GROUP BY well, gene, parent) GROUP BY 1", *CLUSTERED)
def _(v):
    return X.frequency(X.clustered(X.umi_types(eligible(v)), ["well", "gene"]), ["well", "gene"])


_LIB = [c.replace(", gene", "").replace("p.gene, ", "").replace("AND p.gene = f.gene ", "").replace(" AND p.gene = c.gene", "").replace("GROUP BY 1, 2)", "GROUP BY 1)") for c in (FOLD, PARENTS)]


@query(
    "a18_library_frequency", "SELECT reads, count(*) AS freq FROM (SELECT cast(sum(n) as bigint) AS reads FROM pool JOIN parents USING (well, umi) GROUP BY well, parent) GROUP BY 1",
    "pool AS (SELECT well, umi, count(*) AS n, row_number() OVER (PARTITION BY well ORDER BY count(*) DESC, umi) AS rk FROM reads GROUP BY 1, 2)", *_LIB,
)
def _(v):
    counts = v("reads").groupBy("well", "umi").agg(F.count(F.lit(1)).alias("n"))
    return X.frequency(X.clustered(counts, ["well"]), ["well"])


@query("a37_corrections", "SELECT count(*) AS corrected FROM parents WHERE umi <> parent", *CLUSTERED)
def _(v):
    return X.cluster(X.umi_counts(eligible(v)), ["well", "gene"]).where("umi <> parent").agg(F.count(F.lit(1)).alias("corrected"))


@query("p23_corrected_reads", """SELECT r.qname, r.well, r.gene, r.umi, CASE WHEN k.gene IS NOT NULL THEN coalesce(p.parent, r.umi) END AS ub FROM reads r
    LEFT JOIN parents p ON r.well = p.well AND r.gene = p.gene AND r.umi = p.umi LEFT JOIN (SELECT DISTINCT well, gene FROM parents) k ON r.well = k.well AND r.gene = k.gene""", *CLUSTERED)
def _(v):
    return X.corrected(v("reads"), X.cluster(X.umi_counts(eligible(v)), ["well", "gene"])).select("qname", "well", "gene", "umi", "ub")


SUMMARY = """summary AS (SELECT well, ftype, cast(sum(n) as bigint) AS total, count(DISTINCT gene) AS genes FROM matrix GROUP BY 1, 2
    UNION ALL SELECT well, 'inex', cast(sum(n) as bigint), count(DISTINCT gene) FROM matrix GROUP BY 1)"""


@query("a20_cell_summary", "SELECT * FROM summary", ELIGIBLE, MATRIX, SUMMARY)
def _(v):
    return X.cell_summary(X.read_matrix(eligible(v)))


HIST = "hist AS (SELECT n AS reads, count(*) AS freq FROM umis GROUP BY 1)"
FRACTIONS = f"fractions AS (SELECT unnest([{', '.join(map(str, X.FRACTIONS))}]::DOUBLE[]) AS p)"


@query("a22_saturation", "SELECT p, round(CASE WHEN p = 0 THEN 0 ELSE 1 - sum(freq * (1 - pow(1 - p, reads))) / (p * sum(freq * reads)) END, 6) AS saturation FROM hist, fractions GROUP BY p", ELIGIBLE, UMIS, HIST, FRACTIONS)
def _(v):
    hist = X.umi_counts(eligible(v)).groupBy(F.col("n").alias("reads")).agg(F.count(F.lit(1)).alias("freq"))
    return rounded(X.saturation(hist), "saturation")


@query("a23_median_genes", "SELECT p, round(median(g), 6) AS median_genes FROM (SELECT p, well, round(sum(1 - pow(1 - p, n)), 9) AS g FROM matrix, fractions GROUP BY 1, 2) GROUP BY p", ELIGIBLE, MATRIX, FRACTIONS)
def _(v):
    return rounded(X.median_genes(X.read_matrix(eligible(v))), "median_genes")


@query("p39_normalised", """SELECT s.gene, s.sample, round(s.n / f.f, 6) AS norm FROM samples s JOIN f USING (sample)""",
       "g AS (SELECT gene, avg(ln(n)) AS m FROM samples GROUP BY 1 HAVING count(*) = (SELECT count(DISTINCT sample) FROM samples))", "f AS (SELECT sample, exp(median(ln(n) - m)) AS f FROM samples JOIN g USING (gene) GROUP BY 1)")
def _(v):
    return rounded(X.normalise(v("samples")), "norm")


@query("a36_fold_changes", """SELECT gene, round(a, 6) AS mean_first, round(b, 6) AS mean_second, round(log2((b + 0.5) / (a + 0.5)), 6) AS log2fc FROM
    (SELECT gene, avg(CASE WHEN grp = 'a' THEN n / f END) AS a, avg(CASE WHEN grp = 'b' THEN n / f END) AS b FROM samples JOIN f USING (sample) JOIN groups USING (sample) GROUP BY 1)""",
       "g AS (SELECT gene, avg(ln(n)) AS m FROM samples GROUP BY 1 HAVING count(*) = (SELECT count(DISTINCT sample) FROM samples))", "f AS (SELECT sample, exp(median(ln(n) - m)) AS f FROM samples JOIN g USING (gene) GROUP BY 1)")
def _(v):
    return rounded(X.fold_changes(X.normalise(v("samples")), v("groups"), "a", "b"), "mean_first", "mean_second", "log2fc")


@query("a35_gene_filter", "SELECT gene, cast(sum(n) as bigint) AS total FROM samples GROUP BY 1 HAVING sum(n) >= 1200")
def _(v):
    return v("samples").groupBy("gene").agg(F.sum("n").cast("long").alias("total")).where("total >= 1200")


# Barcodes


@query("a01_barcode_counts", 'SELECT bc AS "XC", count(*) AS n FROM reads WHERE phred >= 5 GROUP BY 1')
def _(v):
    return B.counts(v("reads"), "bc", F.col("phred") >= 5)


def _q30(c: str) -> str:
    return f"length({c}) AS t, len(regexp_replace({c}, '[!->]', '', 'g')) AS q"


@query("a02_q30_totals", f"""SELECT metric, cast(sum(t) as bigint) AS total_bases, cast(sum(q) as bigint) AS q30_bases, round(sum(q) / sum(t), 6) AS rate FROM
    (SELECT 'R1' AS metric, {_q30("replace(q1, ' ', '!')")} FROM quals UNION ALL SELECT 'BC', {_q30("replace(q2, ' ', '!')")} FROM quals) GROUP BY 1""")
def _(v):
    rows = v("quals").select(F.translate("q1", " ", "!").alias("q1"), F.translate("q2", " ", "!").alias("q2"))
    return rounded(B.quality_totals(rows, {"R1": "q1", "BC": "q2"}), "rate")


@query("p05_quality_filter", "SELECT doc_id FROM quals WHERE len(regexp_replace(q2, '[5-~ ]', '', 'g')) < 3")
def _(v):
    return v("quals").where(B.passes_quality(F.col("q2"), 20, 3)).select("doc_id")


@query("p02_slices", "SELECT doc_id, substr(q1, 1, 4) || substr(q1, 9, 2) AS bc, substr(q1, 5, 4) AS umi, substr(q1, 11, 10) AS cdna FROM quals")
def _(v):
    q = F.col("q1")
    return v("quals").select("doc_id", E.slices(q, [(0, 4), (8, 10)]).alias("bc"), E.slices(q, [(4, 8)]).alias("umi"), E.slices(q, [(10, 20)]).alias("cdna"))


@query("p03_hamming", "SELECT umi, bc, hamming(umi, bc) AS d FROM reads GROUP BY 1, 2, 3")
def _(v):
    return v("reads").select("umi", "bc").distinct().withColumn("d", E.hamming(F.col("umi"), F.col("bc")).cast("long"))


@query("p29_natural_order", "SELECT well, row_number() OVER (ORDER BY substr(well, 1, 3), cast(substr(well, 4) as int)) AS place FROM wells")
def _(v):
    return v("wells").select("well", F.row_number().over(Window.orderBy(E.natural_key(F.col("well")))).cast("long").alias("place"))


@query("p14_representatives", f"SELECT flag, count(*) AS n FROM reads WHERE {REP} GROUP BY 1")
def _(v):
    return v("reads").where(E.is_representative(F.col("flag"))).groupBy("flag").agg(F.count(F.lit(1)).alias("n"))


KEEP = "SELECT \"XC\", n, rk <= 40 AS keep, rk AS rank FROM (SELECT *, row_number() OVER (ORDER BY n DESC, \"XC\") AS rk FROM observed WHERE n >= 2)"


@query("a05_select_top", KEEP)
def _(v):
    return B.select_top(v("observed"), 40, 2).withColumn("rank", F.col("rank").cast("long"))


KNEE = ("pts AS (SELECT n, row_number() OVER (ORDER BY n DESC, \"XC\") AS r FROM observed)", """lim AS (SELECT max(r) AS x1, log10(max(n)) AS y0, log10(min(n)) AS y1 FROM pts)""")
CUT = "SELECT arg_max(n, struct_pack(d := round(abs((y1 - y0) * (r - 1) - (x1 - 1) * (log10(n) - y0)), 9), r := -r)) AS cutoff FROM pts, lim"


@query("a06_knee", CUT, *KNEE)
def _(v):
    return B.knee(v("observed"))


@query("a05_select_knee", f"""SELECT "XC", n, r AS rank, (n >= cutoff OR ((SELECT count(*) FROM observed o2, cut WHERE o2.n >= cutoff) < 10 AND r <= 100)) AS keep
    FROM (SELECT *, row_number() OVER (ORDER BY n DESC, "XC") AS r FROM observed), cut""", *KNEE, f"cut AS ({CUT})")
def _(v):
    return B.select_knee(v("observed"), 1).withColumn("rank", F.col("rank").cast("long"))


@query("j02_select_listed", 'SELECT * FROM observed WHERE "XC" IN (SELECT barcode FROM whitelist) AND n >= 2')
def _(v):
    return B.select_listed(v("observed"), v("whitelist"), 2)


@query("j03_unlisted_top", 'SELECT * FROM observed WHERE "XC" NOT IN (SELECT barcode FROM whitelist) ORDER BY n DESC, "XC" LIMIT 100')
def _(v):
    return B.unlisted(v("observed"), v("whitelist"))


NEAR = """SELECT w.barcode AS "trueBC", o."XC" AS "falseBC", cast(hamming(w.barcode, o."XC") as int) AS hamming FROM whitelist w, observed o"""


@query("j07_hamming1_join", f"SELECT * FROM ({NEAR}) WHERE hamming = 0 OR (hamming = 1 AND \"falseBC\" NOT IN (SELECT barcode FROM whitelist))")
def _(v):
    return B.near_matches(v("whitelist"), v("observed").withColumnRenamed("XC", "barcode"))


@query("j08_hamming2_nearest", f"""SELECT "trueBC", "falseBC", hamming FROM (SELECT *, rank() OVER (PARTITION BY "falseBC" ORDER BY hamming) AS r FROM ({NEAR}) WHERE hamming <= 2) WHERE r = 1""")
def _(v):
    return B.near_matches(v("whitelist"), v("observed").withColumnRenamed("XC", "barcode"), 2)


BINS = f"""bins AS (SELECT "trueBC", "falseBC", hamming FROM (SELECT *, count(*) OVER (PARTITION BY "falseBC") AS k FROM ({NEAR}) WHERE hamming = 1 AND "falseBC" NOT IN (SELECT barcode FROM whitelist)) WHERE k = 1)"""


@query("a07_binning", "SELECT * FROM bins", BINS)
def _(v):
    return B.binning(v("whitelist"), v("observed").withColumnRenamed("XC", "barcode"))


@query("a07_add_back", """SELECT o."XC", cast(o.n + coalesce((SELECT sum(x.n) FROM bins b JOIN observed x ON x."XC" = b."falseBC" WHERE b."trueBC" = o."XC"), 0) as bigint) AS n FROM observed o WHERE "XC" IN (SELECT barcode FROM whitelist)""", BINS)
def _(v):
    bc = v("observed")
    return B.add_back(B.select_listed(bc, v("whitelist"), 1), B.binning(v("whitelist"), bc.withColumnRenamed("XC", "barcode")), bc)


@query("a08_by_well", """SELECT "wellID", cast(coalesce(sum(CASE WHEN kind = 'umi' THEN n END), 0) as bigint) AS umi_reads, cast(coalesce(sum(CASE WHEN kind = 'internal' THEN n END), 0) as bigint) AS internal_reads,
    cast(coalesce(sum(n), 0) as bigint) AS total_reads FROM expected LEFT JOIN observed ON "XC" = barcode GROUP BY 1""")
def _(v):
    return B.by_well(v("expected"), v("observed"))


MATCHES = """met AS (SELECT o."XC", o.n, c.*, cast(hamming(c.barcode, o."XC") as int) AS hamming FROM observed o, candidates c WHERE hamming(c.barcode, o."XC") <= 1),
    matches AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "XC", candidate_type, candidate_id ORDER BY hamming, "wellID", barcode_type, barcode) AS r FROM met
    WHERE hamming = 0 OR "XC" NOT IN (SELECT barcode FROM candidates)) WHERE r = 1)"""
DISCOVERED = """found AS (SELECT candidate_type, candidate_id, cast(sum(n) as bigint) AS reads, cast(coalesce(sum(CASE WHEN hamming = 0 THEN n END), 0) as bigint) AS exact_reads,
    cast(coalesce(sum(CASE WHEN hamming = 1 THEN n END), 0) as bigint) AS hamming1_reads, count(DISTINCT "XC") AS observed, count(DISTINCT barcode) AS expected FROM matches GROUP BY 1, 2)"""


@query("j13_discovery_matches", 'SELECT "XC", n, candidate_type, candidate_id, "wellID", barcode, barcode_type, hamming FROM matches', MATCHES)
def _(v):
    return B.discovery_matches(v("observed"), v("candidates"))


@query("a09_discovery_summary", "SELECT * FROM found", MATCHES, DISCOVERED)
def _(v):
    return B.discovery_summary(B.discovery_matches(v("observed"), v("candidates")))


@query("a10_discovery_selection", """SELECT f.* FROM found f, (SELECT candidate_type AS bt, reads AS br FROM found ORDER BY reads DESC, expected DESC, CASE candidate_type WHEN 'manual' THEN 1 ELSE 2 END LIMIT 1)
    WHERE candidate_type = bt AND expected >= 2 AND reads >= greatest(1, floor(br * 0.2))""", MATCHES, DISCOVERED)
def _(v):
    return B.discovery_selection(B.discovery_summary(B.discovery_matches(v("observed"), v("candidates"))))


DICT = "dict AS (SELECT barcode, min(\"wellID\") AS \"wellID\", min(kind) AS kind FROM expected GROUP BY 1)"


def corrected_reads(v) -> DataFrame:
    rows = v("reads").select("qname", F.lit(77).alias("flag"), F.col("bc").alias("CR"), F.col("umi").alias("UR"), F.col("umi").alias("UY"), F.col("well").alias("seq"), F.col("gene").alias("qual")).distinct()
    own = v("expected").groupBy("barcode").agg(F.min("wellID").alias("wellID"), F.min("kind").alias("kind"))
    bins = B.binning(own.select("barcode"), rows.select(F.col("CR").alias("barcode")))
    return B.correct(rows, bins, own)


CORRECTED = (DICT, """obs AS (SELECT DISTINCT qname, bc AS cr, umi, well AS seq, gene AS qual FROM reads)""",
             """near AS (SELECT o.cr, min(d.barcode) AS t FROM (SELECT DISTINCT cr FROM obs) o JOIN dict d ON hamming(o.cr, d.barcode) = 1 WHERE o.cr NOT IN (SELECT barcode FROM dict) GROUP BY 1 HAVING count(*) = 1)""",
             """fixed AS (SELECT o.*, d.barcode AS cc, d."wellID" AS cb, coalesce(d.kind = 'internal', false) AS inner_read FROM obs o LEFT JOIN near n ON o.cr = n.cr LEFT JOIN dict d ON d.barcode = coalesce(n.t, o.cr))""")


@query("p09_correct_reads", 'SELECT qname, cr AS "CR", cc AS "CC", cb AS "CB", inner_read AS is_internal FROM fixed', *CORRECTED)
def _(v):
    return corrected_reads(v).select("qname", "CR", "CC", "CB", "is_internal")


@query("p10_adjust_reads", """SELECT qname, cr AS "CR", CASE WHEN inner_read THEN umi || seq WHEN length(seq) > 3 THEN substr(seq, 4) ELSE seq END AS seq,
    CASE WHEN inner_read THEN umi || qual WHEN length(seq) > 3 THEN substr(qual, 4) ELSE qual END AS qual, CASE WHEN NOT inner_read THEN umi END AS "UR" FROM fixed""", *CORRECTED)
def _(v):
    return B.adjust(corrected_reads(v)).select("qname", "CR", "seq", "qual", "UR")


# Intervals and assignment


@query("i01_merge", """SELECT chrom, strand, min("start") AS "start", max("end") AS "end" FROM (SELECT *, sum(new) OVER (PARTITION BY chrom, strand ORDER BY "start", "end" ROWS UNBOUNDED PRECEDING) AS isl FROM
    (SELECT *, CASE WHEN "start" > coalesce(max("end") OVER (PARTITION BY chrom, strand ORDER BY "start", "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -9) + 1 THEN 1 ELSE 0 END AS new FROM exons)) GROUP BY chrom, strand, isl""")
def _(v):
    return I.merge(v("exons").select("chrom", "strand", "start", "end"), ["chrom", "strand"])


COVERED = """bases AS (SELECT DISTINCT chrom, strand, gene, unnest(generate_series("start", "end")) AS posn FROM exons)"""
LOCI = """loci AS (SELECT chrom, strand, posn, row_number() OVER (PARTITION BY chrom, strand ORDER BY posn) AS r FROM (SELECT DISTINCT chrom, strand, posn FROM bases))"""


@query("i04_gaps", """SELECT chrom, strand, p + 1 AS "start", posn - 1 AS "end" FROM (SELECT chrom, strand, posn, lag(posn) OVER (PARTITION BY chrom, strand ORDER BY posn) AS p FROM loci) WHERE posn > p + 1""", COVERED, LOCI)
def _(v):
    return I.gaps(I.merge(v("exons"), ["chrom", "strand"]), ["chrom", "strand"])


BODIES = """body AS (SELECT chrom, strand, gene, unnest(generate_series(min("start"), max("end"))) AS posn FROM exons GROUP BY 1, 2, 3),
    alone AS (SELECT chrom, strand, posn, min(gene) AS gene FROM body GROUP BY 1, 2, 3 HAVING count(*) = 1)"""


@query("i06_single_cover", """SELECT chrom, strand, gene, cast(count(*) as bigint) AS bases FROM alone GROUP BY 1, 2, 3""", BODIES)
def _(v):
    key = ["chrom", "strand"]
    body = v("exons").groupBy(*key, "gene").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    body = body.withColumn("no", F.row_number().over(Window.partitionBy(*key).orderBy("gene")))
    met = I.single_cover(body, key, "no").join(body.select(*key, "no", "gene"), [*key, "no"])
    return met.groupBy(*key, "gene").agg(F.sum(F.col("end") - F.col("start") + 1).cast("long").alias("bases"))


INTRONS = ("""holes AS (SELECT a.chrom, a.strand, a.gene, a.posn, a.posn - row_number() OVER (PARTITION BY a.chrom, a.strand, a.gene ORDER BY a.posn) AS isl FROM alone a
    WHERE NOT EXISTS (SELECT 1 FROM loci l WHERE l.chrom = a.chrom AND l.strand = a.strand AND l.posn = a.posn)
    AND a.posn < (SELECT max(posn) FROM loci l WHERE l.chrom = a.chrom AND l.strand = a.strand)),
    introns AS (SELECT chrom, strand, gene, min(posn) AS "start", max(posn) AS "end" FROM holes GROUP BY chrom, strand, gene, isl HAVING count(*) > 10 AND count(*) < 100000)""",)


@query("i07_introns", "SELECT * FROM introns", COVERED, LOCI, BODIES, *INTRONS)
def _(v):
    return A.introns(v("exons"))


@query("i10_segments", """SELECT gene, members, cast(count(*) as bigint) AS bases FROM (SELECT gene, posn, list_sort(list(DISTINCT tx)) AS members FROM (SELECT gene, tx, unnest(generate_series("start", "end")) AS posn FROM exons) GROUP BY 1, 2) GROUP BY 1, 2""")
def _(v):
    seg = I.segments(v("exons").select("gene", "tx", "start", "end"), ["gene"], "tx")
    return seg.groupBy("gene", "members").agg(F.sum(F.col("end") - F.col("start") + 1).cast("long").alias("bases"))


def blocks(v) -> DataFrame:
    return v("reads").select("qname", "chrom", "strand", "b_start", "b_end", "source").distinct()


def exon_union(v) -> DataFrame:
    return I.merge(v("exons"), ["chrom", "strand", "gene"])


OVERLAP = """blk AS (SELECT DISTINCT qname, chrom, strand, b_start, b_end, source FROM reads),
    ex AS (SELECT chrom, strand, gene, min(posn) AS s, max(posn) AS e FROM (SELECT *, posn - row_number() OVER (PARTITION BY chrom, strand, gene ORDER BY posn) AS isl FROM bases) GROUP BY chrom, strand, gene, isl),
    ov AS (SELECT qname, gene, cast(sum(least(b_end, e) - greatest(b_start, s) + 1) as bigint) AS overlap FROM blk JOIN ex ON blk.chrom = ex.chrom AND b_start <= e AND s <= b_end GROUP BY 1, 2),
    top AS (SELECT *, count(*) OVER (PARTITION BY qname) AS ties FROM (SELECT *, rank() OVER (PARTITION BY qname ORDER BY overlap DESC) AS r FROM ov) WHERE r = 1)"""


@query("j09_exon_overlap", "SELECT qname, gene, overlap, ties FROM top", COVERED, OVERLAP)
def _(v):
    return A.best_gene(blocks(v), exon_union(v))


@query("j11_assignment", """SELECT q.qname, coalesce(CASE WHEN e.ties = 1 THEN e.g END, CASE WHEN i.ties = 1 THEN i.g END) AS gene,
    CASE WHEN coalesce(e.ties, i.ties) > 1 THEN 'Ambiguity' WHEN e.ties = 1 THEN 'Exon' WHEN i.ties = 1 THEN 'Intron' ELSE 'Intergenic' END AS category
    FROM (SELECT DISTINCT qname FROM blk) q LEFT JOIN (SELECT qname, max(gene) AS g, max(ties) AS ties FROM top GROUP BY 1) e ON q.qname = e.qname
    LEFT JOIN (SELECT qname, max(gene) AS g, max(ties) AS ties FROM itop GROUP BY 1) i ON q.qname = i.qname""",
       COVERED, LOCI, BODIES, *INTRONS, OVERLAP, """iov AS (SELECT qname, gene, sum(least(b_end, i."end") - greatest(b_start, i."start") + 1) AS overlap FROM blk JOIN introns i ON blk.chrom = i.chrom AND b_start <= i."end" AND i."start" <= b_end
    WHERE qname NOT IN (SELECT qname FROM top) GROUP BY 1, 2), itop AS (SELECT *, count(*) OVER (PARTITION BY qname) AS ties FROM (SELECT *, rank() OVER (PARTITION BY qname ORDER BY overlap DESC) AS r FROM iov) WHERE r = 1)""")
def _(v):
    return A.assign(blocks(v), exon_union(v), A.introns(v("exons")))


MODELS = """txb AS (SELECT DISTINCT chrom, strand, gene, tx, unnest(generate_series("start", "end")) AS posn FROM exons),
    size AS (SELECT gene, tx, count(*) AS length FROM txb GROUP BY 1, 2 HAVING count(*) >= 100),
    best AS (SELECT gene, arg_max(tx, struct_pack(l := length, t := tx)) AS tx, max(length) AS length FROM size GROUP BY 1)"""


@query("i09_gene_models", "SELECT gene, tx, cast(length as bigint) AS length FROM best", MODELS)
def _(v):
    return A.gene_models(v("exons")).select("gene", "tx", "length").distinct()


@query("j14_extension", """SELECT chrom, strand, "start", "end", cast(CASE WHEN gap IS NULL OR gap > 110 THEN 100 WHEN gap <= 10 THEN 0 ELSE gap - 10 END as bigint) AS extension FROM
    (SELECT *, CASE WHEN strand = '-' THEN "start" - lag("end") OVER w - 1 ELSE lead("start") OVER w - "end" - 1 END AS gap FROM
    (SELECT chrom, strand, min(posn) AS "start", max(posn) AS "end" FROM (SELECT *, posn - r AS isl FROM loci) GROUP BY chrom, strand, isl) WINDOW w AS (PARTITION BY chrom, strand ORDER BY "start"))""", COVERED, LOCI)
def _(v):
    return A.nearest_exon(v("exons")).select("chrom", "strand", "start", "end", A.extension(F.col("gap")).cast("long").alias("extension"))


@query("w03_unique_best", "SELECT qname, min(gene) AS gene FROM top WHERE ties = 1 GROUP BY 1", COVERED, OVERLAP)
def _(v):
    return A.best_gene(blocks(v), exon_union(v)).where("ties = 1").select("qname", "gene")


# Molecules


MOLECULE = "mol AS (SELECT well || gene || umi AS molecule, cast(b_start % 20 as bigint) AS pos, substr(bc, 1, 1) AS base, phred AS qual FROM reads WHERE re = 'E')"


@query("a30_consensus", """SELECT molecule, pos, CASE WHEN p <= 0.3 THEN 'N' ELSE b END AS base, cast(greatest(0, least(93, round(-10 * log10(1 - p + 1e-13)))) as int) AS qual FROM (SELECT *, 1 / (exp(a - m) + exp(t - m) + exp(c - m) + exp(g - m)) AS p, CASE WHEN a = m THEN 'A' WHEN t = m THEN 'T' WHEN c = m THEN 'C' ELSE 'G' END AS b FROM
    (SELECT *, greatest(a, t, c, g) AS m FROM (SELECT molecule, pos, round(sum(CASE WHEN base = 'A' THEN ln(1 - e) ELSE ln(e / 3) END), 9) AS a, round(sum(CASE WHEN base = 'T' THEN ln(1 - e) ELSE ln(e / 3) END), 9) AS t,
    round(sum(CASE WHEN base = 'C' THEN ln(1 - e) ELSE ln(e / 3) END), 9) AS c, round(sum(CASE WHEN base = 'G' THEN ln(1 - e) ELSE ln(e / 3) END), 9) AS g
    FROM (SELECT *, pow(10, -least(greatest(qual, 1), 93) / 10.0) AS e FROM mol) GROUP BY 1, 2)))""", MOLECULE)
def _(v):
    rows = v("reads").where("re = 'E'").select(F.concat("well", "gene", "umi").alias("molecule"), (F.col("b_start") % 20).alias("pos"), F.substring("bc", 1, 1).alias("base"), F.col("phred").alias("qual"))
    return M.consensus(rows)


@query("a31_molecules", """SELECT well, gene, umi, count(DISTINCT qname) AS reads, count(DISTINCT CASE WHEN re = 'E' THEN qname END) AS exonic, count(DISTINCT CASE WHEN re = 'N' THEN qname END) AS intronic,
    CASE WHEN 2 * count(CASE WHEN strand = '+' THEN 1 END) > count(*) THEN '+' ELSE '-' END AS strand FROM reads GROUP BY 1, 2, 3""")
def _(v):
    return M.molecules(v("reads"))


SEGMENTS = """txp AS (SELECT DISTINCT gene, tx, unnest(generate_series("start", "end")) AS posn FROM exons),
    entry AS (SELECT gene, posn, list_sort(list(tx)) AS members FROM txp GROUP BY 1, 2),
    molb AS (SELECT DISTINCT well, gene, umi, well || '-' || gene || '-' || umi AS molecule, unnest(generate_series(b_start, b_end)) AS posn FROM reads),
    hit AS (SELECT molecule, gene, members, count(*) AS o FROM molb JOIN entry USING (gene, posn) GROUP BY 1, 2, 3 HAVING count(*) >= 5)"""
COMPATIBLE = """perm AS (SELECT molecule, count(*) AS k FROM hit GROUP BY 1), each AS (SELECT molecule, tx, count(*) AS k FROM (SELECT molecule, unnest(members) AS tx FROM hit) GROUP BY 1, 2),
    sets AS (SELECT e.molecule, list_sort(list(e.tx)) AS transcripts FROM each e JOIN perm p ON e.molecule = p.molecule AND e.k = p.k GROUP BY 1)"""


def covered(v) -> DataFrame:
    """(molecule, gene, b_start, b_end): what each molecule's reads cover."""
    rows = v("reads").select(F.concat_ws("-", "well", "gene", "umi").alias("molecule"), "gene", F.col("b_start").alias("start"), F.col("b_end").alias("end"))
    return I.merge(rows, ["molecule", "gene"]).withColumnsRenamed({"start": "b_start", "end": "b_end"})


def segments(v) -> DataFrame:
    return I.segments(v("exons").select("gene", "tx", "start", "end"), ["gene"], "tx")


@query("j19_compatible", "SELECT p.molecule, s.transcripts FROM perm p LEFT JOIN sets s ON p.molecule = s.molecule", SEGMENTS, COMPATIBLE)
def _(v):
    return M.compatible(covered(v), segments(v))


@query("a32_isoform_counts", """SELECT split_part(molecule, '-', 1) AS well, tx, count(CASE WHEN k = 1 THEN 1 END) AS unique_molecules, round(sum(1.0 / k), 6) AS fractional, cast(sum(reads) as bigint) AS total_reads FROM
    (SELECT s.molecule, n.reads, unnest(s.transcripts) AS tx, len(s.transcripts) AS k FROM sets s JOIN (SELECT well || '-' || gene || '-' || umi AS molecule, count(DISTINCT qname) AS reads FROM reads GROUP BY 1) n ON s.molecule = n.molecule) GROUP BY 1, 2""", SEGMENTS, COMPATIBLE)
def _(v):
    reads = M.molecules(v("reads")).select(F.concat_ws("-", "well", "gene", "umi").alias("molecule"), "well", "reads")
    return rounded(M.quantify(M.compatible(covered(v), segments(v)).join(reads, "molecule")), "fractional")


# Quality tables


STATS = f"""cat AS (SELECT *, CASE re WHEN 'E' THEN 'Exon' WHEN 'N' THEN 'Intron' ELSE CASE WHEN phred < 10 THEN 'Unmapped' WHEN phred < 20 THEN 'Secondary' ELSE 'Intergenic' END END AS category FROM reads),
    stats AS (SELECT well, {', '.join(f"count(CASE WHEN category = '{c}' THEN 1 END) AS \"{c}\"" for c in Q.CATEGORIES[:-1])}, count(CASE WHEN category = 'Secondary' THEN 1 END) AS "Other_Unassigned",
    count(CASE WHEN source = 'UMI' THEN 1 END) AS umi_reads, count(CASE WHEN source = 'Internal' THEN 1 END) AS internal_reads FROM cat GROUP BY 1)"""


def categorised(v) -> DataFrame:
    other = F.when(F.col("phred") < 10, "Unmapped").when(F.col("phred") < 20, "Secondary").otherwise("Intergenic")
    return v("reads").withColumn("category", F.when(F.col("re") == "E", "Exon").when(F.col("re") == "N", "Intron").otherwise(other))


@query("a11_read_stats", "SELECT * FROM stats", STATS)
def _(v):
    return Q.read_stats(categorised(v))


MAPPED = '("Exon" + "Intron" + "Intergenic" + "Ambiguity" + "Other_Unassigned")'
RATIOS = f"""ratios AS (SELECT *, {MAPPED} + "Unmapped" AS all_reads, round({MAPPED} / nullif({MAPPED} + "Unmapped", 0), 6) AS "MappingRatio", round(("Exon" + "Intron") / nullif({MAPPED} + "Unmapped", 0), 6) AS "GenicRatio",
    round("Exon" / nullif("Intron", 0), 6) AS "ExonIntronRatio", round(umi_reads / nullif({MAPPED} + "Unmapped", 0), 6) AS "UMIfrac" FROM stats)"""


@query("p30_ratios", "SELECT * FROM ratios", STATS, RATIOS)
def _(v):
    return rounded(Q.with_ratios(Q.read_stats(categorised(v))), "MappingRatio", "GenicRatio", "ExonIntronRatio", "UMIfrac")


@query("a24_well_stats", """SELECT w.well, coalesce("Exon", 0) AS "Exon", coalesce(umi_reads, 0) AS umi_reads, coalesce(max(CASE WHEN ftype = 'exon' THEN total END), 0) AS "Exon_umis", coalesce(max(CASE WHEN ftype = 'inex' THEN genes END), 0) AS "Intron_Exon_genes"
    FROM wells w LEFT JOIN stats s ON w.well = s.well LEFT JOIN summary m ON w.well = m.well GROUP BY w.well, "Exon", umi_reads""", ELIGIBLE, MATRIX, SUMMARY, STATS)
def _(v):
    out = Q.well_stats(v("wells"), Q.read_stats(categorised(v)), X.cell_summary(X.read_matrix(eligible(v))))
    return out.select("well", "Exon", "umi_reads", "Exon_umis", "Intron_Exon_genes")


@query("p31_failed_thresholds", """SELECT well, list_filter([CASE WHEN "Exon" < 300 THEN 'Exon' END, CASE WHEN coalesce("GenicRatio", -1) < 0.6 THEN 'GenicRatio' END], lambda x: x IS NOT NULL) AS failed FROM ratios""", STATS, RATIOS)
def _(v):
    rows = rounded(Q.with_ratios(Q.read_stats(categorised(v))), "GenicRatio")
    return rows.select("well", Q.failed({"Exon": 300, "GenicRatio": 0.6}).alias("failed"))


@query("a28_plates", """SELECT '1' AS plate, count(*) AS expected, count(CASE WHEN "Exon" >= 300 THEN 1 END) AS active, cast(coalesce(median(CASE WHEN "Exon" >= 300 THEN "Exon" END), median("Exon")) as double) AS "median_Exon",
    round(count(CASE WHEN "Exon" >= 300 THEN 1 END) / count(*), 6) AS active_share FROM stats""", STATS)
def _(v):
    return rounded(Q.plates(Q.read_stats(categorised(v)), {"Exon": 300}, ("Exon",)), "active_share")


@query("a27_run_summary", """SELECT round(avg("Exon"), 6) AS "mean_Exon", cast(median("Exon") as double) AS "median_Exon", round(sum("Exon" + "Intron") / sum("Exon" + "Intron" + "Intergenic" + "Ambiguity" + "Unmapped"), 6) AS transcriptome_share FROM stats""", STATS)
def _(v):
    return rounded(Q.run_summary(Q.read_stats(categorised(v)), ("Exon",)), "mean_Exon", "transcriptome_share")


@query("j15_expected_wells", """SELECT coalesce(w.well, s.well) AS well, w.well IS NOT NULL AS expected, coalesce(s."Exon", 0) AS "Exon" FROM wells w FULL JOIN stats s ON upper(w.well) = upper(s.well)""", STATS)
def _(v):
    met = Q.expected_wells(v("wells"), Q.read_stats(categorised(v)))
    return met.select("well", "expected", F.coalesce("Exon", F.lit(0)).alias("Exon"))


@query("j18_gene_span_reads", """SELECT r.qname, r.gene, r.b_start FROM blkg r JOIN (SELECT gene, min("start") AS s, max("end") AS e FROM exons GROUP BY 1) g ON r.gene = g.gene AND r.b_start <= g.e AND g.s <= r.b_end""",
       "blkg AS (SELECT DISTINCT qname, gene, b_start, b_end FROM reads)")
def _(v):
    span = v("exons").groupBy("gene").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    rows = v("reads").select("qname", "gene", "b_start", "b_end").distinct()
    return A.reads_of_genes(rows, span).select("qname", "gene", "b_start")
