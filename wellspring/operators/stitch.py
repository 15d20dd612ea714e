"""Molecules stitched from their reads: bases, consensus, and one alignment each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import intervals as I
from . import isoform as M

_OPS = r"(\d+)([MIDNSHP=X])"


def operations(cigar: Column) -> Column:
    """An array of (n, op)."""
    return F.zip_with(F.regexp_extract_all(cigar, F.lit(_OPS), F.lit(1)), F.regexp_extract_all(cigar, F.lit(_OPS), F.lit(2)), lambda n, op: F.struct(n.cast("long").alias("n"), op.alias("op")))


def walked(pos: Column, cigar: Column) -> Column:
    """An array of (op, n, ref, query): each operation with the 0-based places on reference and read where it begins."""
    ops = operations(cigar)
    empty = F.array().cast("array<struct<op:string,n:bigint,ref:bigint,query:bigint>>")
    step = lambda acc, o: F.struct(
        (acc["ref"] + F.when(o["op"].isin("M", "=", "X", "D", "N"), o["n"]).otherwise(0)).alias("ref"),
        (acc["query"] + F.when(o["op"].isin("M", "=", "X", "I", "S"), o["n"]).otherwise(0)).alias("query"),
        F.concat(acc["l"], F.array(F.struct(o["op"].alias("op"), o["n"].alias("n"), acc["ref"].alias("ref"), acc["query"].alias("query")))).alias("l"),
    )
    zero = F.struct(pos.cast("long").alias("ref"), F.lit(0).cast("long").alias("query"), empty.alias("l"))
    return F.aggregate(ops, zero, step, lambda acc: acc["l"])


def aligned_bases(reads: DataFrame, *keys: str) -> DataFrame:
    """(keys, pos, base, qual) of every base that is aligned: M, = and X, as far as the sequence goes."""
    each = reads.select(*keys, "seq", "qual", F.explode(walked(F.col("pos"), F.col("cigar"))).alias("o")).where(F.col("o.op").isin("M", "=", "X") & (F.col("o.n") > 0))
    at = each.select(*keys, "seq", "qual", "o.ref", "o.query", F.explode(F.sequence(F.lit(0).cast("long"), F.col("o.n") - 1)).alias("i")).where(F.col("query") + F.col("i") < F.length("seq"))
    letter = lambda c: F.substr(F.col(c), (F.col("query") + F.col("i") + 1).cast("int"), F.lit(1))
    return at.select(*keys, (F.col("ref") + F.col("i")).alias("pos"), letter("seq").alias("base"), (F.ascii(letter("qual")) - 33).alias("qual"))


def skipped(reads: DataFrame, *keys: str) -> DataFrame:
    """(keys, start, end) of reference that reads skip (N), closed and 0-based."""
    each = reads.select(*keys, F.explode(walked(F.col("pos"), F.col("cigar"))).alias("o")).where("o.op = 'N' AND o.n > 0")
    return each.select(*keys, F.col("o.ref").alias("start"), (F.col("o.ref") + F.col("o.n") - 1).alias("end"))


def usable(reads: DataFrame, cells: DataFrame | None = None, paired: bool = True) -> DataFrame:
    """Reads of molecules: mapped, primary, of a proper pair whose mate is mapped (if ``paired``), with a cell, a UMI and one gene.

    Adds ``gene``, ``exonic``, ``intronic``, ``first`` and ``strand``; ``cells`` (cell) leaves out other cells.
    """
    flag = F.col("flag")
    keep = (flag.bitwiseAND(0x904) == 0) & F.col("CB").isNotNull() & (F.coalesce(F.length(F.trim("UB")), F.lit(0)) > 0)
    if paired:
        keep = keep & (flag.bitwiseAND(0xB) == 0x3)
    gene, exonic, intronic = M.assigned_gene(*(F.col(c) for c in ("GE", "GI", "GX", "RE")))
    out = reads.where(keep).withColumns({"gene": gene, "exonic": exonic, "intronic": intronic}).where("gene IS NOT NULL")
    out = out if cells is None else out.join(cells.select(F.col("cell").alias("CB")).distinct(), "CB", "left_semi")
    return out.withColumns({"first": flag.bitwiseAND(0x40) != 0, "strand": F.when(flag.bitwiseAND(0x10) != 0, "-").otherwise("+"), "UB": F.trim("UB")})


def synthesised(covered: DataFrame, skips: DataFrame, key: str = "molecule") -> DataFrame:
    """(key, pos, cigar, conflict): M where covered, N where skipped and not covered, D in what is left of the span.

    ``covered`` and ``skips`` are (key, start, end), closed. ``conflict`` counts bases that are both. Neighbouring
    operations of a kind are one: a sweep over the edges of both sets, each with what it begins and ends.
    """
    a, b = I.merge(covered.select(key, "start", "end"), [key]), I.merge(skips.select(key, "start", "end"), [key])
    event = lambda df, m: df.select(key, F.explode(F.array(F.struct(F.col("start").alias("at"), F.lit(1).alias("d")), F.struct((F.col("end") + 1).alias("at"), F.lit(-1).alias("d")))).alias("e")).select(key, "e.at", (F.col("e.d") * m).alias("m"), (F.col("e.d") * (1 - m)).alias("n"))
    events = event(a, 1).unionByName(event(b, 0)).groupBy(key, "at").agg(F.sum("m").alias("m"), F.sum("n").alias("n"))
    span = a.groupBy(key).agg(F.min("start").alias("low"), (F.max("end") + 1).alias("high"))
    w = Window.partitionBy(key).orderBy("at")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    swept = events.select(key, "at", F.lead("at").over(w).alias("next"), F.sum("m").over(run).alias("m"), F.sum("n").over(run).alias("n"))
    parts = swept.join(span, key).where("at >= low AND next <= high AND next > at")
    op = F.when(F.col("m") > 0, "M").when(F.col("n") > 0, "N").otherwise("D")
    parts = parts.select(key, "at", (F.col("next") - F.col("at")).alias("size"), op.alias("op"), F.when((F.col("m") > 0) & (F.col("n") > 0), F.col("next") - F.col("at")).otherwise(0).alias("both"))
    new = F.when(F.lag("op").over(w) == F.col("op"), 0).otherwise(1)
    runs = parts.withColumn("_new", new).withColumn("_run", F.sum("_new").over(run)).groupBy(key, "_run", "op").agg(F.min("at").alias("at"), F.sum("size").alias("size"), F.sum("both").alias("both"))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", F.concat(F.col("size").cast("string"), "op").alias("t")))), lambda x: x["t"]), "")
    return runs.groupBy(key).agg(F.min("at").alias("pos"), text.alias("cigar"), F.sum("both").cast("long").alias("conflict"))


def stitch(reads: DataFrame, cells: DataFrame | None = None, paired: bool = True, entries: DataFrame | None = None, junctions: DataFrame | None = None) -> DataFrame:
    """One row a molecule (cell, gene, UMI): qname, flag, rname, pos, mapq, cigar, seq, qual and the tags NR, ER, IR, CB, GX, UB, NC, CT.

    ``reads`` are alignments with the tags CB, UB, GE, GI, GX, RE. The sequence is the consensus of all aligned bases,
    flag 16 the reverse strand, by majority. ``entries`` and ``junctions`` of ``annotation.transcript_indices`` give the
    compatible transcripts. A molecule's bases are added up by position before they are put together.
    """
    name = F.concat_ws(":", "CB", "gene", "UB")
    own = usable(reads, cells, paired).withColumn("molecule", name)
    who = own.select("molecule", "CB", "gene", "UB", "rname").groupBy("molecule").agg(*[F.min(c).alias(c) for c in ("CB", "gene", "UB", "rname")])
    kinds = own.select(F.col("CB").alias("well"), "gene", F.col("UB").alias("umi"), "qname", "strand", "first", "exonic", "intronic")
    both = kinds.withColumn("re", F.explode(F.array_compact(F.array(F.when(F.col("exonic"), "E"), F.when(F.col("intronic"), "N")))))
    counted = M.molecules(both, paired).withColumn("molecule", F.concat_ws(":", "well", "gene", "umi")).select("molecule", "reads", "exonic", "intronic", "strand")
    called = M.consensus(aligned_bases(own, "molecule"))
    put = lambda c: F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", F.col(c).alias("x")))), lambda e: e["x"]), "")
    lines = called.withColumn("_q", F.char(F.col("qual") + 33)).groupBy("molecule").agg(put("base").alias("seq"), put("_q").alias("qual"))
    covered = I.from_positions(called, ["molecule"])
    skips = skipped(own, "molecule")
    out = lines.join(synthesised(covered, skips), "molecule").join(counted, "molecule").join(who, "molecule")
    ct = F.lit(None).cast("string")
    if entries is not None:
        of = lambda df: df.join(who.select("molecule", "gene"), "molecule").select("molecule", "gene", F.col("start").alias("b_start"), F.col("end").alias("b_end"))
        fit = M.compatible(of(covered), entries, None if junctions is None else of(I.merge(skips, ["molecule"])), junctions)
        out, ct = out.join(fit, "molecule", "left"), F.array_join("transcripts", ",")
    return out.select(
        F.col("molecule").alias("qname"), F.when(F.col("strand") == "-", 16).otherwise(0).alias("flag"), "rname", "pos", F.lit(255).alias("mapq"), "cigar", "seq", "qual",
        F.col("reads").alias("NR"), F.col("exonic").alias("ER"), F.col("intronic").alias("IR"), "CB", F.col("gene").alias("GX"), "UB", F.when(F.col("conflict") > 0, F.col("conflict")).alias("NC"), ct.alias("CT"),
    )


def sam_lines(stitched: DataFrame) -> DataFrame:
    """(value) of stitched molecules as SAM text, by contig, position and name: ranges over tasks, sorted within."""
    tags = [F.when(F.col(t).isNotNull(), F.concat(F.lit(f"{t}:{k}:"), F.col(t).cast("string"))) for t, k in (("NR", "i"), ("ER", "i"), ("IR", "i"), ("CB", "Z"), ("GX", "Z"), ("UB", "Z"), ("NC", "i"), ("CT", "Z"))]
    fields = ["qname", F.col("flag").cast("string"), "rname", (F.col("pos") + 1).cast("string"), F.col("mapq").cast("string"), "cigar", F.lit("*"), F.lit("0"), F.lit("0"), "seq", "qual"]
    return stitched.orderBy("rname", "pos", "qname").select(F.concat_ws("\t", *fields, *tags).alias("value"))
