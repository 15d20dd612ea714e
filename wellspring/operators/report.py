"""What a run's report shows: quality figures, category shares, distributions and curves, as rows."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from html import escape

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as E

#: Categories of the report's shares, and the row of reads without a cell.
CATEGORIES, NO_CELL = ("Exon", "Intron", "Intergenic", "Ambiguity", "Unmapped"), "__NO_CB__"


def to_number(text: Column) -> Column:
    """A number that may hold thousands separators; anything else null."""
    return F.replace(F.trim(text.cast("string")), F.lit(","), F.lit("")).try_cast("double")


def whole(value: Column) -> Column:
    """Rounded, with thousands separators; '' without a number."""
    return F.coalesce(F.format_number(F.rint(to_number(value)), 0), F.lit(""))


def percent(value: Column) -> Column:
    """A share as a percentage of one place; '' without a number."""
    n = to_number(value)
    return F.when(n.isNull(), F.lit("")).otherwise(F.format_string("%.1f%%", n * 100.0))


def shown(value: Column, kind: str) -> Column:
    """A figure as the report shows it, NA where there is none: ``int``, ``pct`` or as it is."""
    text = whole(value) if kind == "int" else percent(value) if kind == "pct" else value.cast("string")
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit("NA")).otherwise(text)


def matrix_stats(matrix: DataFrame) -> DataFrame:
    """(well, umis, genes) of a matrix's positive entries."""
    return matrix.where("n > 0").groupBy("well").agg(F.sum("n").cast("long").alias("umis"), F.count(F.lit(1)).alias("genes"))


def category_shares(stats: DataFrame, categories: Sequence[str] = CATEGORIES, unused: str = "Unused_BC") -> DataFrame:
    """(category, share): of all wells' reads and the unused ones (of the row without a cell), the latter as Unused BC."""
    cells = F.col("well") != NO_CELL
    spare = F.sum(F.when(~cells, F.col(unused))) if unused in stats.columns else F.lit(0)
    sums = stats.agg(*[F.coalesce(F.sum(F.when(cells, F.col(c))), F.lit(0)).alias(c) for c in categories], F.coalesce(spare, F.lit(0)).alias("Unused BC"))
    every = [*categories, "Unused BC"]
    total = sum((F.col(f"`{c}`") for c in every[1:]), F.col(every[0]))
    parts = F.explode(F.array(*[F.struct(F.lit(c).alias("category"), F.coalesce(E.ratio(F.col(f"`{c}`"), total), F.lit(0.0)).alias("share")) for c in every]))
    return sums.select(parts.alias("p")).select("p.*")


def cell_shares(stats: DataFrame, categories: Sequence[str] = CATEGORIES) -> DataFrame:
    """(well, category, share) of each well's reads; wells without reads are absent."""
    total = sum((F.col(c) for c in categories[1:]), F.col(categories[0]))
    rows = stats.where((F.col("well") != NO_CELL) & ~F.startswith("well", F.lit("__"))).where(total > 0)
    parts = F.explode(F.array(*[F.struct(F.lit(c).alias("category"), E.ratio(F.col(c), total).alias("share")) for c in categories]))
    return rows.select("well", parts.alias("p")).select("well", "p.*")


def read_counts(stats: DataFrame, categories: Sequence[str], unused: str = "Unused_BC") -> DataFrame:
    """One row (total, valid, unused, valid_rate): a well's reads are its UMI and internal ones, or else all categories."""
    have = F.coalesce(F.col("umi_reads").isNotNull() | F.col("internal_reads").isNotNull(), F.lit(False))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    own = F.when(have, zero("umi_reads") + zero("internal_reads")).otherwise(sum((zero(c) for c in categories[1:]), zero(categories[0])))
    cell = ~F.startswith("well", F.lit("__"))
    spare = F.coalesce(F.sum(F.when(F.col("well") == NO_CELL, F.col(unused))), F.lit(0)) if unused in stats.columns else F.lit(0)
    sums = stats.agg(F.coalesce(F.sum(F.when(cell, own)), F.lit(0)).cast("long").alias("valid"), spare.cast("long").alias("unused"))
    return sums.select((F.col("valid") + F.col("unused")).alias("total"), "valid", "unused", E.ratio(F.col("valid"), F.col("valid") + F.col("unused")).alias("valid_rate"))


#: The figures of the quality table with their kinds, and the metrics of its rates.
FIGURES = (("Total sequencing reads", "total", "int"), ("Valid barcode reads", "valid", "int"), ("Unused barcode reads", "unused", "int"), ("Valid barcode rate", "valid_rate", "pct"))
RATES = (("Cell barcode Q30", "BC"), ("UMI Q30", "UMI"), ("Read1 cDNA Q30", "R1_cDNA"), ("Read2 cDNA Q30", "R2_cDNA"))


def sequencing_quality(counts: DataFrame | None, quality: DataFrame, read_length: int = 0, barcodes: DataFrame | None = None) -> DataFrame:
    """(no, metric, value, raw) of the quality table.

    Without ``read_counts`` the total follows from read 1's bases over its length and valid reads from the barcode
    counts (XC, n); unused ones are then unknown.
    """
    rates = quality.agg(*[F.max(F.when(F.col("metric") == m, F.col("q30_rate"))).alias(m) for _, m in RATES], F.max(F.when(F.col("metric") == "R1", F.col("total_bases"))).alias("_bases"))
    if counts is None:
        total = F.when(F.lit(read_length) > 0, F.rint(F.col("_bases") / F.lit(max(1, read_length)))).cast("long")
        valid = quality.sparkSession.createDataFrame([(None,)], "valid long") if barcodes is None else barcodes.agg(F.nullif(F.sum("n"), F.lit(0)).cast("long").alias("valid"))
        row = rates.crossJoin(F.broadcast(valid)).withColumn("total", total)  # one row each
        row = row.withColumns({"unused": F.lit(None).cast("long"), "valid_rate": E.ratio(F.col("valid"), F.col("total"))})
    else:
        row = rates.crossJoin(F.broadcast(counts))  # one row each
    every = [*FIGURES, *((label, m, "pct") for label, m in RATES)]
    parts = F.array(*[F.struct(F.lit(i + 1).alias("no"), F.lit(label).alias("metric"), shown(F.col(c), kind).alias("value"), F.col(c).cast("double").alias("raw")) for i, (label, c, kind) in enumerate(every)])
    return row.select(F.explode(parts).alias("p")).select("p.*")


def distributions(summary: DataFrame, wells: DataFrame) -> DataFrame:
    """(ftype, genes, umis): quartiles over all wells of a matrix summary (well, ftype, total, genes), absent ones 0."""
    kinds = summary.sparkSession.createDataFrame([("exon",), ("inex",), ("intron",)], "ftype string")
    every = wells.select("well").distinct().crossJoin(F.broadcast(kinds)).join(summary, ["well", "ftype"], "left")  # wells x 3
    box = lambda c: F.percentile(F.coalesce(c, F.lit(0)), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return every.groupBy("ftype").agg(box("genes").alias("genes"), box("total").alias("umis"))


def series(curve: DataFrame, x: str, ys: Mapping[str, float]) -> DataFrame:
    """Columns of a curve scaled (a share to percent by 100), and ``headline_<column>``: its value at the largest ``x``."""
    last = curve.agg(*[F.max_by(F.col(y) * k, x).alias(f"headline_{y}") for y, k in ys.items()])
    return curve.select(x, *[(F.col(y) * k).alias(y) for y, k in ys.items()]).crossJoin(F.broadcast(last))  # one row


def versioned(df: DataFrame, version: int = 1, column: str = "schema_version") -> DataFrame:
    """``df``, or an error for rows of another version."""
    bad = F.when(F.coalesce(F.col(column) != version, F.lit(True)), F.raise_error(F.concat(F.lit("unknown schema version "), F.coalesce(F.col(column).cast("string"), F.lit("null"))))).cast("string")
    return df.where(F.coalesce(bad, F.lit("")) == "")


def json_literal(value: object) -> str:
    """JSON that may stand in a script block: no tag, comment or line separator of a script can begin in it."""
    text = json.dumps(value, ensure_ascii=False)
    for mark in "<>&\u2028\u2029":
        text = text.replace(mark, f"\\u{ord(mark):04x}")
    return text


def html(title: str, tables: Mapping[str, DataFrame], charts: Mapping[str, DataFrame] | None = None, most: int = 5000) -> str:
    """A page of small tables, and the charts' rows as JSON in a script block. A table over ``most`` rows raises an error."""
    out = [f"<!doctype html><html><head><meta charset='utf-8'><title>{escape(title)}</title></head><body><h1>{escape(title)}</h1>"]
    for name, df in tables.items():
        rows = df.limit(most + 1).collect()
        if len(rows) > most:
            raise ValueError(f"{name} has over {most} rows; a report shows summaries")
        cells = lambda values, tag: "".join(f"<{tag}>{escape('' if v is None else str(v))}</{tag}>" for v in values)
        out.append(f"<h2>{escape(name)}</h2><table><tr>{cells(df.columns, 'th')}</tr>" + "".join(f"<tr>{cells(r, 'td')}</tr>" for r in rows) + "</table>")
    data = {name: [r.asDict() for r in df.limit(most).collect()] for name, df in (charts or {}).items()}
    out.append(f"<script type='application/json' id='charts'>{json_literal(data)}</script></body></html>")
    return "\n".join(out)
