"""Column builders. All stay in the JVM; null in gives null out unless said otherwise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def hamming(a: Column, b: Column) -> Column:
    """Positions that differ; texts of unequal length differ by the length of the first."""
    at = F.filter(F.sequence(F.lit(1), F.length(a)), lambda i: F.substr(a, i, F.lit(1)) != F.substr(b, i, F.lit(1)))
    return F.when(F.length(a) != F.length(b), F.length(a)).when(F.length(a) == 0, F.lit(0)).otherwise(F.size(at))


def slices(seq: Column, ranges: Sequence[tuple[int, int]]) -> Column:
    """The 0-based half-open ranges of a read, joined."""
    return F.concat(*[F.substring(seq, s + 1, e - s) for s, e in ranges]) if ranges else F.lit("")


def low_quality(qual: Column, phred: int) -> Column:
    """Bases whose quality (ASCII less 33) is under ``phred``."""
    low = "".join(chr(c) for c in range(33, 33 + phred))
    return F.length(qual) - F.length(F.translate(qual, low, ""))


def high_quality(qual: Column, phred: int = 30) -> Column:
    return F.length(qual) - low_quality(qual, phred)


def read_id(header: Column) -> Column:
    """A read's name without the leading mark, what follows white space, and the mate number."""
    return F.regexp_replace(F.split(header, r"\s")[0], "^@|/[12]$", "")


def is_representative(flag: Column) -> Column:
    """Counts for its pair: neither secondary nor supplementary; of a pair the first mate only."""
    return ((flag.bitwiseAND(0x900)) == 0) & ((flag.bitwiseAND(1) == 0) | (flag.bitwiseAND(0x40) != 0))


def is_mapped(flag: Column) -> Column:
    return flag.bitwiseAND(4) == 0


def natural_key(text: Column) -> Column:
    """Sorts A2 before A10: digit runs padded, letters lower-cased."""
    parts = F.regexp_extract_all(F.lower(text), F.lit(r"(\d+|\D+)"), F.lit(1))
    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike(r"^\d"), F.lpad(p, 20, "0")).otherwise(p)), "")


def ratio(a: Column, b: Column) -> Column:
    """a over b; null where b is 0."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def plate(well: Column) -> Column:
    """The plate number of a well like P3B12, or null."""
    return F.nullif(F.regexp_extract(well, r"^P(\d+)[A-P]\d+$", 1), F.lit(""))


def masks(text: Column) -> Column:
    """The text with each position blanked in turn: texts of one length share one iff they differ in at most that place."""
    return F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.overlay(text, F.lit("*"), i, F.lit(1)))


def cigar_blocks(pos: Column, cigar: Column) -> Column:
    """0-based half-open reference blocks: M, = and X make one, D and N move on, I, S, H and P don't."""
    ops = F.zip_with(
        F.regexp_extract_all(cigar, F.lit(r"(\d+)[MIDNSHP=X]"), F.lit(1)),
        F.regexp_extract_all(cigar, F.lit(r"\d+([MIDNSHP=X])"), F.lit(1)),
        lambda n, op: F.struct(n.cast("long").alias("n"), op.alias("op")),
    )
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")
    step = lambda acc, o: F.struct(
        F.when(o["op"].isin("M", "=", "X", "D", "N"), acc["at"] + o["n"]).otherwise(acc["at"]).alias("at"),
        F.when(o["op"].isin("M", "=", "X"), F.concat(acc["blocks"], F.array(F.struct(acc["at"].alias("start"), (acc["at"] + o["n"]).alias("end"))))).otherwise(acc["blocks"]).alias("blocks"),
    )
    return F.aggregate(ops, F.struct(pos.cast("long").alias("at"), empty.alias("blocks")), step, lambda acc: acc["blocks"])
