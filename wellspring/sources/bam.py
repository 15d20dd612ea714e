"""Binary alignments (BAM) as DataFrames: the same columns as SAM text.

A file is one task: its blocks are decompressed and its records cut one after the other, in batches of bounded size.
Spark hands a file over as one value, so that a file has at most 2 GB; larger ones come as SAM text or Parquet.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Letters of packed bases and of CIGAR operations, and sizes of the tags' types.
BASES, OPERATIONS = "=ACMGRSVTWYHKDBN", "MIDNSHP=X"
SIZES = {"A": 1, "c": 1, "C": 1, "s": 2, "S": 2, "i": 4, "I": 4, "f": 4}
_FORMATS = {"c": "<b", "C": "<B", "s": "<h", "S": "<H", "i": "<i", "I": "<I", "f": "<f"}
_PAIRS = [a + b for a in BASES for b in BASES]
_HEAD = struct.Struct("<iiBBHHHiiii")
ROWS = 4096


def inflated(data: bytes) -> Iterator[bytes]:
    """The contents of gzip members that follow each other."""
    at = 0
    while at < len(data):
        part = zlib.decompressobj(31)
        yield part.decompress(data[at:] if len(data) - at < 1 << 17 else data[at : at + (1 << 17)])
        while not part.eof:  # a member larger than what was handed over
            taken = len(data) - at if len(data) - at < 1 << 17 else 1 << 17
            at += taken
            if at >= len(data):
                raise ValueError("the file ends inside a block")
            yield part.decompress(data[at : at + (1 << 17)])
        at = min(len(data), at + (1 << 17)) - len(part.unused_data)


class _Stream:
    def __init__(self, data: bytes):
        self.parts, self.buffer, self.at = inflated(data), b"", 0

    def take(self, n: int) -> bytes | None:
        """The next n bytes; null at the end."""
        while len(self.buffer) - self.at < n:
            more = next(self.parts, None)
            if more is None:
                if self.at < len(self.buffer):
                    raise ValueError("the file ends inside a record")
                return None
            self.buffer, self.at = self.buffer[self.at :] + more, 0
        out = self.buffer[self.at : self.at + n]
        self.at += n
        return out


def _tags(raw: bytes, wanted: set[str]) -> dict[str, str]:
    out, at = {}, 0
    while at + 3 <= len(raw):
        name, kind = raw[at : at + 2].decode(), chr(raw[at + 2])
        at += 3
        if kind in "ZH":
            end = raw.index(b"\0", at)
            value, at = raw[at:end].decode(), end + 1
        elif kind == "B":
            of, n = chr(raw[at]), struct.unpack_from("<i", raw, at + 1)[0]
            value, at = "", at + 5 + n * SIZES[of]
        else:
            value = chr(raw[at]) if kind == "A" else str(struct.unpack_from(_FORMATS[kind], raw, at)[0])
            at += SIZES[kind]
        if name in wanted:
            out[name] = value
    return out


def records(data: bytes, wanted: Sequence[str]) -> Iterator[tuple]:
    """(qname, flag, rname, pos, cigar, seq, qual, tags) of a file's records; ``pos`` is 0-based."""
    stream, keep = _Stream(data), set(wanted)
    if stream.take(4) != b"BAM\1":
        raise ValueError("no BAM file")
    number = lambda: struct.unpack("<i", stream.take(4))[0]
    stream.take(number())
    contigs = []
    for _ in range(number()):
        contigs.append(stream.take(number())[:-1].decode())
        number()
    while (size := stream.take(4)) is not None:
        raw = stream.take(struct.unpack("<i", size)[0])
        ref, pos, l_name, _, _, n_ops, flag, l_seq, *_ = _HEAD.unpack_from(raw)
        at = _HEAD.size
        name, at = raw[at : at + l_name - 1].decode(), at + l_name
        ops = struct.unpack_from(f"<{n_ops}I", raw, at)
        at += 4 * n_ops
        half = (l_seq + 1) // 2
        seq = "".join([_PAIRS[b] for b in raw[at : at + half]])[:l_seq]
        quals, at = raw[at + half : at + half + l_seq], at + half + l_seq
        qual = "*" if quals[:1] == b"\xff" else bytes(q + 33 for q in quals).decode()
        found = _tags(raw[at:], keep)
        yield (name, flag, contigs[ref] if ref >= 0 else "*", pos, "".join(f"{o >> 4}{OPERATIONS[o & 15]}" for o in ops) or "*", seq or "*", qual, *(found.get(t) for t in wanted))


def bam(spark: SparkSession, path: str, tags: Sequence[str] = ("CB", "CR", "UR", "GX", "RE", "SR")) -> DataFrame:
    """Alignments with the columns of ``formats.sam``. A broken file raises an error."""
    names = ("qname", "flag", "rname", "pos", "cigar", "seq", "qual", *tags)
    kinds = {"flag": pa.int32(), "pos": pa.int64()}
    schema = T.StructType([T.StructField(n, T.IntegerType() if n == "flag" else T.LongType() if n == "pos" else T.StringType()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows: list[tuple] = []
                for row in records(content.as_py(), tags):
                    rows.append(row)
                    if len(rows) == ROWS:
                        yield table(rows)
                        rows = []
                if rows:
                    yield table(rows)

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, pa.string())) for n, c in zip(names, zip(*rows))], names=list(names))

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, schema)
