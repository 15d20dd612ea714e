"""Blocks of documents, and questions that blocks ask of the whole corpus.

Corpus statistics that each document needs (how often a word, shingle or passage occurs anywhere) would take a shuffle
of every token and a join back. Instead documents are packed into blocks of some megabytes, written once to the shared
folder. A block asks for its distinct keys only, once each, with its own counts; the keys travel sorted, as compressed
differences, dealt by key range, so that a key that fills a third of the corpus is one entry per block. The answers,
totals in the order of the keys, go back to the block. All steps are deterministic functions of the written blocks, so
any of them can be run again after a loss.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import release, stored, stored_by

BLOCK_BYTES = 8 << 20
#: Keys of all blocks that one task adds up at a time, about.
KEYS_PER_BUCKET = 1_500_000
#: Input that fills one bucket of a placed table, about, and the most buckets that Spark lets a table have.
PLACE_BYTES, MOST_PLACES = 32 << 20, 100_000
#: Sizes from here on are Spark's guesses for inputs that are not files.
NO_SIZE = 1 << 56
_HEAD = struct.Struct("<cBBQQ")


#: What operators keep in a reused worker between tasks, by name.
_memories: dict[str, dict] = {}


def kept(name: str) -> dict:
    """A memory that outlives a task, until a step of another operator begins in the worker."""
    return _memories.setdefault(name, {})


def trim(own: str = "") -> None:
    """Give back what earlier steps of a reused worker have freed but still hold, and empty all memories but ``own``."""
    import ctypes
    import gc

    for name, memory in _memories.items():
        if name != own:
            memory.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def pack(*arrays: np.ndarray, rising: bool = False, level: int = 1) -> bytes:
    """Arrays as compressed byte planes, narrowed to the bytes in use; ``rising``: the first holds its differences."""
    out = [struct.pack("<I", len(arrays))]
    press = zstandard.ZstdCompressor(level=level).compress
    for i, a in enumerate(arrays):
        kind, size, n = a.dtype.kind, a.dtype.itemsize, len(a)
        if i == 0 and rising and n:
            a = np.diff(a, prepend=a.dtype.type(0))
        planes = np.ascontiguousarray(a).view(np.uint8).reshape(n, size)
        width = size
        if kind == "u":
            most = int(a.max()) if n else 0
            width = max(1, (most.bit_length() + 7) // 8)
        data = press(np.ascontiguousarray(planes[:, :width].T).tobytes())
        out += [_HEAD.pack(kind.encode(), size, width, n, len(data)), data]
    return b"".join(out)


def unpack(data: bytes, rising: bool = False) -> list[np.ndarray]:
    (count,), at, out = struct.unpack_from("<I", data), 4, []
    press = zstandard.ZstdDecompressor()
    for i in range(count):
        kind, size, width, n, length = _HEAD.unpack_from(data, at)
        at += _HEAD.size
        planes = np.zeros((n, size), np.uint8)
        if n:
            planes[:, :width] = np.frombuffer(press.decompress(data[at : at + length]), np.uint8).reshape(width, n).T
        at += length
        a = planes.reshape(-1).view(np.dtype(f"{kind.decode()}{size}")) if n else np.zeros(0, np.dtype(f"{kind.decode()}{size}"))
        out.append(np.cumsum(a, dtype=a.dtype) if i == 0 and rising and n else a)
    return out


@dataclass
class Texts:
    """Ids and whole texts of a block as one run of UTF-8 bytes; document i is ``data[at[i]:at[i + 1]]``.

    ``rest`` has the other columns that the block carries.
    """

    ids: np.ndarray
    at: np.ndarray
    data: bytes
    rest: pa.Table | None = None

    def __iter__(self) -> Iterator[bytes]:
        at = self.at.tolist()
        return (self.data[a:b] for a, b in zip(at, at[1:]))


def pack_texts(ids: np.ndarray, texts: list[bytes], rest: pa.Table | None = None) -> bytes:
    head = pack(ids, np.fromiter(map(len, texts), np.uint64, len(texts)))
    sink = pa.BufferOutputStream()
    if rest is not None:
        with pa.ipc.new_stream(sink, rest.schema) as out:
            out.write_table(rest)
    more = sink.getvalue().to_pybytes()
    press = zstandard.ZstdCompressor(level=6).compress
    return struct.pack("<III", len(head), len(more), len(c := press(more))) + head + c + press(b"".join(texts))


def unpack_texts(payload: bytes) -> Texts:
    n, plain, m = struct.unpack_from("<III", payload)
    press = zstandard.ZstdDecompressor().decompress
    ids, size = unpack(payload[12 : 12 + n])
    rest = pa.ipc.open_stream(press(payload[12 + n : 12 + n + m])).read_all() if plain else None
    return Texts(ids, np.concatenate([[0], np.cumsum(size.astype(np.int64))]), press(payload[12 + n + m :]), rest)


def blocks(docs: DataFrame, id_col: str, text_col: str, make: Callable[..., bytes] = pack_texts, carry: Sequence[str] = (), size: int = BLOCK_BYTES, placed: bool = False) -> DataFrame:
    """Written table (block long, payload binary, n_bytes long) of all rows with a non-null id; null texts are empty.

    ``make`` packs ids and texts, and the columns ``carry`` if there are any. ``placed``: the blocks are dealt once, as
    they are written, and every ``tell`` after that moves the answers only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim()
        first, seq, held, ids, texts, rest = TaskContext.get().partitionId() << 24, 0, 0, [], [], []

        def done() -> pa.RecordBatch:
            more = (pa.Table.from_batches(rest),) if carry else ()
            payload = make(np.array(ids, np.int64), texts, *more)
            return pa.RecordBatch.from_arrays([pa.array([first + seq], pa.int64()), pa.array([payload], pa.binary()), pa.array([held], pa.int64())], names=["block", "payload", "n_bytes"])

        for batch in batches:
            begin = 0
            for n, (i, t) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                ids.append(i)
                texts.append(t or b"")
                held += len(texts[-1])
                if held >= size:
                    rest.append(batch.slice(begin, n + 1 - begin).select(range(2, batch.num_columns)))
                    yield done()
                    begin, seq, held, ids, texts, rest = n + 1, seq + 1, 0, [], [], []
            if begin < batch.num_rows:
                rest.append(batch.slice(begin).select(range(2, batch.num_columns)))
        if ids:
            yield done()
        del ids, texts, rest
        trim()

    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("binary").alias("_text"), *carry)
    packed = rows.mapInArrow(run, "block long, payload binary, n_bytes long")
    if not placed:
        return stored(packed, "blocks")
    # Fewer buckets than the session's shuffles have would be dealt anew.
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_bytes = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    places = min(MOST_PLACES, n_bytes // PLACE_BYTES) if n_bytes < NO_SIZE else least
    out = stored_by(packed, "blocks", "block", max(least, places))
    out.places = max(least, places)
    release(docs.sparkSession)
    return out


def placed_answers(answers: DataFrame, blocks: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """Answers (block, question, bucket, payload) written once to the buckets of the ``placed`` blocks that they go to.

    With those of all questions ``before``, to whose table they are added: one table has all that a block was told.
    """
    out = stored_by(answers.select("block", "question", "bucket", "payload"), "answers", "block", blocks.places, before)
    release(answers.sparkSession)
    return out


@dataclass
class Scale:
    """How keys are cut and dealt: the same for every block of a question."""

    buckets: int
    bits: int

    @staticmethod
    def of(keys: float, spare_bits: int) -> Scale:
        """For about so many keys over all blocks; cut keys collide with odds of 2**-spare_bits each, at most."""
        return Scale(max(1, math.ceil(keys / KEYS_PER_BUCKET)), min(64, math.ceil(math.log2(max(2.0, keys))) + spare_bits))

    def cut(self, keys: np.ndarray) -> np.ndarray:
        return keys >> np.uint64(64 - self.bits)

    def bounds(self) -> np.ndarray:
        return np.array([(b << self.bits) // self.buckets for b in range(1, self.buckets)], np.uint64)


def total_bytes(table: DataFrame) -> int:
    return int(table.agg(F.sum("n_bytes")).first()[0] or 0)


Asked = tuple[np.ndarray, np.ndarray]  # rising distinct keys, and a weight of each


def question(scale: Scale, keys: np.ndarray, weights: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(bucket, payload) rows for rising distinct 64-bit keys with weights."""
    cut = scale.cut(keys)
    ends = np.concatenate([[0], np.searchsorted(cut, scale.bounds()), [len(cut)]])
    for b in np.flatnonzero(np.diff(ends)).tolist():
        own = slice(int(ends[b]), int(ends[b + 1]))
        yield b, pack(cut[own], weights[own], rising=True)


ASKED = "bucket int, block long, payload binary"


def ask(table: DataFrame, scale: Scale, keys_of: Callable[[bytes], Asked]) -> DataFrame:
    """Each block's question. Rows (bucket, block, payload)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim()
        for batch in batches:
            for block, payload in zip(batch.column("block").to_pylist(), batch.column("payload")):
                yield asked_rows(block, scale, *keys_of(payload.as_py()))

    return table.select("block", "payload").mapInArrow(run, ASKED)


def asked_rows(block: int, scale: Scale, keys: np.ndarray, weights: np.ndarray) -> pa.RecordBatch:
    rows = list(question(scale, keys, weights))
    return pa.RecordBatch.from_arrays([pa.array([b for b, _ in rows], pa.int32()), pa.array([block] * len(rows), pa.int64()), pa.array([p for _, p in rows], pa.binary())], names=["bucket", "block", "payload"])


def totals(asked: DataFrame, by: Sequence[str] = ("bucket",), finish: dict[int, Callable[[np.ndarray], np.ndarray]] | None = None) -> DataFrame:
    """(block, bucket, payload): for every question the total weight of each key over all blocks, in the key's order.

    One more row for each bucket, of block -1, holds the number of keys with a total over 0 and the sum of all totals.
    With ``by`` of question and bucket, several questions are answered in one shuffle; their number is a column more,
    and ``finish`` may turn the totals of a question into what it is told. Complex weights are two sums at once.
    """
    several = "question" in by

    def run(group: pa.Table) -> pa.Table:
        trim()
        number = group.column("question")[0].as_py() if several else None
        bucket, group = group.column("bucket")[0].as_py(), group.sort_by("block")  # sums of floats in one order
        parts = [unpack(p.as_py(), rising=True) for p in group.column("payload")]
        keys = np.concatenate([p[0] for p in parts])
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        new = np.concatenate([[True], keys[1:] != keys[:-1]])
        weights = np.concatenate([p[1] for p in parts])[order]
        if weights.dtype.kind == "c":
            weights = weights.astype(np.complex128)
        sums = np.add.reduceat(weights, np.flatnonzero(new))
        tell = finish[number](sums) if finish and number in finish else sums
        back = np.empty(len(keys), tell.dtype)
        back[order] = tell[np.cumsum(new) - 1]
        ends = np.cumsum([len(p[0]) for p in parts])
        out = [pack(x) for x in np.split(back, ends[:-1])] + [pack(np.array([(sums.real > 0).sum()], np.float64), np.array([sums.real.sum()], np.float64))]
        answers = {"block": pa.array([*group.column("block").to_pylist(), -1], pa.int64()), "bucket": pa.array([bucket] * len(out), pa.int32()), "payload": pa.array(out, pa.binary())}
        return pa.table(answers | ({"question": pa.array([number] * len(out), pa.int32())} if several else {}))

    return asked.groupBy(*by).applyInArrow(run, "block long, bucket int, payload binary" + (", question int" if several else ""))


def told(rows: pa.Table, question_no: int = 0) -> np.ndarray:
    """The totals of a block's answers to one question, in the order of its keys."""
    own = rows.filter(pc.equal(rows.column("question"), question_no)).sort_by("bucket").column("payload")
    return np.concatenate([unpack(p.as_py())[0] for p in own]) if len(own) else np.zeros(0)


def tell(table: DataFrame, answers: dict[int, DataFrame], fn: Callable[[int, bytes, pa.Table], pa.Table], schema: T.StructType | str) -> DataFrame:
    """Blocks with their answers, by the question's number, through ``fn``: one task per block."""
    every = None
    for i, a in answers.items():
        part = a.select("block", F.lit(i).alias("question"), "bucket", "payload")
        every = part if every is None else every.unionByName(part)
    return _met(table, every, fn, schema)


def tell_placed(table: DataFrame, answers: DataFrame, fn: Callable[[int, bytes, pa.Table], pa.Table], schema: T.StructType | str) -> DataFrame:
    """``tell`` with the table of ``placed_answers``: they lie in the blocks' buckets, so they meet without being moved.

    A task handles the blocks of a bucket one by one, with their answers as they were written; nothing gathers a block's
    answers into one value, or those of several blocks.
    """
    return _met(table, answers, fn, schema)


def _met(table: DataFrame, answers: DataFrame, fn: Callable[[int, bytes, pa.Table], pa.Table], schema: T.StructType | str) -> DataFrame:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        trim()
        out = fn(left.column("block")[0].as_py(), left.column("payload")[0].as_py(), right)
        trim()  # a worker that waits holds nothing of the last block
        return out

    # An answer never lacks its block; a block without any key has no answer.
    own = answers.where("block >= 0").select("block", "question", "bucket", "payload")
    return table.select("block", "payload").groupBy("block").cogroup(own.groupBy("block")).applyInArrow(run, schema)
