"""Byte-level BPE encoding and decoding over a prefix-sharing trie.

The encoding of a word is a chain of last tokens: the last token of the encoding of any prefix, preceded by the
encoding of what is left of the prefix. So one token per prefix describes all encodings, and words that share a prefix
share it. The distinct words go into a trie that a worker keeps between batches. A node's last token is the one
vocabulary entry that ends there and that the merges would put after the last token of the ancestor where it starts; it
is found, and those of the ancestors that it needs, when first asked for.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .blocks import kept, trim

#: How byte-level BPE vocabularies spell a byte, and where they cut text into words. White space is
#: spelt out as Unicode's property, which a regular expression library may extend by control characters.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def word_pattern(letter: str, number: str, space: str) -> str:
    """The classes are insides of brackets."""
    return rf"'(?:s|t|re|ve|m|ll|d)| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+"


WORDS = word_pattern(r"\p{L}", r"\p{N}", _SPACE)
#: The same for texts below U+0250, where the classes are short and the standard library's engine is twice as fast.
LATIN_WORDS = word_pattern(r"a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ", r"0-9\xb2\xb3\xb9\xbc-\xbe", r"\t-\r \x85\xa0")
BEYOND_LATIN = "[ɐ-\U0010ffff]"
#: Encodings a worker keeps between batches, the longest in bytes, token pairs, and nodes of the trie; beyond it a
#: memory is emptied.
KEPT_WORDS, KEPT_BYTES, KEPT_PAIRS, KEPT_NODES = 400_000, 64, 300_000, 150_000
#: Rows and bytes of text that are Python objects at a time (one text at least), and the last bytes that name the sizes
#: of the tokens worth trying.
ROWS, TEXT_BYTES, END = 256, 1 << 20, 4
SHORT = tuple(range(END - 1, 0, -1))


def byte_spelling() -> dict[str, int]:
    """Printable bytes stand for themselves, the others for the code points from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens and merges of one tokenizer file, and a worker's memories: the trie, token pairs, encodings."""

    def __init__(self, spec: str):
        model = json.loads(spec)
        spell = byte_spelling()
        raw = lambda s: bytes(spell[c] for c in s)
        self.id_of = {raw(t): i for t, i in model["model"]["vocab"].items()}
        self.bytes_of = {i: t for t, i in self.id_of.items()}
        self.special = {x["content"]: x["id"] for x in model.get("added_tokens", [])}
        self.spelt = self.bytes_of | {i: s.encode() for s, i in self.special.items()}
        # Merges by the pair, whose ids make one number: their rank, and by rank what they give.
        self.rank: dict[int, int] = {}
        self.gives: list[int] = []
        for m in model["model"]["merges"]:
            x, y = map(raw, m.split(" ") if isinstance(m, str) else m)
            self.rank[self.id_of[x] << 32 | self.id_of[y]] = len(self.gives)
            self.gives.append(self.id_of[x + y])
        # Only tokens that encode to themselves can end an encoding; the last merge of each is the one that makes it.
        self.made: dict[int, tuple[int, int, int]] = {}
        self.whole = {t: i for t, i in self.id_of.items() if self.merged(t, self.made) == [i]}
        made = {i: self.made[i][0] if i in self.made else -1 for i in self.whole.values()}
        self.rising = all(r > max(made.get(pair >> 32, -1), made.get(pair & 0xFFFFFFFF, -1)) for pair, r in self.rank.items())
        # Lengths of the tokens that end in some bytes, longest first: the only ones worth trying there.
        sizes: dict[bytes, set[int]] = {}
        for t in self.whole:
            if len(t) >= END:
                sizes.setdefault(t[-END:], set()).add(len(t))
        short = lambda end: {n for n in range(1, END) if end[-n:] in self.whole}
        same: dict[tuple[int, ...], tuple[int, ...]] = {}
        self.sizes = {end: same.setdefault(own, own) for end, more in sizes.items() for own in [tuple(sorted(more | short(end), reverse=True))]}
        self.beside: dict[int, bool] = {}
        self.kept: dict[str, bytes] = {}
        self.forget()

    def forget(self) -> None:
        """Empty the trie. The root is node 0, a node's child by a byte is at ``byte << 40 | node``; -1: not asked for yet."""
        self.child: dict[int, int] = {}
        self.last = [-1]

    def merged(self, word: bytes, made: dict[int, tuple[int, int, int]] | None = None) -> list[int]:
        """The merges, applied lowest rank and leftmost first; used on single tokens and pairs only.

        ``made`` gets rank, left and right of the last merge, if one token is left.
        """
        parts, none, last = [self.id_of.get(word[i : i + 1], -1) for i in range(len(word))], len(self.gives), None
        while len(parts) > 1:
            ranks = [self.rank.get(a << 32 | b, none) for a, b in zip(parts, parts[1:])]
            if (r := min(ranks)) == none:
                break
            i = ranks.index(r)
            last = (r, *parts[i : i + 2])
            parts[i : i + 2] = [self.gives[r]]
        if made is not None and last and len(parts) == 1:
            made[parts[0]] = last
        return parts

    def follows(self, a: int, b: int) -> bool:
        """Whether the merges leave a border between tokens a and b."""
        if (known := self.beside.get(a << 32 | b)) is None:
            if len(self.beside) >= KEPT_PAIRS:
                self.beside.clear()
            known = self._apart(a, b) if self.rising else self.merged(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
            self.beside[a << 32 | b] = known
        return known

    def _apart(self, a: int, b: int) -> bool:
        """``follows`` where each merge ranks after those that made its parts, so that merges are applied by rising rank.

        Until the border goes, each side merges as it would alone. What stands left of the border is in turn a's last
        byte, ..., the right part of a's last merge, a, each until the merge that takes it up; the other side likewise.
        The border goes if a pair that stands there has a merge before either part is taken up (of equal merges the
        left one is first).
        """
        rank, made, none = self.rank, self.made, len(self.gives)
        rights, until = [(b, none)], made.get(b)
        while until:
            rights.append((until[1], until[0]))
            until = made.get(until[1])
        left, end = a, none
        while True:
            for right, stop in rights:
                r = rank.get(left << 32 | right)
                if r is not None and r < end and r <= stop:
                    return False
            if (until := made.get(left)) is None:
                return True
            end, left = until[0], until[2]

    def encode_words(self, words: set[str], nodes: int = KEPT_NODES) -> dict[str, bytes]:
        """Packed ids of each word. Neighbours in order share most of their way down the trie."""
        return {word: pack(self._ids(word.encode(), nodes)) for word in sorted(words)}

    def _ids(self, raw: bytes, nodes: int) -> list[int]:
        """From the last token backwards; the trie grows by the nodes that the word lacks."""
        if len(raw) > KEPT_BYTES:  # a path of its own, not kept and filled from its beginning
            path, last = range(len(raw) + 1), [-1] * (len(raw) + 1)
            for n in range(1, len(raw) + 1):
                self._at(raw, path, last, n)
        else:
            if len(self.last) > nodes:
                self.forget()
            child, last, node, path = self.child, self.last, 0, [0]
            for byte in raw:
                key = byte << 40 | node
                if (below := child.get(key)) is None:
                    child[key] = below = len(last)
                    last.append(-1)
                node = below
                path.append(node)
        out, at = [], len(raw)
        while at:
            end = last[path[at]]
            out.append(end if end >= 0 else self._at(raw, path, last, at))
            at -= len(self.bytes_of[out[-1]])
        out.reverse()
        return out

    def _at(self, raw: bytes, path: Sequence[int], last: list[int], n: int) -> int:
        """The last token of the first n bytes of ``raw``, found once for the node at ``path[n]``.

        Only one token can be it, so the order in which they are tried is free.
        """
        whole, beside = self.whole, self.beside
        for size in self.sizes.get(raw[n - END : n], SHORT) if n >= END else SHORT[END - 1 - n :]:
            if size > n or (token := whole.get(raw[n - size : n])) is None:
                continue
            if size < n:
                before = last[path[n - size]]
                if before < 0:
                    before = self._at(raw, path, last, n - size)
                fits = beside.get(before << 32 | token)
                if not (self.follows(before, token) if fits is None else fits):
                    continue
            last[path[n]] = token
            return token
        raise ValueError("the vocabulary lacks a byte")


def pack(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


MEMORY = "vocabulary"
_vocabularies: dict[int, Vocabulary] = kept(MEMORY)


def _vocabulary(spec: str) -> Vocabulary:
    """One per worker; a worker that gets another file, or a step of another operator, forgets the last."""
    key = hash(spec)
    if key not in _vocabularies:
        _vocabularies.clear()
        _vocabularies[key] = Vocabulary(spec)
    return _vocabularies[key]


def _splitter() -> Callable[[str], list[str]]:
    import regex

    latin, wide, beyond = re.compile(LATIN_WORDS).findall, regex.compile(WORDS).findall, re.compile(BEYOND_LATIN).search
    return lambda text: wide(text) if beyond(text) else latin(text)


def _pieces(text: str, cut, words_of) -> list[str]:
    """The words of a text. Special tokens cut it, and each stretch between them is cut into words on its own."""
    if cut is None or not cut.search(text):
        return words_of(text)
    own, begin = [], 0
    for m in cut.finditer(text):
        own += [*words_of(text[begin : m.start()]), m[0]]
        begin = m.end()
    return own + words_of(text[begin:])


def _encode_rows(texts: list[str], vocab: Vocabulary, cut, words_of, kept_words: int = KEPT_WORDS) -> list[bytes]:
    pieces = [_pieces(t, cut, words_of) for t in texts]
    words = set().union(*pieces)
    if len(vocab.kept) + len(words) > kept_words:
        vocab.kept = {}
    known = vocab.kept
    if new := words.difference(known, vocab.special):
        known.update(vocab.encode_words(new))
    # A word never contains a special token, so the special tokens' strings can share the table.
    known.update((s, pack([i])) for s, i in vocab.special.items())
    packed = [b"".join(map(known.__getitem__, own)) for own in pieces]
    for w in new:
        if len(w) > KEPT_BYTES:
            del known[w]
    return packed


def _parts(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """The batch in parts of bounded rows and bytes, however long its texts are and however they are sorted."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    begin = held = 0
    for n, s in enumerate(size):
        if n > begin and (held + s > TEXT_BYTES or n - begin == ROWS):
            yield batch.slice(begin, n - begin)
            begin, held = n, 0
        held += s
    if begin < len(size):
        yield batch.slice(begin)


def _encoder(spec: str, text_col: str, verify: bool, kept_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim(MEMORY)
        vocab, words_of = _vocabulary(spec), _splitter()
        cut = re.compile("|".join(map(re.escape, sorted(vocab.special, key=len, reverse=True)))) if vocab.special else None
        for batch in batches:
            for rows in _parts(batch, text_col):
                texts = [t or "" for t in rows.column(text_col).to_pylist()]
                packed = _encode_rows(texts, vocab, cut, words_of, kept_words)
                more = {"n_tokens": pa.array([len(p) // 4 for p in packed], pa.int64()), "ids": pa.array(packed, pa.binary())}
                if verify:
                    more["round_trip"] = pa.array([_decode(p, vocab.spelt) == t for p, t in zip(packed, texts)])
                yield pa.RecordBatch.from_arrays([*rows.columns, *more.values()], names=[*rows.schema.names, *more])
        trim(MEMORY)

    return run


def _decode(packed: bytes, spelt: dict[int, bytes]) -> str:
    import numpy as np

    return b"".join(map(spelt.__getitem__, np.frombuffer(packed, "<u4").tolist())).decode("utf-8", "replace")


def _spelling(spec: str) -> dict[int, bytes]:
    """The bytes of every id; all that decoding needs of a tokenizer."""
    model, spell = json.loads(spec), byte_spelling()
    plain = {i: bytes(spell[c] for c in t) for t, i in model["model"]["vocab"].items()}
    return plain | {x["id"]: x["content"].encode() for x in model.get("added_tokens", [])}


def _decoder(spec: str, ids_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelt = _spelling(spec)
        for batch in batches:
            for rows in _parts(batch, ids_col):
                texts = [_decode(p or b"", spelt) for p in rows.column(ids_col).to_pylist()]
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(texts, pa.string())], names=[*rows.schema.names, "decoded"])

    return run


def _spec(path: str) -> str:
    """The tokenizer file goes with the task; its size is that of a vocabulary and is checked."""
    with open(path, encoding="utf-8") as f:
        spec = f.read()
    if len(spec) > 64 << 20:
        raise ValueError(f"{path} is over 64 MB; that is no vocabulary")
    return spec


def wider(df: DataFrame, **more: T.DataType) -> T.StructType:
    return T.StructType([*df.schema.fields, *(T.StructField(n, t) for n, t in more.items())])


def encode(df: DataFrame, tokenizer_path: str, text_col: str = "text", verify: bool = False, kept_words: int = KEPT_WORDS) -> DataFrame:
    """``df`` with ``n_tokens`` (long) and ``ids`` (binary: little-endian unsigned 32-bit token ids) of ``text_col``.

    Same ids as the tokenizers library gives for the file without added special tokens; strings of special tokens in a
    text become their ids. A null or empty text has no ids. ``verify`` adds ``round_trip``: whether decoding gives the
    text again; ``kept_words`` bounds the encodings that a worker remembers. Columns that already have these names are replaced; rows are neither dropped nor merged, so repeated
    rows come out repeated. No shuffle: a map over partitions.
    """
    more = {"n_tokens": T.LongType(), "ids": T.BinaryType()} | ({"round_trip": T.BooleanType()} if verify else {})
    df = df.drop(*more)
    return df.mapInArrow(_encoder(_spec(tokenizer_path), text_col, verify, kept_words), wider(df, **more))


def decode(df: DataFrame, tokenizer_path: str, ids_col: str = "ids") -> DataFrame:
    """``df`` with ``decoded`` (string), the text of the packed ids, special tokens included; null ids give ''."""
    df = df.drop("decoded")
    return df.mapInArrow(_decoder(_spec(tokenizer_path), ids_col), wider(df, decoded=T.StringType()))
