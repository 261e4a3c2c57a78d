"""Byte-level BPE encoding and decoding with a public vocabulary.

The vocabulary is a rank file (base64 of a token's bytes and its rank, a line each); Spark ships it to the workers. A text is cut
to the pieces of the pattern, the bytes of a piece are mapped to characters (printable bytes to themselves, the others to
the characters from U+0100 on), and the tokenizers library merges those. A merge is any two tokens whose bytes together are
a token, in the order of the result's rank, and a piece that is a token as a whole is that token, so the ids are those of
the rank file's own rules.

Pieces repeat, so a worker encodes those pieces of a text that it has not met lately, all at once, and keeps the ids of at most
``KEPT`` short ones. A piece of more than ``LONG`` bytes is encoded in windows: the last tokens of a window are taken back until
what ends before the cut and what begins after it do not merge when encoded side by side, in which case the tokens on both
sides are those of the whole piece. So a run of any length needs the memory of its window and its ids.

Offsets follow from the byte lengths of the tokens: in characters, a token spans every character of which it holds a byte, so
tokens that split a character both span it. Decoding maps ids to bytes by the reversed table and joins them before anything is
read as UTF-8, so split characters are whole again.

Defined cases: a null text encodes to nothing, as an empty one does; null ids decode to null; an id outside the vocabulary,
or null, decodes to U+FFFD; an id list that ends within a character has U+FFFD for the rest when read as text, and its bytes
unchanged otherwise. Rows repeat and keep their other columns; an empty table gives no row; an output named like a column
of the input replaces it.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickspark.llm.common import bound_batches, free, ship, shipped

#: How the byte-level vocabularies cut a text before merging. Fixed value, published with the vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Bytes that stand for themselves: printable ones but the soft hyphen. Fixed values, published with the vocabularies.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: What an id outside the vocabulary decodes to: U+FFFD in UTF-8.
UNKNOWN = "\N{REPLACEMENT CHARACTER}".encode()
KEPT = 1 << 18
SHORT = 64
LONG = 1 << 15


def byte_table() -> dict[int, str]:
    """The character of each byte; the others take the characters from U+0100 on, in order."""
    own = set(PRINTABLE)
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(others)}


class ByteBpe:
    """One vocabulary in a worker."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has its core; more threads would only wait
        import regex
        from tokenizers import Tokenizer, models

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.table = byte_table()
        self.pieces = regex.compile(PATTERN)
        ordered = sorted(self.ranks, key=self.ranks.get)
        merges = [(t[:i], t[i:]) for t in ordered for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks]
        vocabulary = {self.mapped(t): i for t, i in self.ranks.items()}
        self.tokenizer = Tokenizer(models.BPE(vocab=vocabulary, merges=[(self.mapped(a), self.mapped(b)) for a, b in merges], ignore_merges=True, cache_capacity=0))
        back = {c: b for b, c in self.table.items()}
        self.bytes_of = [UNKNOWN] * (max(self.ranks.values()) + 1)
        for i in self.ranks.values():
            self.bytes_of[i] = bytes(back[c] for c in self.tokenizer.id_to_token(i))
        self.lengths = np.array([len(b) for b in self.bytes_of])
        self.kept: dict[str, bytes] = {}

    def mapped(self, data: bytes) -> str:
        return data.decode("latin-1").translate(self.table)

    def ids(self, many: list[str]) -> list[list[int]]:
        """Of mapped pieces."""
        return [e.ids for e in self.tokenizer.encode_batch_fast(many, add_special_tokens=False)]

    def long_piece(self, data: bytes, window: int = LONG) -> np.ndarray:
        """Ids of a piece of any length, window by window."""
        out: list[np.ndarray] = []
        at, before, wide = 0, [], window
        while True:
            ids = np.array(self.ids([self.mapped(data[at : at + wide])])[0], dtype="<u4")
            if at + wide >= len(data):
                return np.concatenate([*out, ids])
            ends = at + np.cumsum(self.lengths[ids])
            keep = next((n for n in range(len(ids) - 1, 0, -1) if self.apart(data, int(ends[n - 1]), int(ids[n - 1]), window)), 0)
            if keep:
                out.append(ids[:keep])
                before.append(at)
                at, wide = int(ends[keep - 1]), window
            else:  # no cut here: take the window before back too, since its cut counted on this one's first token
                at, wide = (before.pop(), out.pop() is not None and 2 * wide) if out else (0, 2 * wide)

    def apart(self, data: bytes, end: int, left: int, window: int) -> bool:
        """Whether the token that ends at ``end`` and the one that begins there stay apart when they are encoded as one."""
        right = self.ids([self.mapped(data[end : end + window])])[0][0]
        return self.ids([self.mapped(self.bytes_of[left] + self.bytes_of[right])])[0] == [left, right]

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        cut = self.pieces.findall(text) if text else []
        kept = self.kept
        if new := set(cut).difference(kept):
            if len(kept) + len(new) > KEPT:
                kept = self.kept = {}
                new = set(cut)
            short = [p for p in new if len(p) <= LONG // 4]
            kept.update(zip(short, (np.array(i, dtype="<u4").tobytes() for i in self.ids([self.mapped(p.encode()) for p in short])), strict=True))
            kept.update((p, self.long_piece(p.encode()).tobytes()) for p in new if len(p) > LONG // 4)
        out = b"".join(map(kept.__getitem__, cut))
        if len(kept) > KEPT:
            self.kept = {}
        elif new:
            for p in [p for p in new if len(p) > SHORT]:
                del kept[p]
        return out

    def decode(self, ids: bytes) -> bytes:
        many, n = np.frombuffer(ids, "<u4"), len(self.bytes_of)
        known = self.bytes_of if not len(many) or many.max() < n else [*self.bytes_of, UNKNOWN]
        return b"".join(map(known.__getitem__, np.minimum(many, n).tolist()))

    def offsets(self, text: str, ids: bytes) -> tuple[np.ndarray, np.ndarray]:
        """First and one past the last character of each token."""
        data = np.frombuffer(text.encode(), np.uint8)
        char = np.cumsum((data & 0xC0) != 0x80) - 1
        ends = np.cumsum(self.lengths[np.frombuffer(ids, "<u4")])
        starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        return (char[starts], char[ends - 1] + 1) if len(ends) else (ends, ends)


@lru_cache(maxsize=2)
def opened(name: str) -> ByteBpe:
    return ByteBpe(shipped(name))


def encode(docs: DataFrame, vocabulary: str, text: str = "text", offsets: bool = False) -> DataFrame:
    """``docs`` with ``ids`` (binary: unsigned 32-bit integers, little-endian) and, if asked, ``starts`` and ``ends`` in characters."""
    spark = docs.sparkSession
    bound_batches(spark)
    name = ship(spark, vocabulary)

    @F.pandas_udf("binary")
    def ids(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        code = opened(name)
        for texts in parts:
            yield pd.Series([code.encode(t) for t in texts], dtype=object)

    @F.pandas_udf("ids binary, starts array<int>, ends array<int>")
    def ids_and_offsets(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        code = opened(name)
        for texts in parts:
            packed = [code.encode(t) for t in texts]
            spans = [code.offsets(t or "", i) for t, i in zip(texts, packed, strict=True)]
            yield pd.DataFrame({"ids": packed, "starts": [list(a) for a, _ in spans], "ends": [list(b) for _, b in spans]}, dtype=object)

    if not offsets:
        return docs.withColumn("ids", ids(F.col(text)))
    both = free("_both", docs)
    out = docs.withColumn(both, ids_and_offsets(F.col(text)))
    return out.withColumns({c: F.col(f"{both}.{c}") for c in ("ids", "starts", "ends")}).drop(both)


def n_tokens(ids: Column) -> Column:
    return (F.octet_length(ids) / 4).cast("long")


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def unpacked(ids: pd.Series) -> pd.Series:
    """Packed ids as an array."""
    return pd.Series([None if i is None else np.frombuffer(i, "<u4").astype(np.int32) for i in ids], dtype=object)


@F.pandas_udf(T.BinaryType())
def packed(ids: pd.Series) -> pd.Series:
    """An array of ids, packed; null or negative ones become an id that no vocabulary has."""
    return pd.Series([None if i is None else np.array([2**32 - 1 if x is None or x != x or x < 0 else int(x) for x in i], dtype="<u4").tobytes() for i in ids], dtype=object)


def decode(rows: DataFrame, vocabulary: str, ids: str = "ids") -> DataFrame:
    """``rows`` with ``decoded``: the bytes of the packed ids."""
    spark = rows.sparkSession
    bound_batches(spark)
    name = ship(spark, vocabulary)

    @F.pandas_udf("binary")
    def back(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        code = opened(name)
        for many in parts:
            yield pd.Series([None if i is None else code.decode(i) for i in many], dtype=object)

    return rows.withColumn("decoded", back(F.col(ids)))


@F.pandas_udf(T.StringType())
def as_text(decoded: pd.Series) -> pd.Series:
    """Bytes read as UTF-8; what isn't a whole character becomes U+FFFD."""
    return pd.Series([None if d is None else bytes(d).decode("utf-8", "replace") for d in decoded], dtype=object)
