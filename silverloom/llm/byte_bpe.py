"""Byte-level BPE: texts to token ids and back, with the tokenizers library over Arrow batches.

A rank file (one base64 token and its rank a line) becomes a BPE model over the 256 printable stand-ins of the bytes. Each
token is a merge of every pair of ranked tokens that spells it, in the order of ranks, and a piece that is itself a token is
taken whole; that is the rule of rank-based encoders, and the tests compare ids with one. Pieces are cut with the pattern of
the vocabulary and encoded once while a worker remembers them, so a frequent word costs a table lookup.

Defined results: a null or empty text has no ids and decodes to zero bytes; null ids decode to null. A column of the input
that has the name of an output column is replaced by it. Rows are independent: repeated rows, ties and other columns change
nothing. A text of any length is cut where a piece must begin, so memory follows the slice and not the text.
"""

from __future__ import annotations

import base64
import os
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverloom.llm.ship import ship

#: Characters of a text whose pieces are held at once.
PART = 1 << 18
#: Characters of pieces that a worker learns before it drops the older half of what it remembers.
CACHE = 4 << 20


@lru_cache(maxsize=1)
def byte_characters() -> list[str]:
    """The printable stand-in of each byte: itself where Latin-1 prints it, else a character from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    table = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [table[b] for b in range(256)]


def parse_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}


class Coder:
    """One vocabulary: pieces of text to ids, ids to bytes."""

    def __init__(self, data: bytes, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        import regex
        from tokenizers import models

        ranks, to_char = parse_ranks(data), byte_characters()
        spelled = {token: "".join(to_char[b] for b in token) for token in ranks}
        merges = []
        for token in sorted(ranks, key=ranks.get):
            pairs = [(token[:i], token[i:]) for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks]
            merges += [(spelled[a], spelled[b]) for a, b in sorted(pairs, key=lambda p: (ranks[p[0]], ranks[p[1]]))]
        vocab = {spelled[t]: r for t, r in ranks.items()}
        self.model = models.BPE(vocab=vocab, merges=merges, ignore_merges=True, cache_capacity=0)
        self.spelling = dict(enumerate(to_char))
        self.find = regex.compile(pattern).findall
        to_byte = {c: b for b, c in enumerate(to_char)}
        self.table = [b""] * (max(ranks.values()) + 1)
        for name, i in vocab.items():
            self.table[i] = bytes(to_byte[c] for c in name)
        self.lengths = np.array([len(t) for t in self.table], np.int64)
        self.pieces: dict[str, bytes] = {}  # ids as 32-bit integers
        self.older: dict[str, bytes] = {}
        self.held = 0

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text; together the texts are short, or there is one."""
        if len(texts) == 1 and len(texts[0] or "") > PART:  # one part after the other
            return [np.concatenate([self._ids([part])[0] for part in cut(texts[0], PART)])]
        return self._ids([text or "" for text in texts])

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = [self.find(text) for text in texts]
        self._learn(set().union(*found))
        return [np.frombuffer(b"".join(map(self.pieces.__getitem__, own)), np.int32) for own in found]

    def _learn(self, pieces: set[str]) -> None:
        """Encode the pieces that are not remembered. What was used lately stays; a frequent piece is never forgotten."""
        if self.held > CACHE:
            self.pieces, self.older, self.held = {}, self.pieces, 0
        for piece in pieces.difference(self.pieces):
            ids = self.older.get(piece)
            if ids is None:
                spelled = piece.encode().decode("latin-1").translate(self.spelling)
                ids = array("i", [token.id for token in self.model.tokenize(spelled)]).tobytes()
            self.pieces[piece] = ids
            self.held += len(piece)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.table.__getitem__, ids))

    def offsets(self, text: str | None, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and one past the last character that the bytes of each token belong to.

        A character whose bytes are split among tokens belongs to each of them.
        """
        data = np.frombuffer((text or "").encode(), np.uint8)
        character = np.cumsum((data & 0xC0) != 0x80) - 1  # of each byte
        last = np.cumsum(self.lengths[ids])
        return character[last - self.lengths[ids]].astype(np.int32), (character[last - 1] + 1).astype(np.int32)


def cut(text: str, size: int) -> list[str]:
    """Parts of about ``size`` characters that begin at a blank between two other characters: a piece begins there."""
    out, start = [], 0
    while len(text) - start > size:
        at = text.find(" ", start + size)
        while at > 0 and (at + 1 >= len(text) or text[at - 1].isspace() or text[at + 1].isspace()):
            at = text.find(" ", at + 1)
        if at < 0:
            break
        out.append(text[start:at])
        start = at
    return [*out, text[start:]] if out else [text]


@lru_cache(maxsize=4)
def _coder(data: bytes, pattern: str) -> Coder:
    return Coder(data, pattern)


class Vocabulary:
    """A rank file, read on the driver and broadcast (a megabyte), and the pattern that cuts texts into pieces."""

    def __init__(self, spark, path: str, pattern: str):
        ship(spark)
        with open(path, "rb") as file:
            self._data = spark.sparkContext.broadcast(file.read())
        self._pattern = pattern

    def __getstate__(self):
        return {"_data": self._data, "_pattern": self._pattern}

    def coder(self) -> Coder:
        return _coder(self._data.value, self._pattern)


def _slices(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of rows of about PART characters together."""
    at = np.concatenate([[0], np.cumsum(lengths)])
    i = 0
    while i < len(lengths):
        j = max(i + 1, int(np.searchsorted(at, at[i] + PART, side="right")) - 1)
        yield i, j
        i = j


def _lists(parts: list[np.ndarray], kind) -> pa.Array:
    at = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(parts) if parts else np.empty(0, np.int32), kind))


def _texts(column: pa.Array) -> Iterator[list[str | None]]:
    for i, j in _slices(np.array([0 if n is None else n for n in pc.utf8_length(column).to_pylist()], np.int64)):
        yield column.slice(i, j - i).to_pylist()


def token_ids(text: Column, vocabulary: Vocabulary) -> Column:
    """The ids of a text, as array<int>."""

    @F.arrow_udf("array<int>")
    def ids(column: pa.Array) -> pa.Array:
        coder, out = vocabulary.coder(), []
        for texts in _texts(column):
            out += coder.encode(texts)
        return _lists(out, pa.int32())

    return ids(text)


def token_offsets(text: Column, ids: Column, vocabulary: Vocabulary) -> Column:
    """The characters of the text that each of its ids covers: array of (start, end), ends exclusive."""

    @F.arrow_udf("array<struct<start:int,end:int>>")
    def offsets(column: pa.Array, encoded: pa.Array) -> pa.Array:
        coder = vocabulary.coder()
        found = [
            coder.offsets(t, np.array(i or [], np.int64))
            for t, i in zip(column.to_pylist(), encoded.to_pylist(), strict=True)
        ]
        at = np.concatenate([[0], np.cumsum([len(a) for a, _ in found])]).astype(np.int32)
        both = [np.concatenate([x[k] for x in found]) if found else np.empty(0, np.int32) for k in (0, 1)]
        return pa.ListArray.from_arrays(pa.array(at), pa.StructArray.from_arrays([pa.array(b) for b in both], ["start", "end"]))

    return offsets(text, ids)


def token_bytes(ids: Column, vocabulary: Vocabulary) -> Column:
    """The bytes that ids stand for. They need not be whole characters: see ``split_characters``."""

    @F.arrow_udf("binary")
    def decoded(column: pa.Array) -> pa.Array:
        coder, out = vocabulary.coder(), []
        values, at = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
        known = column.is_valid().to_pylist()
        for i, there in enumerate(known):
            out.append(coder.decode(values[at[i] : at[i + 1]].tolist()) if there else None)
        return pa.array(out, pa.binary())

    return decoded(ids)


def split_characters(data: Column) -> Column:
    """Bytes as text; what is left of a character cut off at either end becomes U+FFFD.

    A window of ids may begin or end inside a character. The whole row of ids decodes without loss.
    """

    @F.arrow_udf("string")
    def text(column: pa.Array) -> pa.Array:
        return pa.array([None if b is None else b.decode("utf-8", "replace") for b in column.to_pylist()], pa.string())

    return text(data)


def encode(df: DataFrame, vocabulary: Vocabulary, text: str = "text", offsets: bool = False) -> DataFrame:
    """Add ``ids``, and with ``offsets`` the characters that each id covers."""
    out = df.withColumn("ids", token_ids(F.col(text), vocabulary))
    return out.withColumn("offsets", token_offsets(F.col(text), F.col("ids"), vocabulary)) if offsets else out


def decode(df: DataFrame, vocabulary: Vocabulary, ids: str = "ids") -> DataFrame:
    """Add ``decoded``: the bytes of the ids."""
    return df.withColumn("decoded", token_bytes(F.col(ids), vocabulary))
