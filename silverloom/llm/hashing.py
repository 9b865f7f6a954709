"""Hashes of words, word n-grams and byte n-grams, vectorised over a whole Arrow batch of texts.

A hash is a polynomial modulo 2**64 over random values of the bytes (or over the hashes of the words), taken from a
prefix sum, so that every position costs the same few array operations whatever the length of the n-gram. The multipliers
are odd, so a difference of prefix sums is brought to offset zero by a power of the inverse. A last mixing step spreads
the bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15
#: Bytes whose positions are hashed at once.
SLICE = 1 << 16
_VALUES = np.random.default_rng(20_011).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


@lru_cache(maxsize=8)
def powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i below size."""
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        x = np.full(size, b, np.uint64)
        x[0] = 1
        out.append(np.cumprod(x, dtype=np.uint64))
    return out[0], out[1]


def mix(x: np.ndarray) -> np.ndarray:
    """The finishing step of a 64-bit hash: every input bit changes every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _room(n: int) -> int:
    """The power of two that holds n, so that few tables of powers are kept."""
    return 1 << max(10, int(n).bit_length())


def grams(values: np.ndarray, size: int, base: int = BASE) -> np.ndarray:
    """Hash of values[i : i + size] for every i at which that many follow."""
    n = len(values)
    if n < size:
        return np.empty(0, np.uint64)
    out = np.empty(n - size + 1, np.uint64)
    step = max(SLICE, 4 * size)
    for i in range(0, len(out), step):
        part = values[i : i + step + size - 1]
        up, down = powers(base, _room(step + size))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * up[: len(part)], out=sums[1:])
        count = len(part) - size + 1
        out[i : i + count] = mix((sums[size:] - sums[:count]) * down[:count])
    return out


def spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASE) -> np.ndarray:
    """Hash of values[start : end] for each pair, in order of start; equal contents give equal hashes."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        first = starts[i]
        j = max(i + 1, int(np.searchsorted(starts, first + SLICE)))
        last = int(ends[i:j].max())
        part = values[first:last]
        up, down = powers(base, _room(len(part) + 1))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * up[: len(part)], out=sums[1:])
        out[i:j] = mix((sums[ends[i:j] - first] - sums[starts[i:j] - first]) * down[starts[i:j] - first])
        i = j
    return out


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; a null row is empty."""
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, at, data = column.buffers()
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    text = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and data.size else np.empty(0, np.uint8)
    return text, offsets - offsets[0]


def words(text: np.ndarray, offsets: np.ndarray, is_space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the first word of every row (one more entry than rows)."""
    n = len(text)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~is_space[text]
    before = inside[:-1].copy()  # is the byte before inside a word of the same row
    before[offsets] = False
    starts = np.flatnonzero(inside[1:-1] & ~before[:n])
    after = inside[1:].copy()
    after[offsets] = False
    ends = np.flatnonzero(inside[1:-1] & ~after[1:]) + 1 if n else np.empty(0, np.int64)
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return spans(_VALUES[text], starts, ends)


def byte_values(text: np.ndarray) -> np.ndarray:
    return _VALUES[text]


def pieces(batches: Iterator[pa.RecordBatch], text: str, size: int) -> Iterator[pa.RecordBatch]:
    """Cut batches into slices of about ``size`` bytes of text; a longer text is a slice of its own."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        _, at = raw(column)
        i = 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(at, at[i] + size, side="right")) - 1)
            yield batch.slice(i, j - i)
            i = j
