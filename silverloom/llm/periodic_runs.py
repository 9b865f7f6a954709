"""Runs of periodic words in a text, found by uniting suffix classes in the order of descending common prefixes.

A run is a stretch of consecutive words with smallest period q, at least max(12, 2q) words long, that no neighbouring word
extends. Its first two suffixes that lie q apart share length - q words, six at the least, so only texts in which six words
stand twice are looked at further. There suffixes are sorted by doubling, and pairs of neighbours in that order are united by
descending common prefix (Kruskal). A class keeps its positions as an ordered set; the smaller set goes into the larger one,
and each position that becomes the neighbour of another at a distance within the common prefix is the seed of a run: the
period is the distance, the end is exact, and the start is as far to the left as the period holds. A smaller period inside
would have been seeded at a smaller distance, so periods that a divisor explains are left out.

Defined results: words are the maximal stretches of characters other than blank and U+0009 to U+000D. A null, empty or blank
text has no words, no runs and an empty collapsed text. A collapsed text is its words without those that some run holds after
its first q words, joined by blanks; all other words stay, whatever runs overlap them. Rows are independent: repeated rows,
ties and other columns change nothing. A column of the input with the name of the output column is replaced. Memory follows
the longest single text.
"""

from __future__ import annotations

from bisect import bisect_left
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverloom.llm.hashing import grams, mix, pieces, raw, word_hashes, words
from silverloom.llm.ship import ship

#: Words of the shortest run, and words that its first two periods share at least.
LEAST = 12
SHARED = LEAST // 2
#: Bytes of text that are looked at together.
SLICE = 1 << 20
#: Positions of a block of an ordered set.
BLOCK = 512

TYPE = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


class Positions:
    """An ordered set of word numbers, in blocks of bounded length."""

    __slots__ = ("blocks", "lasts", "size")

    def __init__(self, first: int):
        self.blocks, self.lasts, self.size = [[first]], [first], 1

    def __iter__(self):
        for block in self.blocks:
            yield from block

    def add(self, x: int) -> tuple[int | None, int | None]:
        """Put x in; the positions next to it."""
        b = min(bisect_left(self.lasts, x), len(self.lasts) - 1)
        block = self.blocks[b]
        i = bisect_left(block, x)
        before = block[i - 1] if i else self.lasts[b - 1] if b else None
        after = block[i] if i < len(block) else None  # x comes after a block only in the last one
        block.insert(i, x)
        self.lasts[b] = block[-1]
        self.size += 1
        if len(block) > 2 * BLOCK:
            self.blocks[b : b + 1] = [block[:BLOCK], block[BLOCK:]]
            self.lasts[b : b + 1] = [block[BLOCK - 1], block[-1]]
        return before, after


def suffixes(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes in order, and the words that each shares with the one before it (none for the first)."""
    n, width, levels = len(ids), 1, []
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64) + 1
    while True:
        levels.append(np.append(rank, 0))
        later = np.zeros(n, np.int64)
        later[: max(0, n - width)] = rank[width:]
        key = rank * (n + 1) + later
        order = np.argsort(key, kind="stable")
        names = np.concatenate([[1], 1 + np.cumsum(key[order][1:] != key[order][:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = names
        if names[-1] == n:
            break
        width *= 2
    shared = np.zeros(n, np.int64)
    left, right = order[:-1], order[1:]
    for k in reversed(range(len(levels))):
        own = shared[1:]
        own += (levels[k][left + own] == levels[k][right + own]).astype(np.int64) << k
    return order, shared


def seeds(order: np.ndarray, shared: np.ndarray, least: int = SHARED) -> dict[tuple[int, int], int]:
    """(end, period) of every seed and the smallest start at which it was found."""
    edges = np.flatnonzero(shared >= least)
    edges = edges[np.argsort(-shared[edges], kind="stable")]
    at, lengths = order.tolist(), shared.tolist()
    parent: dict[int, int] = {}
    classes: dict[int, Positions] = {}
    found: dict[tuple[int, int], int] = {}

    def top(i: int) -> int:
        if i not in parent:
            parent[i], classes[i] = i, Positions(at[i])
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for k in edges.tolist():
        small, large = top(k - 1), top(k)
        if classes[small].size > classes[large].size:
            small, large = large, small
        parent[small] = large
        own, reach, last = classes[large], lengths[k], None
        for x in classes.pop(small):
            before, after = own.add(x)
            if before == last:  # they were neighbours before, of another common prefix
                before = None
            last = x
            for i, j in ((before, x), (x, after)):
                if i is not None and j is not None and j - i <= reach:
                    seed = (j + reach, j - i)
                    if found.get(seed, j) > i:
                        found[seed] = i
    return found


def _has_smaller(ids: np.ndarray, start: int, period: int) -> bool:
    """Does a proper divisor of the period hold over two periods?"""
    part = ids[start : start + 2 * period]
    rest, p = period, 2
    while rest > 1:
        if p * p > rest:
            p = rest
        if rest % p:
            p += 1
            continue
        q = period // p
        if np.array_equal(part[q:], part[:-q]):
            return True
        while rest % p == 0:
            rest //= p
    return False


def runs_of(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    if len(ids) < LEAST:
        return []
    listed, out = ids.tolist(), set()
    for (end, period), start in seeds(*suffixes(ids)).items():
        while start and listed[start - 1] == listed[start - 1 + period]:
            start -= 1
        if end - start >= max(LEAST, 2 * period) and not _has_smaller(ids, start, period):
            out.add((start, end - start, period))
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words no run holds after its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) == 0


def _suspects(hashed: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Rows in which some SHARED words stand twice (or hashes that collide: no row is missed)."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    if len(hashed) <= SHARED:
        return np.empty(0, np.int64)
    same = row[: 1 - SHARED] == row[SHARED - 1 :]
    row = row[: 1 - SHARED][same]
    key = mix(grams(hashed, SHARED)[same] ^ mix(row.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key)
    return np.unique(row[order[1:][key[order][1:] == key[order][:-1]]])


def _struct(texts: pa.Array) -> pa.Array:
    text, offsets = raw(texts)
    starts, ends, first = words(text, offsets)
    suspects = set(_suspects(word_hashes(text, starts, ends), first).tolist())
    data, at = text.tobytes(), offsets.tolist()
    found, collapsed = [], []
    for i in range(len(texts)):
        parts, runs = data[at[i] : at[i + 1]].split(), []
        if i in suspects:
            names: dict[bytes, int] = {}
            runs = runs_of(np.array([names.setdefault(w, len(names)) for w in parts], np.int64))
        found.append([{"start": s, "length": n, "period": q} for s, n, q in runs])
        collapsed.append(b" ".join(compress(parts, kept_words(len(parts), runs)) if runs else parts).decode())
    kind = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))
    return pa.StructArray.from_arrays(
        [pa.array(np.diff(first), pa.int64()), pa.array(found, kind), pa.array(collapsed, pa.string())],
        ["n_words", "runs", "collapsed"],
    )


def periodic_runs(text: Column) -> Column:
    """n_words, runs (by start, then period) and collapsed of each text, as a struct."""

    @F.arrow_udf(TYPE)
    def found(column: pa.Array) -> pa.Array:
        table = pa.RecordBatch.from_arrays([column], ["text"])
        parts = [_struct(part.column(0)) for part in pieces(iter([table]), "text", SLICE)]
        return pa.concat_arrays(parts) if parts else _struct(column)

    return found(text)


def with_runs(docs: DataFrame, text: str = "text", out: str = "periodic") -> DataFrame:
    """Add the struct ``out`` to every row."""
    ship(docs.sparkSession)
    return docs.withColumn(out, periodic_runs(F.col(text)))
