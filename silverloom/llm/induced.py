"""Suffix order and common prefixes of a text on disk, by external induced sorting.

The text is symbols: 0 ends a string, 1 to 256 are bytes, larger ones are names that the caller gave to long substrings (the
level of the recursion above; a string has one name at most). A suffix is L or S as it is larger or smaller than the next one. The leftmost S suffixes are
sorted by naming the substrings between them and doubling the names. From them two scans induce the rest: each suffix, in
ascending order, hands the suffix one symbol before it to the queue of that symbol, if it is L, and in descending order if it
is S. A queue is first in, first out, so what it hands on is in suffix order: together, read by symbol, the queues are a
priority queue of tuples (symbol, arrival). They hold (place, common prefix with the tuple before) and move to disk when they
grow. The common prefix of two tuples that follow each other in a queue is one more than the least of those scanned between
their arrivals. Prefixes are counted up to ``depth`` only, which is all that repeats of a fixed length need.

The work is done on whole blocks of tuples, not on single ones. Text, types and marks are mapped from files.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

#: Symbols below this have a queue each; the larger ones are names.
NAMES = 257
#: Tuples that a queue holds in memory, and tuples that are scanned together.
HELD, BLOCK = 1 << 16, 1 << 18


def mapped(n: int, kind) -> np.ndarray:
    """An array in a file that goes with it."""
    if not n:
        return np.empty(0, kind)
    with tempfile.TemporaryFile() as file:
        return np.memmap(file, kind, "w+", shape=(n,))


class Queue:
    """Tuples (place, common prefix), first in, first out; more than HELD of them go to a file."""

    def __init__(self):
        self._parts: list[tuple[np.ndarray, np.ndarray]] = []
        self._held, self._file, self._written, self._read = 0, None, 0, 0
        self.last = -1  # place of the last tuple

    def push(self, place: np.ndarray, prefix: np.ndarray) -> None:
        self._parts.append((place, prefix))
        self._held += len(place)
        self.last = int(place[-1])
        if self._held > HELD:
            self._spill()

    def _spill(self) -> None:
        if self._file is None:
            self._file = tempfile.TemporaryFile()
        rows = np.stack([np.concatenate([p[k] for p in self._parts]).astype(np.int64) for k in (0, 1)], axis=1)
        self._file.seek(self._written * 16)
        self._file.write(rows.tobytes())
        self._written += len(rows)
        self._parts, self._held = [], 0

    def pop(self) -> tuple[np.ndarray, np.ndarray] | None:
        """The next tuples, in order of arrival; those still to come are popped later."""
        if self._read < self._written:
            self._file.seek(self._read * 16)
            rows = np.frombuffer(self._file.read(16 * min(BLOCK, self._written - self._read)), np.int64).reshape(-1, 2)
            self._read += len(rows)
            return rows[:, 0].copy(), rows[:, 1].copy()
        if not self._parts:
            return None
        out = tuple(np.concatenate([p[k] for p in self._parts]) for k in (0, 1))
        self._parts, self._held = [], 0
        return out

    def backwards(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All tuples from the last to the first, each with the common prefix of the one that comes after it here before it."""
        if self._parts:
            self._spill()
        follow = 0
        for end in range(self._written, 0, -BLOCK):
            start = max(0, end - BLOCK)
            self._file.seek(start * 16)
            rows = np.frombuffer(self._file.read(16 * (end - start)), np.int64).reshape(-1, 2)
            prefix = np.append(rows[1:, 1], follow)[::-1]
            follow = int(rows[0, 1])
            yield rows[::-1, 0].copy(), prefix.copy()


def common(text: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Length of the common prefix of the suffixes at a and b, at most depth."""
    out = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    for d in range(depth):
        inside = np.maximum(a[live], b[live]) + d < len(text)
        live = live[inside]
        live = live[text[a[live] + d] == text[b[live] + d]]
        if not len(live):
            break
        out[live] = d + 1
    return out


def types(text: np.ndarray) -> np.ndarray:
    """True for S suffixes. The last one is L."""
    n = len(text)
    differ = np.flatnonzero(text[1:] != text[:-1])
    ends = np.append(differ, n - 1)
    grows = np.append(text[differ] < text[differ + 1], False)
    return np.repeat(grows, np.diff(np.concatenate([[-1], ends])))


def sorted_heads(text: np.ndarray, small: np.ndarray, depth: int) -> np.ndarray:
    """The leftmost S suffixes in order, compared to ``depth`` symbols at least."""
    heads = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if not len(heads):
        return heads
    ends = np.append(heads[1:], len(text) - 1)
    length = ends - heads + 1
    names = np.zeros(len(heads), np.int64)
    offset, live = 0, np.arange(len(heads))
    while len(live):  # refine the names by the next two symbols and types of the substrings that are so long
        key = np.zeros(len(live), np.int64)
        for step in (offset, offset + 1):
            there = length[live] > step
            at = np.minimum(heads[live] + step, len(text) - 1)
            key = (key << 31) | np.where(there, 2 * text[at].astype(np.int64) + small[at] + 1, 0)
        refined = np.zeros(len(heads), np.int64)
        refined[live] = key
        order = np.lexsort((refined, names))
        new = np.concatenate([[0], (np.diff(names[order]) != 0) | (np.diff(refined[order]) != 0)]).cumsum()
        names[order] = new
        offset += 2
        live = np.flatnonzero(length > offset)
    known = 1  # substrings that the names cover; each has two symbols of its own at least
    while 2 * known < depth + 2 and names.max() + 1 < len(names):
        after = np.append(names[known:] + 1, np.zeros(min(known, len(names)), np.int64))[: len(names)]
        names = np.unique((names << 32) | after, return_inverse=True)[1]
        known *= 2
    return heads[np.argsort(names, kind="stable")]


class _Scan:
    """Hands suffixes to the queues of the symbols before them."""

    def __init__(self, text: np.ndarray, small: np.ndarray, want_small: bool, depth: int):
        self.text, self.small, self.want, self.depth = text, small, want_small, depth
        self.queues = [Queue() for _ in range(NAMES)]
        self.named: list[np.ndarray] = []
        self.least = np.full(NAMES, depth, np.int64)  # common prefix scanned since the last arrival in each queue
        self.used = np.zeros(NAMES, bool)

    def feed(self, place: np.ndarray, prefix: np.ndarray) -> None:
        before = place - 1
        chosen = np.flatnonzero((before >= 0) & (self.small[before] == self.want))
        symbol = self.text[before[chosen]]
        after = np.minimum(self.least, prefix.min())
        named = symbol >= NAMES
        if named.any():
            self.named.append(before[chosen[named]])
            chosen, symbol = chosen[~named], symbol[~named]
        order = np.argsort(symbol.astype(np.uint16), kind="stable")
        chosen, symbol = chosen[order], symbol[order]
        edges = np.flatnonzero(np.concatenate([[True], symbol[1:] != symbol[:-1], [True]])) if len(symbol) else []
        for i in range(len(edges) - 1):
            at, c = chosen[edges[i] : edges[i + 1]], int(symbol[edges[i]])
            found = np.empty(len(at), np.int64)
            found[0] = min(self.least[c], prefix[: at[0] + 1].min()) if self.used[c] else -1
            if len(at) > 1:
                found[1:] = np.minimum.reduceat(prefix[: at[-1] + 1], at[:-1] + 1)
            self.queues[c].push(before[at], np.minimum(found + 1, self.depth))
            after[c] = prefix[at[-1] + 1 :].min() if at[-1] + 1 < len(prefix) else self.depth
            self.used[c] = True
        self.least = after


def repeated(text: np.ndarray, depth: int) -> np.ndarray:
    """True where ``depth`` symbols begin that also begin elsewhere. Strings end with 0, and so does the text."""
    hit = mapped(len(text), bool)
    if not len(text):
        return hit
    small = mapped(len(text), bool)
    small[:] = types(text)
    heads = sorted_heads(text, small, depth)
    prefix = np.append(0, common(text, heads[:-1], heads[1:], depth)) if len(heads) else heads
    edges = np.searchsorted(text[heads], np.arange(NAMES + 1))

    def mark(place: np.ndarray, prefix: np.ndarray, previous: int) -> int:
        equal = np.flatnonzero(prefix >= depth)
        if len(equal):
            hit[place[equal]] = True
            hit[np.where(equal > 0, place[equal - 1], previous)] = True
        return int(place[-1])

    up = _Scan(text, small, False, depth)
    large = [Queue() for _ in range(NAMES)]
    up.feed(np.array([len(text)]), np.array([0]))  # the end of the text comes before its last suffix
    for c in range(NAMES):
        last = -1
        while (block := up.queues[c].pop()) is not None:
            last = mark(*block, last)
            large[c].push(*block)
            up.feed(*block)
        own = slice(edges[c], edges[c + 1])
        if own.start < own.stop:
            first = prefix[own].copy()
            first[0] = common(text, np.array([last]), heads[own][:1], depth)[0] if last >= 0 else 0
            for i in range(0, len(first), BLOCK):
                up.feed(heads[own][i : i + BLOCK], first[i : i + BLOCK])
    down = _Scan(text, small, True, depth)
    if up.named:
        place = np.concatenate(up.named)
        place = place[np.argsort(text[place], kind="stable")]
        same = np.append(0, common(text, place[:-1], place[1:], depth))
        mark(place, same, -1)
        for i in range(len(place), 0, -BLOCK):
            low = max(0, i - BLOCK)
            follow = np.append(same[low + 1 : i], same[i] if i < len(place) else 0)
            down.feed(place[low:i][::-1].copy(), follow[::-1].copy())
    for c in range(NAMES - 1, -1, -1):
        last = -1
        while (block := down.queues[c].pop()) is not None:
            last = mark(*block, last)
            down.feed(*block)
        joint = True
        for place, same in large[c].backwards():
            if joint:
                same[0] = common(text, place[:1], np.array([last]), depth)[0] if last >= 0 else 0
                if same[0] >= depth:
                    hit[[place[0], last]] = True
                joint = False
            down.feed(place, same)
    return hit
