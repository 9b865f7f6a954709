"""Winnowed anchors of word or byte sequences, with the context that decides every window around them.

A window is ``length`` consecutive symbols of one row; its anchor is the k-gram of least hash in it, the rightmost of equals.
Equal windows have equal anchors, so repeats are found by meeting on anchors. All windows of one anchor lie in the symbols
from ``length - k`` before the anchor to ``length - k`` behind it; the hash of this context, cut at the ends of the row,
therefore decides how many windows the anchor has and what they are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from silverloom.llm.hashing import grams, mix, spans

_PLACE = np.uint64(0xFFFFFF)
#: Longest piece of a row that is looked at at once; the place of a gram in it must fit 24 bits.
_PIECE = 1 << 23


@dataclass
class Anchors:
    at: np.ndarray  # place of the k-gram in the batch
    row: np.ndarray
    seed: np.ndarray  # hash of the k-gram
    context: np.ndarray
    first: np.ndarray  # first window that has this anchor
    last: np.ndarray  # one past the last


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of keys[i : i + width] for every i."""
    n = len(keys) - width + 1
    if width <= 32:
        out = keys[:n].copy()
        for i in range(1, width):
            np.minimum(out, keys[i : i + n], out=out)
        return out
    blocks = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    blocks[: len(keys)] = keys
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def _pieces(rows: np.ndarray, length: int):
    """(start, end, first row) of stretches of whole rows, or of overlapping parts of a long row."""
    i, last = 0, len(rows) - 1
    while i < last:
        if rows[i + 1] - rows[i] > _PIECE:
            for start in range(int(rows[i]), int(rows[i + 1]) - length + 1, _PIECE - length + 1):
                yield start, min(start + _PIECE, int(rows[i + 1]))
            i += 1
            continue
        j = int(np.searchsorted(rows, rows[i] + _PIECE, side="right")) - 1
        j = max(i + 1, min(j, last))
        yield int(rows[i]), int(rows[j])
        i = j


def anchors(values: np.ndarray, rows: np.ndarray, length: int, k: int) -> Anchors:
    """The anchors of all windows. ``values``: the symbols of all rows; ``rows``: where each row begins, and the end."""
    rows = np.asarray(rows, np.int64)
    width = length - k + 1
    end_of = np.repeat(rows[1:], np.diff(rows))  # end of the row of each symbol
    found, starts = [], []
    for start, end in _pieces(rows, length):
        if end - start < length:
            continue
        hashed = grams(values[start:end], k)
        keys = (hashed & ~_PLACE) | (_PLACE - np.arange(len(hashed), dtype=np.uint64))
        least = _least(keys, width)
        window = np.flatnonzero(np.arange(start, start + len(least)) + length <= end_of[start : start + len(least)])
        place = start + (_PLACE - (least[window] & _PLACE)).astype(np.int64)
        found.append(place)
        starts.append(window + start)
    if not found or not sum(map(len, found)):
        none = np.empty(0, np.int64)
        return Anchors(none, none, none.astype(np.uint64), none.astype(np.uint64), none, none)
    place, window = np.concatenate(found), np.concatenate(starts)
    head = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1])]))
    at, first = place[head], window[head]
    last = window[np.concatenate([head[1:], [len(place)]]) - 1] + 1
    row = np.searchsorted(rows, at, side="right") - 1
    seed = spans(values, at, at + k)
    low, high = np.maximum(at - width + 1, rows[row]), np.minimum(at + length, rows[row + 1])
    room = (at - low).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + (high - at).astype(np.uint64)
    context = mix(spans(values, low, high) ^ mix(room))
    return Anchors(at, row, seed, context, first, last)


def member(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which values are in the sorted array ``of``."""
    if not len(of):
        return np.zeros(len(values), bool)
    return of[np.minimum(np.searchsorted(of, values), len(of) - 1)] == values


def covered(n: int, starts: np.ndarray, length: int) -> np.ndarray:
    """Which of n symbols lie in a window that begins at one of ``starts``."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + length, -1)
    return np.cumsum(step)[:n] > 0


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every run of true."""
    edge = np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
