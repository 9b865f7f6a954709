"""Repeated passages of whole words: seeds are joined across documents and extended both ways.

A passage of at least 13 words that also stands in a document of smaller doc_id is removed. Seeds are the winnowed 5-grams
of words, so every passage of 13 words holds one at the same place in all its documents. Documents meet on seeds; the
extension of a seed is its context, all the words that its 13-word windows can reach. Equal extensions are settled by the
smallest doc_id that has them. Where one seed has several extensions, one document for each extension lists the windows in it
and the windows meet in turn. What remains covered, joined to runs, are the maximal repeats.

Copies meet as equal extensions, not as pairs. Counts, smallest doc_ids and marks are aggregated before they are shuffled.

Defined results: a null or blank text has no words and keeps an empty text. A row without doc_id loses nothing and takes
nothing from others. Rows with one doc_id are one document to each other: they take nothing from each other, and each loses
what documents of smaller doc_id have. A passage that repeats within one document alone stays. Only the needed columns are
read, so other columns, whatever their names, do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverloom.llm.hashing import BASE, grams, mix, pieces, raw, word_hashes, words
from silverloom.llm.repeats import contexts, shared_seeds
from silverloom.llm.seeds import Anchors, anchors, covered, member, runs
from silverloom.llm.ship import ship
from silverloom.llm.tables import settled

WINDOW = 13
SEED = 5
#: Bytes of text that a task looks at together.
SLICE = 1 << 20
_SECOND = 0xD6E8FEB86659FD93


def _hashed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the first word of each row."""
    text, offsets = raw(column)
    starts, ends, rows = words(text, offsets)
    return word_hashes(text, starts, ends), rows


def _longs(*columns: np.ndarray) -> list[pa.Array]:
    return [pa.array(c.view(np.int64) if c.dtype == np.uint64 else c, pa.int64()) for c in columns]


def seeds(docs: DataFrame) -> DataFrame:
    """seed, context, key of every anchor; ``docs`` has key and text."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", SLICE):
            values, rows = _hashed(batch.column("text"))
            a = anchors(values, rows, WINDOW, SEED)
            key = batch.column("key").to_numpy(zero_copy_only=False)[a.row]
            yield pa.RecordBatch.from_arrays(_longs(a.seed, a.context, key.astype(np.int64)), ["seed", "context", "key"])

    return docs.select("key", "text").mapInArrow(find, "seed long, context long, key long")


def _windows_of(a: Anchors, chosen: np.ndarray) -> np.ndarray:
    """The windows of the chosen anchors."""
    count = (a.last - a.first)[chosen]
    return np.repeat(a.first[chosen] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())


def _pair(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of the windows at the given places."""
    return grams(values, WINDOW)[at], grams(mix(values ^ np.uint64(_SECOND)), WINDOW, BASE ^ 0x10)[at]


def open_windows(docs: DataFrame) -> DataFrame:
    """Hashes and key of each window in the open contexts of a row; ``docs`` has key, text and open (contexts)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", SLICE):
            values, rows = _hashed(batch.column("text"))
            a = anchors(values, rows, WINDOW, SEED)
            at = _windows_of(a, _marked(a, batch.column("open")))
            if not len(at):
                continue
            key = batch.column("key").to_numpy()[np.searchsorted(rows, at, side="right") - 1]
            yield pa.RecordBatch.from_arrays(_longs(*_pair(values, at), key), ["one", "two", "key"])

    return docs.select("key", "text", "open").mapInArrow(find, "one long, two long, key long")


def _marked(a: Anchors, lists: pa.Array) -> np.ndarray:
    """The anchors whose context is in the list of their row."""
    out = np.zeros(len(a.at), bool)
    edges = np.searchsorted(a.row, np.arange(len(lists) + 1))
    for i, found in enumerate(lists.to_pylist()):
        if found and edges[i] < edges[i + 1]:
            own = slice(edges[i], edges[i + 1])
            out[own] = member(a.context[own].view(np.int64), np.sort(np.array(found, np.int64)))
    return np.flatnonzero(out)


def _cleaned(text: pa.Array, known: pa.Array, found: pa.Array) -> pa.Array:
    """Each text without the words that marked windows cover."""
    values, rows = _hashed(text)
    lost = np.zeros(len(values), bool)
    any_known = [bool(k) or bool(w) for k, w in zip(known.to_pylist(), found.to_pylist(), strict=True)]
    if any(any_known):
        a = anchors(values, rows, WINDOW, SEED)
        starts = [_windows_of(a, _marked(a, known))]
        hashed = grams(values, WINDOW).view(np.int64)
        for i, list_ in enumerate(found.to_pylist()):
            last = rows[i + 1] - WINDOW + 1
            if list_ and last > rows[i]:
                starts.append(rows[i] + np.flatnonzero(member(hashed[rows[i] : last], np.sort(np.array(list_, np.int64)))))
        lost = covered(len(values), np.concatenate(starts), WINDOW)
    kept, spans = [], []
    for i, t in enumerate(text.to_pylist()):
        own = lost[rows[i] : rows[i + 1]]
        parts = (t or "").encode().split()
        kept.append(b" ".join(compress(parts, ~own) if own.any() else parts).decode())
        spans.append([{"start": int(s), "end": int(e)} for s, e in zip(*runs(own), strict=True)])
    counts = np.diff(rows)
    gone = np.array([lost[rows[i] : rows[i + 1]].sum() for i in range(len(counts))], np.int64)
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    return pa.StructArray.from_arrays(
        [pa.array(counts, pa.int64()), pa.array(gone), pa.array(kept, pa.string()), pa.array(spans, span)],
        ["n_words", "n_removed", "kept", "removed"],
    )


def marks(docs: DataFrame) -> DataFrame:
    """key, known (contexts whose words go) and found (hashes of other windows whose words go)."""
    shared = shared_seeds(seeds(docs))
    groups = contexts(shared)
    held = shared.join(groups.drop("n"), ["seed", "context"])
    by_key = held.groupBy("key").agg(
        F.collect_set(F.when(F.col("key") > F.col("owner"), F.col("context"))).alias("known"),
        F.collect_set(F.when((F.col("key") == F.col("owner")) & F.col("open"), F.col("context"))).alias("open"),
    )
    by_key = settled(by_key, "marks")
    asked = by_key.where(F.size("open") > 0).select("key", "open")
    rows = settled(open_windows(docs.join(asked, "key")), "windows")
    first = rows.groupBy("one", "two").agg(F.min("key").alias("owner"), F.max("key").alias("last")).where("owner < last")
    first = settled(first.drop("last"), "first_windows")
    found = rows.join(first, ["one", "two"]).where("key > owner").groupBy("key").agg(F.collect_set("one").alias("found"))
    return settled(by_key.select("key", "known").join(found, "key", "left"), "word_marks")


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept (words joined by blanks) and removed (spans of word numbers) of every row."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(doc_id).cast("long").alias("key"), F.col(text).alias("text"))
    marked = marks(rows.where("key is not null").select("key", "text"))

    @F.arrow_udf("n_words long, n_removed long, kept string, removed array<struct<start:int,end:int>>")
    def clean(texts: pa.Array, known: pa.Array, found: pa.Array) -> pa.Array:
        table = pa.RecordBatch.from_arrays([texts, known, found], ["text", "known", "found"])
        parts = [_cleaned(*part.columns) for part in pieces(iter([table]), "text", SLICE)]
        return pa.concat_arrays(parts) if parts else _cleaned(texts, known, found)

    done = rows.join(marked, "key", "left").select("doc_id", clean("text", "known", "found").alias("r"))
    return done.select("doc_id", "r.n_words", "r.n_removed", "r.kept", "r.removed")
