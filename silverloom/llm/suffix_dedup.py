"""Repeated byte strings, within and across documents: recursive naming in Spark, external induced sorting in each shard.

Every byte that a 400-byte string covers which begins anywhere else too is removed. The first level of the recursion names
long substrings: of every 400-byte window the 304-byte gram of least hash, its anchor. Equal windows have equal anchors, so a
window whose anchor is alone is alone. Anchors meet by their hash; an anchor that occurs twice with the same context (all
bytes that its windows reach) settles all of its windows. What is left are anchors with several contexts. Each context becomes
a short string of the bytes before the anchor, the name of the anchor as one symbol, and the bytes behind it, in which a
window of 400 bytes is one of 97 symbols. The strings of an anchor go to one shard; a shard's text is written to disk, its
suffixes are ordered by external induced sorting with their common prefixes (see ``induced``), and windows with a common
prefix of 97 symbols are repeats.

Anchors, contexts and marks are narrow rows that Spark shuffles, aggregated before they are. A context that any number of
copies has is one string, so a hot passage does not make a hot shard.

Defined results: a null or empty text has no bytes and keeps none. Repeated rows repeat their strings, so texts of 400 bytes
and more that stand twice lose all. doc_id, null or not, plays no part. Matches do not cross rows. Only the text is read.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverloom.llm.hashing import byte_values, pieces, raw
from silverloom.llm.induced import NAMES, repeated
from silverloom.llm.repeats import contexts, shared_seeds
from silverloom.llm.seeds import Anchors, anchors, member, runs
from silverloom.llm.ship import ship
from silverloom.llm.tables import settled

WINDOW = 400
SEED = 304
DEPTH = WINDOW - SEED + 1
SLICE = 1 << 20
#: Symbols of a shard, on average. The number of shards grows with the text, and a shard may be many times larger.
SHARD = 1 << 22


def _anchors(column: pa.Array) -> tuple[np.ndarray, np.ndarray, Anchors]:
    text, offsets = raw(column)
    return text, offsets, anchors(byte_values(text), offsets, WINDOW, SEED)


def seeds(docs: DataFrame) -> DataFrame:
    """seed, context, key of every anchor; ``docs`` has key and text."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", SLICE):
            _, _, a = _anchors(batch.column("text"))
            key = batch.column("key").take(pa.array(a.row))
            columns = [pa.array(a.seed.view(np.int64)), pa.array(a.context.view(np.int64)), key]
            yield pa.RecordBatch.from_arrays(columns, ["seed", "context", "key"])

    return docs.select("key", "text").mapInArrow(find, "seed long, context long, key long")


def _marked(a: Anchors, lists: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """Row and anchors of the contexts that the row's list has."""
    edges = np.searchsorted(a.row, np.arange(len(lists) + 1))
    for i, found in enumerate(lists.to_pylist()):
        if found and edges[i] < edges[i + 1]:
            own = a.context[edges[i] : edges[i + 1]].view(np.int64)
            yield i, edges[i] + np.flatnonzero(member(own, np.sort(np.array(found, np.int64))))


def open_strings(docs: DataFrame) -> DataFrame:
    """seed, context, before, behind and the least and greatest distance of a window's begin from the anchor."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", SLICE):
            text, _, a = _anchors(batch.column("text"))
            at = [x for _, x in _marked(a, batch.column("open"))]
            at = np.concatenate(at) if at else np.empty(0, np.int64)
            data = text.tobytes()
            place, first, last = a.at[at], a.first[at], a.last[at] - 1
            before = [data[f:p] for f, p in zip(first, place, strict=True)]
            behind = [data[p + SEED : f + WINDOW] for f, p in zip(last, place, strict=True)]
            columns = [pa.array(a.seed[at].view(np.int64)), pa.array(a.context[at].view(np.int64)), pa.array(before, pa.binary())]
            columns += [pa.array(behind, pa.binary()), pa.array((place - last).astype(np.int32)), pa.array((place - first).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["seed", "context", "before", "behind", "least", "most"])

    kind = "seed long, context long, before binary, behind binary, least int, most int"
    return docs.select("text", "open").mapInArrow(find, kind)


def repeated_windows(strings: DataFrame) -> DataFrame:
    """seed, context and the distances from the anchor at which repeated windows begin. Each context stands once in ``strings``."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size = [], 0
        with tempfile.TemporaryFile() as shard:
            for batch in batches:
                before, behind = (batch.column(c).to_pylist() for c in ("before", "behind"))
                lengths = np.array([[len(x), len(y)] for x, y in zip(before, behind, strict=True)], np.int64).reshape(-1, 2)
                ends = np.cumsum(lengths.sum(1) + 2)
                symbols = np.frombuffer(b"".join(x + b"\0" + y + b"\0" for x, y in zip(before, behind, strict=True)), np.uint8) + np.int32(1)
                names = ends - lengths[:, 1] - 2
                symbols[ends - 1] = 0
                symbols[names] = -1
                shard.write(symbols.tobytes())
                columns = (batch.column(c).to_numpy() for c in ("seed", "context", "least", "most"))
                kept.append((*columns, names + size, names - lengths[:, 0] + size))
                size += len(symbols)
            if not size:
                return
            shard.flush()
            text = np.memmap(shard, np.int32, "r+", shape=(size,))
            seed, context, least, most, name, start = (np.concatenate(x) for x in zip(*kept, strict=True))
            text[name] = NAMES + np.unique(seed, return_inverse=True)[1]
            hit = repeated(text, DEPTH)
            for low in range(0, len(seed), 10_000):
                own = range(low, min(low + 10_000, len(seed)))
                found = [most[i] - np.flatnonzero(hit[start[i] : start[i] + most[i] - least[i] + 1]) for i in own]
                some = np.array([i for i, f in zip(own, found, strict=True) if len(f)], np.int64)
                lists = pa.array([f.astype(np.int32) for f in found if len(f)], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array(seed[some]), pa.array(context[some]), lists], ["seed", "context", "distances"])

    size = strings.agg(F.sum(F.octet_length("before") + F.octet_length("behind") + 2)).first()[0] or 0
    shards = -(-size // SHARD) or 1
    return strings.repartition(shards, "seed").mapInArrow(sort, "seed long, context long, distances array<int>")


def marks(docs: DataFrame) -> DataFrame:
    """key, known (contexts all of whose windows repeat) and found (other contexts, with distances of windows that do)."""
    shared = shared_seeds(settled(seeds(docs), "anchors"))
    groups = contexts(shared)
    held = shared.join(groups, ["seed", "context"])
    by_key = held.groupBy("key").agg(
        F.collect_set(F.when(F.col("n") > 1, F.col("context"))).alias("known"),
        F.collect_set(F.when((F.col("key") == F.col("owner")) & F.col("open"), F.col("context"))).alias("open"),
    )
    by_key = settled(by_key, "marks")
    strings = open_strings(docs.join(by_key.where(F.size("open") > 0).select("key", "open"), "key"))
    values = [F.first(c).alias(c) for c in ("before", "behind", "least", "most")]
    strings = settled(strings.groupBy("seed", "context").agg(*values), "strings")
    found = settled(repeated_windows(strings), "repeated")
    alone = groups.where("n = 1").select("seed", "context", F.col("owner").alias("key"))
    found = alone.join(found, ["seed", "context"]).groupBy("key").agg(F.collect_list(F.struct("context", "distances")).alias("found"))
    return settled(by_key.select("key", "known").join(found, "key", "left"), "byte_marks")


def _cleaned(text: pa.Array, known: pa.Array, found: pa.Array) -> pa.Array:
    """Each text without the bytes that repeated windows cover."""
    data, offsets = raw(text)
    more = found.to_pylist()
    step = np.zeros(len(data) + 1, np.int32)
    if any(more) or any(known.to_pylist()):
        a = anchors(byte_values(data), offsets, WINDOW, SEED)
        for _, at in _marked(a, known):
            np.add.at(step, a.first[at], 1)
            np.add.at(step, a.last[at] - 1 + WINDOW, -1)
        edges = np.searchsorted(a.row, np.arange(len(more) + 1))
        for i, rows in enumerate(more):
            if rows:
                own = a.context[edges[i] : edges[i + 1]].view(np.int64)
                place = dict(zip(own.tolist(), a.at[edges[i] : edges[i + 1]].tolist(), strict=True))
                starts = [place[r["context"]] - np.array(r["distances"], np.int64) for r in rows if r["context"] in place]
                for s in starts:
                    np.add.at(step, s, 1)
                    np.add.at(step, s + WINDOW, -1)
    lost = np.cumsum(step)[:-1] > 0
    kept, spans, gone = [], [], []
    for i in range(len(text)):
        own, part = lost[offsets[i] : offsets[i + 1]], data[offsets[i] : offsets[i + 1]]
        n = int(np.count_nonzero(own))
        gone.append(n)
        kept.append((part[~own] if n else part).tobytes())
        spans.append([{"start": int(s), "end": int(e)} for s, e in zip(*runs(own), strict=True)] if n else [])
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.StructArray.from_arrays(
        [pa.array(np.diff(offsets)), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()), pa.array(spans, span)],
        ["n_bytes", "n_removed", "kept", "removed"],
    )


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, kept (bytes) and removed (maximal spans) of every row."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("key"), F.col(text).alias("text"))
    marked = marks(rows.where("text is not null").select("key", "text"))

    @F.arrow_udf("n_bytes long, n_removed long, kept binary, removed array<struct<start:long,end:long>>")
    def clean(texts: pa.Array, known: pa.Array, found: pa.Array) -> pa.Array:
        table = pa.RecordBatch.from_arrays([texts, known, found], ["text", "known", "found"])
        parts = [_cleaned(*part.columns) for part in pieces(iter([table]), "text", SLICE)]
        return pa.concat_arrays(parts) if parts else _cleaned(texts, known, found)

    done = rows.join(marked, "key", "left").select("doc_id", clean("text", "known", "found").alias("r"))
    return done.select("doc_id", "r.n_bytes", "r.n_removed", "r.kept", "r.removed")
