"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1, drawn from its code point. A trigram is bound: the first letter's vector
permuted twice, times the second's permuted once, times the third's. A document bundles the vectors of its trigrams by
summing them; a language's prototype bundles its training documents, each with the same weight. All vectors have the mean
prototype taken off, which holds what the languages share. A document has the language whose prototype has the largest
cosine with it.

Letters are those of any script, without case; all other characters, runs of them as one, count as one blank, and a word
begins and ends with a blank. Profiles are fitted on about ``MOST_PER_LANGUAGE`` distinct labelled texts of each language, or all
where there are fewer, chosen by the hash of the text; copies count once. Every document is predicted, from its whole text.

Defined results: a text that is null or has no letter is ``und`` with score 0, as is every text where nothing could be learned.
Ties go to the first language by name. Null labels teach nothing. Rows are independent of each other; repeated rows, other
columns and their names do not matter. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverloom.llm.hashing import mix
from silverloom.llm.ship import ship

UNKNOWN = "und"
DIMENSIONS = 1024
MOST_PER_LANGUAGE = 4000
#: Letters and trigrams that are looked at together.
LETTERS, TRIGRAMS = 1 << 18, 1 << 12
_BLANK = 32
_letter: np.ndarray | None = None


def _letters() -> np.ndarray:
    """For every code point: is it a letter."""
    global _letter
    if _letter is None:
        _letter = np.array([chr(c).isalpha() for c in range(0x110000)])
    return _letter


def symbols(text: str) -> np.ndarray:
    """The letters of a text with single blanks between and around the words; empty without letters."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where(_letters()[points], points, _BLANK).astype(np.uint32)
    points = np.concatenate([[_BLANK], points, [_BLANK]]).astype(np.uint32)
    return points[np.concatenate([[True], (points[1:] != _BLANK) | (points[:-1] != _BLANK)])]


def letter_bits(points: np.ndarray, dimensions: int) -> np.ndarray:
    """The random vector of each code point, a bit for each -1, packed in 64-bit words."""
    words = np.arange(dimensions // 64, dtype=np.uint64)
    return mix(mix(points.astype(np.uint64) + np.uint64(0x51ED2701))[:, None] + words * np.uint64(0x9E3779B97F4A7C15))


def trigram_vectors(trigrams: np.ndarray, dimensions: int) -> np.ndarray:
    """Bound vectors, as +1 and -1, of trigrams packed at 21 bits a letter."""
    mask = np.uint64(0x1FFFFF)
    bits = None
    for place, turns in ((42, 2), (21, 1), (0, 0)):
        points, back = np.unique((trigrams >> np.uint64(place)) & mask, return_inverse=True)
        own = np.unpackbits(letter_bits(points, dimensions).view(np.uint8).reshape(len(points), -1), axis=1)
        own = np.packbits(np.roll(own, turns, axis=1), axis=1)[back]
        bits = own if bits is None else bits ^ own
    return 1 - 2 * np.unpackbits(bits, axis=1).astype(np.float32)


def bundles(texts: list[str | None], dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """The bundle of each text, divided by its number of trigrams, and that number."""
    out, counts = np.zeros((len(texts), dimensions)), np.zeros(len(texts), np.int64)
    keys, weights, owners = [], [], []
    for i, text in enumerate(texts):
        found = symbols(text or "").astype(np.uint64)
        if len(found) < 3:
            continue
        trigrams = (found[:-2] << np.uint64(42)) | (found[1:-1] << np.uint64(21)) | found[2:]
        key, weight = np.unique(trigrams, return_counts=True)
        counts[i] = len(trigrams)
        keys.append(key)
        weights.append(weight / len(trigrams))
        owners.append(np.full(len(key), i))
    if keys:
        owner, weight = np.concatenate(owners), np.concatenate(weights)
        distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
        order = np.argsort(place, kind="stable")
        edges = np.searchsorted(place[order], np.arange(0, len(distinct) + TRIGRAMS, TRIGRAMS))
        for block in range(len(edges) - 1):
            own = order[edges[block] : edges[block + 1]]
            low = block * TRIGRAMS
            part = np.zeros((len(texts), min(TRIGRAMS, len(distinct) - low)), np.float32)
            part[owner[own], place[own] - low] = weight[own]
            out += part @ trigram_vectors(distinct[low : low + TRIGRAMS], dimensions)
    return out, counts


def _groups(column: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """Runs of texts of about LETTERS bytes together, and where they begin."""
    at = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))])
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(at, at[i] + LETTERS, side="right")) - 1)
        yield i, column.slice(i, j - i).to_pylist()
        i = j


@dataclass
class Profiles:
    """The languages and their prototypes (unit length, mean taken off)."""

    languages: list[str]
    prototypes: np.ndarray
    mean: np.ndarray


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", dimensions: int = DIMENSIONS, most: int = MOST_PER_LANGUAGE) -> Profiles:
    """Learn prototypes from the labelled rows of ``docs``."""
    ship(docs.sparkSession)
    labelled = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text is not null and lang is not null")
    distinct = labelled.select("lang", F.xxhash64("text", F.lit("profile")).alias("h")).distinct()
    rates = distinct.groupBy("lang").agg((F.lit(float(most)) / F.count(F.lit(1))).alias("rate"))
    chance = F.pmod(F.xxhash64("text", F.lit("profile")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    chosen = labelled.join(F.broadcast(rates), "lang").where(chance < F.col("rate")).select("lang", "text").distinct()

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[str, np.ndarray] = {}
            names = batch.column("lang").to_pylist()
            for start, texts in _groups(batch.column("text")):
                found, counts = bundles(texts, dimensions)
                for name, vector, n in zip(names[start : start + len(texts)], found, counts, strict=True):
                    if n:
                        sums[name] = sums.get(name, 0) + np.append(vector, 1.0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.string()), pa.array([s.tolist() for s in sums.values()], pa.list_(pa.float64()))],
                ["lang", "sums"],
            )

    parts = chosen.mapInArrow(bundle, "lang string, sums array<double>")
    total = parts.select("lang", F.posexplode("sums")).groupBy("lang", "pos").agg(F.sum("col").alias("v")).collect()
    languages = sorted({r["lang"] for r in total})
    table = np.zeros((len(languages), dimensions + 1))
    at = {name: i for i, name in enumerate(languages)}
    for r in total:
        table[at[r["lang"]], r["pos"]] = r["v"]
    means = table[:, :-1] / table[:, -1:] if languages else table[:, :-1]
    mean = means.mean(0) if len(languages) > 1 else np.zeros(dimensions)
    centred = means - mean
    return Profiles(languages, centred / np.maximum(np.linalg.norm(centred, axis=1, keepdims=True), 1e-12), mean)


def predict(text: Column, profiles: Profiles) -> Column:
    """Struct of lang_pred and score, the cosine where it is positive.

    It counts as non-deterministic for Spark alone: a filter on it is not copied below, where it would be a second evaluation
    and a second Python worker for each task, whose memory stays.
    """
    dimensions = profiles.prototypes.shape[1]

    @F.arrow_udf("lang_pred string, score double")
    def named(column: pa.Array) -> pa.Array:
        names, scores = [], []
        for _, texts in _groups(column):
            found, counts = bundles(texts, dimensions)
            if not profiles.languages:
                counts[:] = 0
            centred = found - profiles.mean
            cosine = centred @ profiles.prototypes.T / np.maximum(np.linalg.norm(centred, axis=1, keepdims=True), 1e-12)
            for row, n in zip(cosine, counts, strict=True):
                best = int(row.argmax()) if n else -1
                names.append(profiles.languages[best] if n else UNKNOWN)
                scores.append(float(min(1.0, max(0.0, row[best]))) if n else 0.0)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    return named.asNondeterministic()(text)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that teach nothing: a fifth, by the checksum of doc_id. A null doc_id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))
