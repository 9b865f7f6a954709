"""Periodic runs of words against plain Python."""

import hashlib
import os
import random
import re
import sys
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

sys.path.insert(0, os.path.dirname(__file__))

from cases import documents, texts  # noqa: E402

from silverloom.llm import periodic_runs  # noqa: E402
from silverloom.llm.periodic_runs import Positions, kept_words, runs_of, with_runs  # noqa: E402
from silverloom.llm.queries.op13 import looped, op13_periodic_runs  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words):
    """Every period on its own: stretches in which words q apart are equal, unless a smaller period holds there."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            part = words[i : i + length]
            smaller = any(all(part[k] == part[k + p] for k in range(length - p)) for p in range(1, q))
            if length >= max(12, 2 * q) and not smaller:
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_kept(words, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def plain_looped(doc_id, text):
    words = WORD.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    return words


def plain_row(doc_id, text):
    words = plain_looped(doc_id, text)
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    digest = [hashlib.sha256(t.encode()).hexdigest() for t in ("".join(f"{s},{n},{q}\n" for s, n, q in runs), plain_kept(words, runs))]
    own = [*best, 1000 * best[1] // best[2]] if best else [None] * 4
    return (doc_id, len(runs), *own, *digest)


def test_neighbours_of_one_class():
    """A period of 30 that ends inside one of 25: pairs that meet again in a larger class keep their own prefix."""
    words = [i % 30 for i in range(78)] + [18 + i % 25 for i in range(72)]
    assert runs_of(np.array(words)) == plain_runs(words)


@settings(max_examples=120, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.integers(1, 4))
def test_small_alphabets(letters, copies):
    words = letters * copies
    runs = runs_of(np.array(words, np.int64))
    assert runs == plain_runs(words)
    assert " ".join(str(w) for w, k in zip(words, kept_words(len(words), runs), strict=True) if k) == plain_kept(list(map(str, words)), runs)


@pytest.mark.parametrize("words", [[1] * 400, [0, 1] * 200, [0, 1, 0] * 120 + [1] * 30, list(range(40)) * 9, [5] * 11, [5] * 12])
def test_long_runs(words):
    assert runs_of(np.array(words)) == plain_runs(words)


def test_fibonacci_words():
    a, b = [0], [0, 1]
    while len(b) < 200:
        a, b = b, b + a
    assert runs_of(np.array(b)) == plain_runs(b)


def test_ordered_positions(monkeypatch):
    monkeypatch.setattr(periodic_runs, "BLOCK", 3)
    rng, own, seen = random.Random(3), Positions(500), [500]
    for x in rng.sample([i for i in range(1000) if i != 500], 400):
        before, after = own.add(x)
        assert before == max((s for s in seen if s < x), default=None)
        assert after == min((s for s in seen if s > x), default=None)
        seen.append(x)
    assert list(own) == sorted(seen) and own.size == 401 and max(map(len, own.blocks)) <= 6


def test_awkward_rows(spark):
    found = with_runs(documents(spark)).select("doc_id", "text", "periodic").collect()
    assert len(found) == len(texts())
    for r in found:
        words = WORD.findall(r["text"] or "")
        runs = [tuple(x) for x in r["periodic"]["runs"]]
        assert r["periodic"]["n_words"] == len(words)
        if len(words) < 500:
            assert runs == plain_runs(words)
        assert r["periodic"]["collapsed"] == plain_kept(words, runs)


def test_small_slices(spark, monkeypatch):
    monkeypatch.setattr(periodic_runs, "SLICE", 50)
    column = documents(spark).toArrow().column("text").combine_chunks()
    from silverloom.llm.hashing import pieces

    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([column], ["text"])
    whole = periodic_runs._struct(column).to_pylist()
    assert whole == [x for p in pieces(iter([batch]), "text", 50) for x in periodic_runs._struct(p.column(0)).to_pylist()]


def test_empty_table(spark):
    empty = documents(spark).limit(0)
    assert with_runs(empty).select("periodic").collect() == []


def test_looped_texts(spark):
    rows = {r["doc_id"]: r["text"] for r in looped(documents(spark).where("doc_id >= 6 and doc_id < 200").distinct()).collect()}
    own = {r[0]: r[1] for r in texts() if r[0] is not None}
    for i, text in rows.items():
        assert WORD.findall(text) == plain_looped(i, own[i])


def test_query_on_the_given_documents(spark):
    folder = "/root/testdata/sf0.001"
    found = op13_periodic_runs(spark, folder).collect()
    want = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert len(found) == len(want) and any(r["n_runs"] for r in found)
    for r in found:
        if len(want[r["doc_id"]]) < 4_000:
            assert tuple(r) == plain_row(r["doc_id"], want[r["doc_id"]])
