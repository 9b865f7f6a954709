"""Repeated passages of words and of bytes against plain Python."""

import hashlib
import os
import random
import sys
from collections import Counter

import numpy as np

sys.path.insert(0, os.path.dirname(__file__))

from cases import documents, texts  # noqa: E402

from silverloom.llm import hashing, induced, seeds, substring_dedup, suffix_dedup  # noqa: E402
from silverloom.llm.queries.op4 import op4_substring_dedup  # noqa: E402
from silverloom.llm.queries.op8 import op8_suffix_array_dedup  # noqa: E402


def words_kept(rows, size=13):
    """For each row: words, words kept and spans."""
    split = [(i, (t or "").encode().split()) for i, t, *_ in rows]
    first = {}
    for i, w in split:
        for k in range(len(w) - size + 1):
            if i is not None:
                key = tuple(w[k : k + size])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if i is not None and first[tuple(w[k : k + size])] < i:
                gone[k : k + size] = [True] * size
        out.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode()))
    return out


def bytes_kept(rows, size=400):
    data = [(i, (t or "").encode()) for i, t, *_ in rows]
    seen = Counter(b[k : k + size] for _, b in data for k in range(len(b) - size + 1))
    out = []
    for i, b in data:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - size + 1):
            if seen[b[k : k + size]] > 1:
                gone[k : k + size] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((i, len(b), int(gone.sum()), spans, bytes(np.frombuffer(b, np.uint8)[~gone])))
    return out


def ordered(rows):
    return sorted(rows, key=repr)


def test_words(spark):
    found = substring_dedup.remove_repeats(documents(spark)).collect()
    want = words_kept(texts())
    assert ordered((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in found) == ordered(want)
    assert sum(w[2] for w in want) > 500
    for r in found:
        assert sum(s["end"] - s["start"] for s in r["removed"]) == r["n_removed"]


def test_bytes(spark):
    found = suffix_dedup.remove_repeats(documents(spark)).collect()
    want = bytes_kept(texts())
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], len(r["removed"]), bytes(r["kept"])) for r in found]
    assert ordered(got) == ordered(want)
    assert sum(w[2] for w in want) > 3000


def test_many_contexts_of_one_passage(spark):
    """Passages cut at every place, so that seeds have many extensions."""
    rng = random.Random(8)
    long = [rng.choice(["wa", "ke", "no", "ti"]) + str(rng.randint(0, 50)) for _ in range(300)]
    rows = []
    for i in range(60):
        a, b = sorted(rng.sample(range(300), 2))
        rows.append((i, " ".join([f"u{i}", *long[a:b], f"v{i}"]), "en", "s"))
    found = substring_dedup.remove_repeats(documents(spark, rows)).collect()
    assert ordered((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in found) == ordered(words_kept(rows))
    found = suffix_dedup.remove_repeats(documents(spark, rows)).collect()
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], len(r["removed"]), bytes(r["kept"])) for r in found]
    assert ordered(got) == ordered(bytes_kept(rows))


def test_empty_table(spark):
    assert substring_dedup.remove_repeats(documents(spark, [])).count() == 0
    assert suffix_dedup.remove_repeats(documents(spark, [])).count() == 0


def test_queries_on_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    sha = lambda b: hashlib.sha256(b).hexdigest()
    found = op4_substring_dedup(spark, sf).collect()
    assert ordered(tuple(r) for r in found) == ordered((*w[:3], sha(w[3].encode())) for w in words_kept(rows))
    found = op8_suffix_array_dedup(spark, sf).collect()
    assert ordered(tuple(r) for r in found) == ordered((*w[:4], sha(w[4])) for w in bytes_kept(rows))


def test_long_rows_are_cut_into_overlapping_pieces(monkeypatch):
    rng = np.random.default_rng(1)
    values = hashing.byte_values(rng.integers(0, 4, 3000).astype(np.uint8))
    rows = np.array([0, 10, 2500, 2500, 3000])
    whole = seeds.anchors(values, rows, 40, 12)
    monkeypatch.setattr(seeds, "_PIECE", 300)
    parts = seeds.anchors(values, rows, 40, 12)
    for name in ("at", "row", "seed", "context", "first", "last"):
        assert (getattr(whole, name) == getattr(parts, name)).all()


def test_induced_sorting(monkeypatch):
    rng = np.random.default_rng(2)
    for _ in range(150):
        monkeypatch.setattr(induced, "BLOCK", int(rng.choice([2, 7, 1 << 18])))
        monkeypatch.setattr(induced, "HELD", int(rng.choice([1, 5, 1 << 16])))
        strings, letters = [], int(rng.integers(1, 5))
        for _ in range(int(rng.integers(1, 12))):
            s = rng.integers(1, letters + 1, int(rng.integers(0, 40))).tolist()
            s.insert(int(rng.integers(0, len(s) + 1)), induced.NAMES + int(rng.integers(0, 3)))
            strings.append([*s, 0])
        text, depth = np.array([x for s in strings for x in s], np.int32), int(rng.integers(1, 12))
        plain = text.tolist()
        seen = Counter(tuple(plain[i : i + depth]) for i in range(len(plain)))
        hit = induced.repeated(text, depth)
        for i in range(len(plain) - depth + 1):
            window = tuple(plain[i : i + depth])
            if 0 not in window:
                assert hit[i] == (seen[window] > 1)
