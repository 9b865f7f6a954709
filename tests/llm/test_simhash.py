"""Fingerprints and groups against all pairs."""

import os
import random
import sys

import xxhash
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

from cases import documents, sentence, texts  # noqa: E402

from silverloom.llm import simhash  # noqa: E402
from silverloom.llm.components import connected_components  # noqa: E402
from silverloom.llm.queries.op9 import op9_simhash  # noqa: E402


def plain_fingerprint(text):
    data = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    words = data.split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    values = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(v >> k & 1 for v in values) > len(values))


def groups(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprints_and_groups(spark, monkeypatch):
    found = simhash.near_duplicates(documents(spark)).collect()
    rows = texts()
    want = {(i, t): plain_fingerprint(t) for i, t, *_ in rows}
    assert sorted(r["bits"] % 2**64 for r in found) == sorted(plain_fingerprint(t) for _, t, *_ in rows)
    known = [(i, f) for (i, _), f in want.items() if i is not None]
    linked = groups([(a, b) for a, x in known for b, y in known if (x ^ y).bit_count() <= 2], [i for i, _ in known])
    assert all(r["component_id"] == (None if r["doc_id"] is None else linked[r["doc_id"]]) for r in found)
    monkeypatch.setattr(simhash, "PART", 30)
    assert all(simhash.fingerprint_of((t or "").encode()) == f for (_, t), f in want.items())


def test_texts_of_one_document(spark):
    """0 and 2 are linked through the two texts of document 1; repeated rows change nothing."""
    a, b, c = (sentence(random.Random(n), "en", 40) for n in (1, 2, 3))
    rows = [(0, b), (1, a), (1, b), (1, b), (2, a), (3, c), (3, ""), (3, None), (4, " "), (5, "alone"), (None, a)]
    found = simhash.near_duplicates(documents(spark, [(*r, "en", "s") for r in rows])).select("doc_id", "component_id").distinct().collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {0: 0, 1: 0, 2: 0, 3: 3, 4: 3, 5: 5, None: None}


def test_no_pair_is_missed(spark):
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(60)]
    bits = set(base)
    for b in base:
        for k in (1, 2, 3):
            x = b
            for place in rng.sample(range(64), k):
                x ^= 1 << place
            bits.add(x)
    nodes = list(enumerate(sorted(bits)))
    df = spark.createDataFrame([(i, b - 2**64 if b >= 2**63 else b) for i, b in nodes], "node long, bits long")
    found = {(min(r["a"], r["b"]), max(r["a"], r["b"])) for r in simhash.linked_fingerprints(df).collect()}
    assert found == {(i, j) for i, x in nodes for j, y in nodes if i < j and (x ^ y).bit_count() <= 2}


def test_keys_are_not_broadcast(spark, plan):
    """The keys are 32 times the fingerprints that Spark sizes them by."""
    nodes = spark.range(1000).select(F.xxhash64("id").alias("bits"), F.col("id").alias("node"))
    assert "Broadcast" not in plan(simhash.linked_fingerprints(nodes))


def test_components(spark):
    rng = random.Random(6)
    pairs = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 40)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(50)]
    df = spark.createDataFrame([*pairs, (7, 7), (None, 3)], "a long, b long")
    found = {r["node"]: r["component"] for r in connected_components(df).collect()}
    nodes = {x for p in pairs if p[0] != p[1] for x in p}
    assert found == groups([p for p in pairs if p[0] != p[1]], nodes)
    assert connected_components(df.where("a < 0")).count() == 0


def test_empty_and_query(spark):
    assert simhash.near_duplicates(documents(spark, [])).count() == 0
    found = op9_simhash(spark, "/root/testdata/sf0.001")
    assert found.count() == 200 and found.where(F.length("fingerprint") != 16).count() == 0
