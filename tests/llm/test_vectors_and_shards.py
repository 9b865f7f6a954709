"""Near-duplicate vectors against all pairs, shards against their law, the pipeline against its stages."""

import os
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

from cases import documents, texts  # noqa: E402

import corpus_pipeline  # noqa: E402
from silverloom.llm import pq_dedup, sharding  # noqa: E402
from silverloom.llm.queries.op5 import op5_pq_dedup  # noqa: E402
from silverloom.llm.queries.op10 import op10_sharding  # noqa: E402


def all_pairs(ids, x):
    """Links and smallest reachable id of each vector."""
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    label = np.array(ids)
    while True:
        new = np.array([min([label[i], *label[near[i]]]) for i in range(len(ids))])
        if (new == label).all():
            return near.sum(1), label
        label = new


def clustered(rng, n, d=32):
    centres = rng.normal(size=(n // 8, d))
    return centres[rng.integers(0, len(centres), n)] + rng.normal(size=(n, d)) * rng.choice([0.0, 0.1, 0.25, 1.0], (n, 1))


def test_recall_and_groups(spark, monkeypatch):
    monkeypatch.setattr(pq_dedup, "BLOCK", 16)
    rng = np.random.default_rng(5)
    x = clustered(rng, 900)
    x[:60] = x[0] + rng.normal(size=(60, 32)) * 0.05  # one large group
    links, component = all_pairs(range(900), x)
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, n int")
    found = sorted(pq_dedup.near_duplicates(df).collect(), key=lambda r: r["vec_id"])
    assert len(found) == 900
    got = np.array([r["n_links"] for r in found])
    assert (got <= links).all() and got.sum() >= 0.99 * links.sum() and links.sum() > 4000
    assert np.mean([r["component_id"] for r in found] == component) > 0.98


def test_vectors_of_several_lengths(spark, monkeypatch):
    """Every length is compared within itself, also those shorter and longer than the index's width."""
    monkeypatch.setattr(pq_dedup, "BLOCK", 16)
    rng = np.random.default_rng(7)
    parts = [clustered(rng, n, d) for n, d in ((400, 12), (160, 3), (160, 30), (16, 1))]
    parts[2][:8, :20] = 0  # nothing in the components that the index sees
    rows, links, component = [], [], []
    for x in parts:
        ids = range(len(rows), len(rows) + len(x))
        near, label = all_pairs(ids, x)
        rows += [(i, v.tolist()) for i, v in zip(ids, x, strict=True)]
        links += near.tolist()
        component += label.tolist()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sorted(pq_dedup.near_duplicates(df).collect(), key=lambda r: r["vec_id"])
    got, links = np.array([r["n_links"] for r in found]), np.array(links)
    assert (got <= links).all() and got.sum() >= 0.99 * links.sum() and all(links[i : i + 16].any() for i in (0, 400, 560, 720))
    assert np.mean([r["component_id"] for r in found] == np.array(component)) > 0.98


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (3, [0.0, 1.0, 0.0]), (4, None), (5, []), (6, [0.0, 0.0, 0.0]), (7, [nan, 1.0, 0.0]),
        (8, [inf, 0.0, 0.0]), (9, [None, 1.0, 0.0]), (10, [1.0, 0.0]), (13, [3.0, 0.0]), (14, [1.0, 0.0, 0.0, 0.0]), (15, [1.0]), (None, [1.0, 0.0, 0.0]), (3, [0.0, 1.0, 0.0]), (11, [1e-200, 0.0, 1e-201]),
        (12, [1e200, 0.0, 0.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in pq_dedup.near_duplicates(df).collect()), key=repr)
    alone = [(i, 0, i) for i in (4, 5, 6, 7, 8, 9, 14, 15)]
    want = [(1, 3, 1), (2, 3, 1), (11, 3, 1), (12, 3, 1), (3, 1, 3), (3, 1, 3), (10, 1, 10), (13, 1, 10), (None, 0, None), *alone]
    assert found == sorted(want, key=repr)
    assert pq_dedup.near_duplicates(df.where("vec_id in (4, 5)")).count() == 2
    assert pq_dedup.near_duplicates(df.limit(0)).count() == 0


def test_embeddings(spark):
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    links, component = all_pairs([r["vec_id"] for r in rows], np.array([r["embedding"] for r in rows], float))
    found = sorted(op5_pq_dedup(spark, sf).collect(), key=lambda r: r["vec_id"])
    assert [r["n_links"] for r in found] == links.tolist() and [r["component_id"] for r in found] == component.tolist()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found)


def shards_of(df, count):
    return sharding.balanced_shards(sharding.measured(df), count)


def check_law(rows, count):
    held = defaultdict(list)
    for r in rows:
        held[r["shard"]].append(r["slot"])
    sizes = [len(held[s]) for s in range(count)]
    assert max(sizes) - min(sizes) <= 1 and set(held) <= set(range(count))
    assert all(sorted(v) == list(range(len(v))) for v in held.values())


def test_shards(spark, monkeypatch):
    rows = texts() + [(1000 + i, "copy", "en", "s") for i in range(90)] + [(2000 + i, f"pair {i // 3}", "en", "s") for i in range(60)]
    for heavy in (1_000, 5):
        monkeypatch.setattr(sharding, "HEAVY", heavy)
        found = shards_of(documents(spark, rows), 7).collect()
        check_law(found, 7)
        whole = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
        assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == whole
        groups = defaultdict(list)
        for r in found:
            groups[r["text_crc32"]].append(r["shard"])
        small = [Counter(v) for v in groups.values() if 1 < len(v) < 10]
        assert sum(max(c.values()) for c in small) > 0.6 * sum(sum(c.values()) for c in small)


def test_few_rows_and_none(spark):
    check_law(shards_of(documents(spark, texts()[:3]), 40).collect(), 40)
    assert shards_of(documents(spark, []), 40).count() == 0


def test_propagation_beats_the_start(spark):
    rows = sharding.measured(documents(spark, [(i, f"text {i // 4}", "en", "s") for i in range(400)]))
    cut = sharding.cut_links(sharding.balanced_shards(rows, 8)).first()
    start = sharding.cut_links(sharding.balanced_shards(rows, 8, rounds=0)).first()
    assert cut["linked"] == 400 and cut["cut"] < 0.5 * start["cut"]


def test_query_of_shards(spark):
    found = op10_sharding(spark, "/root/testdata/sf0.01").collect()
    assert len(found) == 1000 and {r["law"] for r in found} == {"rows"}
    check_law(found, 40)


def test_pipeline_stages(spark):
    """Each stage does what its operator decides, on awkward rows too."""
    sf = "/root/testdata/sf0.001"
    docs = documents(spark)
    columns = docs.columns
    named = corpus_pipeline.language_id(spark, docs, sf)
    assert named.columns == columns and named.where("lang is null").count() == 0
    lettered = [t for _, t, *_ in texts() if any(c.isalpha() for c in t or "")]
    assert 0.9 * len(lettered) <= named.count() <= len(lettered)
    lines = corpus_pipeline.line_dedup(spark, docs, sf)
    assert lines.columns == columns and lines.count() == docs.count()
    assert lines.where("text is not null and n_chars <> length(text)").count() == 0
    single = corpus_pipeline.simhash(spark, docs, sf)
    rows = [(r["doc_id"], r["text"]) for r in single.collect()]
    ids = Counter(i for i, _ in rows)
    assert single.columns == columns and len(set(rows)) == len(rows)
    assert {i: n for i, n in ids.items() if n > 1} == {None: 2, 5: 2}  # document 5 has two texts, both stay
    assert {1, 40}.issubset(ids) and not {56, 58, 60} & set(ids)
    last = corpus_pipeline.byte_bpe(spark, docs, sf).collect()
    assert len(last) == docs.count() and all(r["lossless"] or r["lossless"] is None for r in last)


def test_pipeline_on_documents(spark):
    sf = "/root/testdata/sf0.01"
    done = corpus_pipeline.run(spark, sf)
    rows = done.select("doc_id", "n_tokens", "lossless", F.size("ids").alias("n")).collect()
    assert 850 < len(rows) < 950 and all(r["lossless"] and r["n"] == r["n_tokens"] for r in rows)


def test_pipeline_without_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
    assert docs.count() == 0


def test_pipeline_predicts_once(spark, plan):
    """The filter on the language is no second evaluation, which would take a second Python worker."""
    assert plan(corpus_pipeline.language_id(spark, documents(spark), "")).count("ArrowEvalPython [") == 1
