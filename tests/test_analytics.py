"""Samples, positions, splits, traces, metrics and scores against plain Python."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from silverloom.constants import PROCESSING_BOUNDS, REQUEST_BOUNDS
from silverloom.functions.scores import argmax, positive_probability, threshold_label
from silverloom.operators import sampling, trace
from silverloom.operators.metrics import accuracy, class_summary, counters, histogram, require_two_classes
from silverloom.operators.predict import linear_step, predict, resolve_identity, to_predictions, to_responses
from silverloom.operators.splits import inference_only, split_filter, split_filter_or_all
from silverloom.schemas import PREDICTION


def shuffled_ids(ids, seed=42):
    return sorted(ids, key=lambda i: hashlib.md5(f"{seed}:{i}".encode()).hexdigest())


@pytest.mark.parametrize("top_n", [100_000, 100, 3])
def test_samples(spark, monkeypatch, values, top_n):
    monkeypatch.setattr(sampling, "EDGE_KEYS", top_n)
    monkeypatch.setattr(sampling, "_PREFIX", 1)
    monkeypatch.setattr(sampling, "_RANGES", 8)
    for parts, n in ((1, 333), (6, 1), (6, 998), (6, 5000)):
        df = spark.range(1000).repartition(parts)
        assert values(sampling.sample_exact(df, n, "id"), "id") == sorted(shuffled_ids(range(1000))[:n])
        assert values(sampling.first_rows(df, n, "id"), "id") == list(range(min(n, 1000)))
        assert sampling.sample_exact(df, 0, "id").count() == sampling.sample_exact(df, None, "id").count() == 1000
    assert values(sampling.first_rows(df, 40, "id", seed=9), "id") == sorted(shuffled_ids(range(1000), 9)[:40])


def test_positions(spark):
    df = spark.range(500).select((F.col("id") * 7 - 100).alias("k")).repartition(5)
    keys = [i * 7 - 100 for i in range(500)]
    by_order = {r["k"]: r["position"] for r in sampling.with_position(df, "k").collect()}
    assert by_order == {k: i for i, k in enumerate(keys)}
    by_seed = {r["k"]: r["position"] for r in sampling.with_position(df, "k", 42).collect()}
    assert by_seed == {k: i for i, k in enumerate(shuffled_ids(keys))}
    assert sampling.with_position(df.where("k > 10000"), "k").count() == 0
    skewed = [0, 1, 2, 3, 10**6, 10**12, 10**12 + 1, 2**62, 2**62 + 1, -(2**61), -5]
    rows = spark.createDataFrame([(k,) for k in skewed], "k long").repartition(3)
    assert {r["k"]: r["position"] for r in sampling.with_position(rows, "k").collect()} == {k: i for i, k in enumerate(sorted(skewed))}
    decimals = spark.createDataFrame([(x / 7,) for x in range(-50, 50)], "k double")
    assert [r[0] for r in sampling.with_position(decimals, "k").orderBy("k").select("position").collect()] == list(range(100))


def test_latest_and_tail(spark, plan):
    rows = [(f"r{i % 3}", i, i) for i in range(30)]
    df = spark.createDataFrame(rows, "request_id string, created_at_ms long, v int").repartition(4)
    latest = sampling.latest_per_request(df)
    assert sorted(tuple(r) for r in latest.collect()) == [("r0", 27, 27), ("r1", 28, 28), ("r2", 29, 29)]
    text = plan(sampling.latest_per_request(df))
    assert "partial_max_by" in text and text.count("Exchange hash") == 1
    assert [r["v"] for r in sampling.tail(df, 5).collect()] == [29, 28, 27, 26, 25]


def test_split_filters(spark):
    df = spark.createDataFrame([("train", 1), ("test", 2), ("train", 3)], "split string, x int")
    assert split_filter(df, "train").count() == 2
    assert split_filter(df, None).count() == 3
    assert split_filter(df.drop("split"), "train").count() == 3
    assert split_filter_or_all(df, "test").count() == 1
    assert split_filter_or_all(df, "absent").count() == 3
    gate = spark.createDataFrame([(None,), ("inference",), ("train",), ("",)], "split string")
    assert inference_only(gate).count() == 2


def test_trace(spark):
    requests = spark.createDataFrame([("a",), ("b",), ("c",), ("a",), (None,)], "request_id string")
    hot = spark.createDataFrame([("a",)] * 500 + [("z",)] * 500 + [(None,)], "request_id string")
    out = trace.request_trace(requests, {"bronze": hot, "gold": spark.createDataFrame([("c",), ("a",)], "request_id string")})
    assert sorted(tuple(r) for r in out.collect()) == [("a", True, True), ("b", False, False), ("c", False, True)]


@pytest.mark.parametrize("bounds", [REQUEST_BOUNDS, PROCESSING_BOUNDS])
def test_histogram(spark, bounds):
    rng = random.Random(3)
    rows = [(rng.choice("xy"), rng.expovariate(1 / 3)) for _ in range(2000)] + [("x", bounds[0]), ("y", None)]
    df = spark.createDataFrame(rows, "kind string, v double")
    out = {(r["kind"], r["le"]): r for r in histogram(df, "v", bounds, ["kind"]).collect()}
    for kind in "xy":
        mine = [v for k, v in rows if k == kind and v is not None]
        for b in bounds:
            assert out[kind, str(b)]["n"] == sum(v <= b for v in mine)
        assert out[kind, "+Inf"]["n"] == out[kind, "+Inf"]["total_count"] == len(mine)
        assert math.isclose(out[kind, "+Inf"]["total_sum"], sum(mine))
    empty = histogram(df.where("false"), "v", bounds).collect()
    assert len(empty) == len(bounds) + 1 and all(r["n"] == 0 and r["total_sum"] == 0.0 for r in empty)


def test_counts_accuracy_classes(spark):
    df = spark.createDataFrame([(0, 0.0), (1, 1.0), (1, 0.0), (0, 0.0)], "label int, pred_label double")
    assert sorted(tuple(r) for r in counters(df, "label").collect()) == [(0, 2), (1, 2)]
    assert tuple(accuracy(df).first()) == (4, 0.75)
    assert tuple(accuracy(df.where("false")).first()) == (0, None)
    assert tuple(class_summary(df).first()) == (4, 2, 0, 1)
    assert require_two_classes(df) == 4
    with pytest.raises(ValueError, match="labelled 1: nothing to tell apart"):
        require_two_classes(df.where("label = 1"))
    with pytest.raises(ValueError, match="no training rows"):
        require_two_classes(df.where("false"))


def test_scores(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 3.0), (800.0, -800.0), (-800.0, 800.0)], "a double, b double")
    score = positive_probability(F.col("a"), F.col("b"))
    rows = df.select(score, threshold_label(score), argmax(F.array("a", "b"))).collect()
    assert [tuple(r)[1:] for r in rows] == [(1, 0), (1, 1), (0, 0), (1, 1)]
    assert [r[0] for r in rows] == pytest.approx([0.5, math.exp(3) / (math.exp(1) + math.exp(3)), 0.0, 1.0])


def test_identity(spark):
    rows = [("r", "i"), ("", "i"), (None, "i"), ("r", ""), ("r", None), (None, None), ("", "")]
    df = spark.createDataFrame(rows, "request_id string, id string")
    out = [tuple(r) for r in resolve_identity(df, F.lit("new")).select("request_id", "id").collect()]
    assert out == [("r", "i"), ("i", "i"), ("i", "i"), ("r", "r"), ("r", "r"), ("new", "new"), ("new", "new")]
    fresh = resolve_identity(spark.range(100).select(F.lit(None).cast("string").alias("request_id"))).collect()
    assert len({r["request_id"] for r in fresh}) == 100 and all(r["request_id"] == r["id"] for r in fresh)


def test_predict_rows(spark, plan):
    rows = [("a", None, "<b> </b>"), ("b", None, "<i>Good</i> FILM"), ("c", None, None)]
    requests = spark.createDataFrame(rows, "request_id string, id string, text string")

    def encode(df):
        return df.withColumn("embedding", F.array(F.length("cleaned_text").cast("float")))

    scored = predict(requests, encode, linear_step([1.0], -9.0), size=1)
    rows = {r["request_id"]: r for r in to_responses(scored).collect()}
    assert tuple(rows["a"]) == ("a", 0, 0.0, "") and tuple(rows["c"]) == ("c", 0, 0.0, "")
    assert tuple(rows["b"]) == ("b", 1, 0.5, "good film")
    out = to_predictions(scored, model_version="m2", created_at_ms=F.lit(5))
    assert [f.dataType for f in out.schema] == [f.dataType for f in PREDICTION] and out.columns == PREDICTION.fieldNames()
    assert {(r["model_version"], r["created_at_ms"], r["split"]) for r in out.collect()} == {("m2", 5, "inference")}
    assert "Exchange" not in plan(scored)
