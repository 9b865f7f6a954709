"""Balanced samples, certificates of training, snapshots of topics, one-operator stream dedup."""

import json
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from silverloom.models.classifier import optimality, train_classifier
from silverloom.operators import sampling
from silverloom.operators.predict import linear_step
from silverloom.operators.sampling import sample_balanced
from silverloom.plans.jobs import ingest_bronze, rejected_path
from silverloom.schemas import PREDICTION
from silverloom.sources.jsonl import read_lines
from silverloom.sources.tables import read_table
from silverloom.sources.topic import topic_batch, topic_snapshot, topic_stream
from silverloom.streaming import run
from silverloom.streaming.inference import Sinks, inference_stream
from silverloom.streaming.layers import dedup_stream, large_state
from silverloom.streaming.run import drain, publish_paced


@pytest.mark.parametrize(
    "sizes, n, want",
    [
        ({"a": 100, "b": 100}, 50, {"a": 25, "b": 25}),
        ({"a": 100, "b": 3}, 50, {"a": 47, "b": 3}),
        ({"a": 100, "b": 100, None: 100}, 50, {None: 17, "a": 17, "b": 16}),
        ({"a": 5, "b": 5}, 1, {"a": 1, "b": 1}),
        ({"a": 5, "b": 5}, 100, {"a": 5, "b": 5}),
        ({}, 5, {}),
    ],
)
def test_balanced_sample(spark, sizes, n, want):
    rows = [(i, c) for c, size in sizes.items() for i in range(size)]
    rows = [(1000 * k + i, c) for k, (i, c) in enumerate(rows)]
    df = spark.createDataFrame(rows, "id long, class string")
    found = [tuple(r) for r in sample_balanced(df, n, "id", "class").collect()]
    assert Counter(c for _, c in found) == want and len(set(found)) == len(found) and set(found) <= set(rows)
    again = [tuple(r) for r in sample_balanced(df.repartition(3), n, "id", "class").collect()]
    assert sorted(again, key=str) == sorted(found, key=str)


def test_balanced_sample_of_too_many_classes(spark, monkeypatch):
    monkeypatch.setattr(sampling, "MOST_CLASSES", 3)
    with pytest.raises(ValueError, match="not a class"):
        sample_balanced(spark.range(5).withColumn("class", F.col("id").cast("string")), 2, "id", "class")


def test_certificate(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 4))
    y = (x @ np.array([1.0, -2, 0.5, 0]) + rng.normal(size=300) > 0).astype(int)
    rows = [(str(i), [float(v) for v in a], int(b)) for i, (a, b) in enumerate(zip(x.astype(np.float32), y, strict=True))]
    gold = spark.createDataFrame(rows, "id string, embedding array<float>, label long")
    trained = train_classifier(gold, test_split=None, max_records=None)
    found = optimality(gold, trained.model).first()
    fitted = trained.model.stages[-1]
    w, b = fitted.coefficients.toArray(), fitted.intercept
    x = x.astype(np.float32).astype(float)
    z = x @ w + b
    p = 1 / (1 + np.exp(-z))
    assert found["gradient"] == pytest.approx(max(abs((p - y).sum()), np.abs(x.T @ (p - y) + w).max()) / 300, abs=1e-12)
    assert found["gradient"] < 1e-6 and found["n_rows"] == 300 and found["n_features"] == 4
    assert found["loss"] == pytest.approx((np.log1p(np.exp(-np.abs(z))) + np.maximum(z, 0) - z * y).mean() + w @ w / 600)
    assert found["accuracy"] == pytest.approx(trained.metrics["train_accuracy"])
    other = optimality(gold.where("id <> '7'"), trained.model).first()
    assert other["gradient"] > 1e-6  # another table has another optimum


def test_a_snapshot_does_not_grow(spark, tmp_path):
    topic = tmp_path / "topic"
    topic.mkdir()
    for name, lines in (("b.txt", "3\n4"), ("a.txt", "1\n2"), ("c.txt", "5")):
        (topic / name).write_text(lines)
    first = topic_snapshot(spark, str(topic), ordered=True)
    (topic / "0.txt").write_text("0")
    assert [r["value"] for r in first.orderBy("arrival").collect()] == list("12345")
    assert topic_snapshot(spark, str(topic)).select("arrival").distinct().count() == 6


def test_the_first_messages_of_a_topic(spark, tmp_path):
    topic, path = tmp_path / "topic", str(tmp_path / "bronze")
    topic.mkdir()
    (topic / "b.txt").write_text('{"id": "4"}\n{"id": "5"}')
    (topic / "a.txt").write_text('{"id": "1"}\nbad\n{"id": "2"}\n{"id": "3"}')
    ingest_bronze(spark, str(topic), path, "train", limit=4)
    ids = {r["value"] for r in read_lines(spark, path).collect()}
    assert len(ids) == 4 and not any('"5"' in v for v in ids)
    assert spark.read.json(rejected_path(path)).count() == 1


def test_paced_publishing(spark, tmp_path):
    """All rows, in order, a few per turn; a second start publishes nothing anew."""
    rows = spark.createDataFrame([(7 * i, str(i), f"text {i}", 1, "train", None) for i in range(25)], "at long, id string, text string, label int, split string, request_id string")
    topic = str(tmp_path / "topic")
    start = time.monotonic()
    assert publish_paced(rows.repartition(3), topic, "at", str(tmp_path / "c"), 10, 1.0) == 25
    assert time.monotonic() - start >= 2.0
    batches = {}
    for r in spark.read.text(topic).collect():
        batches.setdefault(r["batch_id"], set()).add(int(json.loads(r["value"])["id"]))
    assert batches == {0: set(range(10)), 1: set(range(10, 20)), 2: set(range(20, 25))}
    assert publish_paced(rows, topic, "at", str(tmp_path / "c"), 10, 0.2) == 25
    assert topic_batch(spark, topic).count() == 25
    assert publish_paced(rows.limit(0), str(tmp_path / "none"), "at", str(tmp_path / "d"), 10, 0.2) == 0


def test_paced_publishing_of_many_turns(spark, tmp_path, monkeypatch):
    """A turn costs no job of its own, and a run that died goes on with the next turn."""
    rows = spark.range(400).selectExpr("id at", "cast(id as string) id", "'t' text", "1 label", "'train' split", "cast(null as string) request_id")
    topic, move, sent = str(tmp_path / "topic"), run.move_path, []

    def failing(spark, source, target):
        if len(sent) == 5:
            raise OSError("lost")
        sent.append(target)
        move(spark, source, target)

    monkeypatch.setattr(run, "move_path", failing)
    with pytest.raises(OSError, match="lost"):
        publish_paced(rows, topic, "at", str(tmp_path / "c"), 2, 0.01)
    read = spark.read.text(topic)
    assert {r["batch_id"] for r in read.collect()} == set(range(5)) and read.count() == 10
    monkeypatch.setattr(run, "move_path", move)
    start = time.monotonic()
    assert publish_paced(rows, topic, "at", str(tmp_path / "c"), 2, 0.01) == 400
    assert time.monotonic() - start < 40  # a job for each turn took over 100 s
    found = sorted((int(json.loads(r["value"])["id"]), r["batch_id"]) for r in spark.read.text(topic).collect())
    assert found == [(i, i // 2) for i in range(400)]


def test_stream_state_holds_each_key_once(spark, tmp_path):
    """A text that floods the stream is thinned before the shuffle; the state has as many rows as there are keys."""
    large_state(spark)
    for batch in range(2):
        rows = spark.range(3000).select(
            F.col("id").cast("string").alias("id"),
            F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 100)).alias("text"),
            F.lit(1).alias("label"), F.lit("train").alias("split"), F.timestamp_seconds(F.col("id")).alias("at"),
        )
        rows.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
        writer = dedup_stream(stream).writeStream.format("parquet").option("path", str(tmp_path / "out"))
        query = writer.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        query.awaitTermination()
        states = [p.stateOperators for p in query.recentProgress if p.stateOperators]
        assert all(len(s) == 1 for s in states) and states[-1][0].numRowsTotal == 101
    assert spark.read.parquet(str(tmp_path / "out")).count() == 101
    shuffled = dedup_stream(spark.read.parquet(str(tmp_path / "in")))
    assert shuffled.count() == 101


def test_forgotten_keys(spark, tmp_path):
    large_state(spark)
    rows = [("1", "a", 1, "train", 0), ("2", "a", 1, "train", 60), ("3", "b", 1, "train", 61)]
    df = spark.createDataFrame(rows, "id string, text string, label int, split string, s int").withColumn("at", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("s"))).drop("s")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    writer = dedup_stream(stream, "at", "1 hour").writeStream.format("parquet").option("path", str(tmp_path / "out"))
    drain(writer.option("checkpointLocation", str(tmp_path / "c")))
    assert sorted(r["text"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]


def test_staging_and_dead_letters_of_a_stream(spark, tmp_path):
    """Only the last batch stays staged; with servers the letters go to a broker (no connector is at hand here)."""
    topic = tmp_path / "topic"
    topic.mkdir()
    for i in range(3):
        (topic / f"{i}.txt").write_text(json.dumps({"id": str(i), "text": "x", "split": "inference"}) + "\nbroken")
        time.sleep(0.01)
    names = ("staging", "bronze", "silver", "predictions", "letters", "gold")
    sinks = Sinks(*(str(tmp_path / n) for n in names))

    def run(sinks, checkpoint):
        stream = topic_stream(spark, str(topic), max_per_trigger=1)
        encode = lambda df: df.withColumn("embedding", F.array(F.lit(1.0).cast("float")))
        drain(inference_stream(stream, encode, linear_step([1.0], 0.0), sinks, str(tmp_path / checkpoint), size=1, compact_every=2))

    run(sinks, "c")
    staged = [p.name for p in (tmp_path / "staging").glob("stream=*/*")]
    assert staged == ["batch_id=2"]
    assert read_table(spark, sinks.predictions, PREDICTION).count() == 3
    assert spark.read.text(sinks.dead_letters).count() == 3
    with pytest.raises(Exception, match="kafka"):
        run(sinks._replace(dead_letters="letters", dead_letter_servers="nowhere:9092"), "d")
