"""The whole job on a small dataset."""

from pyspark.sql import functions as F

from silverloom.models.store import load_model
from silverloom.plans.jobs import Places, backfill, build_silver, ingest_bronze, is_ready
from silverloom.plans.silver import silver_job
from silverloom.schemas import REVIEW
from silverloom.sinks.files import publish
from silverloom.sources.jsonl import read_jsonl, read_lines
from silverloom.sources.tables import read_silver


def raw(spark, n, offset=0):
    words = F.array(F.lit("good fine great"), F.lit("bad poor awful"))
    df = spark.range(offset, offset + n).withColumnRenamed("id", "key")
    word = F.get(words, (F.col("key") % 2).cast("int"))
    text = F.concat(F.lit("<p>"), word, F.lit("</p> Film "), F.col("key").cast("string"))
    return df.select("key", text.alias("text"), (1 - F.col("key") % 2).cast("int").alias("label"))


def test_backfill(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS backfill_db LOCATION '{tmp_path}/db'")
    places = Places(str(tmp_path / "run"), "backfill_db")
    datasets = {"train": raw(spark, 60), "test": raw(spark, 20, 1000)}
    trained = backfill(spark, places, datasets, "key", limit=30, size=128)
    assert trained.metrics["train_accuracy"] == trained.metrics["test_accuracy"] == 1.0
    assert spark.table("backfill_db.gold_train").count() == 30 and spark.table("backfill_db.gold_test").count() == 20
    _, about = load_model(spark, places.model)
    assert about["metrics"] == trained.metrics
    assert backfill(spark, places, datasets, "key") is None
    assert is_ready(spark, ["backfill_db.gold_train"], [str(tmp_path / "none"), places.text_model])
    assert not is_ready(spark, ["backfill_db.gold_other"], [places.model])
    assert not is_ready(spark, ["backfill_db.gold_train"], [str(tmp_path / "none")])


def test_backfill_is_taken_up_after_a_failure(spark, tmp_path, monkeypatch):
    from silverloom.plans import jobs

    spark.sql(f"CREATE DATABASE IF NOT EXISTS resumed_db LOCATION '{tmp_path}/db'")
    places = Places(str(tmp_path / "run"), "resumed_db")
    datasets = {"train": raw(spark, 40), "test": raw(spark, 10, 1000)}
    real = jobs.train_classifier
    monkeypatch.setattr(jobs, "train_classifier", lambda *a, **b: (_ for _ in ()).throw(OSError("lost")))
    for _ in range(2):
        try:
            backfill(spark, places, datasets, "key", size=64)
        except OSError:
            pass
    monkeypatch.setattr(jobs, "train_classifier", real)
    assert backfill(spark, places, datasets, "key", size=64).metrics["train_accuracy"] == 1.0
    assert spark.table("resumed_db.gold_train").count() == 40 and spark.table("resumed_db.gold_test").count() == 10
    assert read_silver(spark, f"{places.root}/silver").count() == 50
    assert read_jsonl(spark, f"{places.root}/bronze", REVIEW).count() == 50
    assert load_model(spark, places.model) is not None and backfill(spark, places, datasets, "key", size=64) is None


def test_backfill_trains_on_all_rows(spark, tmp_path, monkeypatch):
    from silverloom.plans import jobs

    spark.sql(f"CREATE DATABASE IF NOT EXISTS whole_db LOCATION '{tmp_path}/db'")
    taken, real = [], jobs.train_classifier
    monkeypatch.setattr(jobs, "train_classifier", lambda *a, **k: (taken.append(k.get("max_records")), real(*a, **k))[1])
    backfill(spark, Places(str(tmp_path / "run"), "whole_db"), {"train": raw(spark, 20)}, "key", test_split=None, size=64)
    assert taken == [None]


def test_nothing_is_dropped_in_silence(spark, tmp_path):
    topic, bronze, silver = (str(tmp_path / n) for n in ("topic", "bronze", "silver"))
    (tmp_path / "topic").mkdir()
    lines = ['{"id":"1","text":"a","label":1,"split":"train"}', "bad", "[1]", '{"id":"2","text":"b","label":7,"split":"train"}']
    (tmp_path / "topic" / "a.txt").write_text("\n".join(lines))
    ingest_bronze(spark, topic, bronze, "train")
    good = read_jsonl(spark, bronze, REVIEW).count()
    assert good + spark.read.json(f"{bronze}_rejected").count() == 4
    kept = build_silver(spark, bronze, silver, "train").count()
    assert kept + spark.read.json(f"{silver}_rejected").count() == good


def test_one_split_without_evaluation(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS single_db LOCATION '{tmp_path}/db'")
    places = Places(str(tmp_path / "run"), "single_db")
    trained = backfill(spark, places, {"train": raw(spark, 20)}, "key", test_split=None, size=64)
    assert set(trained.metrics) == {"train_accuracy"}


def test_silver_is_not_written_twice(spark, tmp_path, plan):
    topic, bronze, silver = (str(tmp_path / n) for n in ("topic", "bronze", "silver"))
    rows = [(str(i), f"text {i % 3}", 1, "train", None) for i in range(9)]
    publish(spark.createDataFrame(rows, REVIEW), topic)
    ingest_bronze(spark, topic, bronze, "train")
    assert read_silver(spark, silver) is None
    assert build_silver(spark, bronze, silver, "train").count() == 3
    assert build_silver(spark, bronze, silver, "train").count() == 3
    again = silver_job(read_lines(spark, bronze), existing=read_silver(spark, silver, "train")).silver
    assert "ReadSchema: struct<label:int,text_key:binary>" in plan(again) and again.count() == 0
    ingest_bronze(spark, topic, str(tmp_path / "few"), "train", limit=4)
    assert read_jsonl(spark, str(tmp_path / "few"), REVIEW).count() == 4


def test_limit_takes_the_first_valid_messages(spark, tmp_path):
    lines = [f'{{"id":"{i}"}}' if i % 3 else "bad" for i in range(30)]
    (tmp_path / "topic").mkdir()
    (tmp_path / "topic" / "a.txt").write_text("\n".join(lines))
    ingest_bronze(spark, str(tmp_path / "topic"), str(tmp_path / "b"), "train", limit=7)
    stored = read_jsonl(spark, str(tmp_path / "b"), REVIEW)
    assert sorted(int(r["id"]) for r in stored.collect()) == [i for i in range(30) if i % 3][:7]


def test_lines_are_parsed_once(spark, tmp_path, monkeypatch, plan):
    """What is written from bronze and silver lines comes from a table of parsed ones; an empty index needs no look at the lines."""
    from silverloom.plans import jobs

    topic, bronze, silver = (str(tmp_path / n) for n in ("topic", "bronze", "silver"))
    (tmp_path / "topic").mkdir()
    (tmp_path / "topic" / "a.txt").write_text('{"id": "1", "text": "<b>A</b>", "label": 1}\nbad\n{"id": "2", "text": "B", "label": 2}\n')
    plans = []
    for name in ("reject", "write_layer", "write_silver"):
        monkeypatch.setattr(jobs, name, lambda rows, *a, real=getattr(jobs, name), **k: (plans.append(plan(rows)), real(rows, *a, **k))[1])
    ingest_bronze(spark, topic, bronze, "train")
    assert [tuple(r) for r in build_silver(spark, bronze, silver, "train").collect()] == [("1", "a", 1, "train", None)]
    assert spark.read.json(f"{bronze}_rejected").count() == spark.read.json(f"{silver}_rejected").count() == 1
    assert len(plans) == 4 and not any("from_json" in p for p in plans)
