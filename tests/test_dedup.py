"""Keep-first deduplication, in one batch and across batches."""

import random

from pyspark.sql import functions as F

from silverloom.operators.dedup import dedup_counts, dedup_keep_first, dedup_keys, text_key
from silverloom.plans.silver import silver_job
from silverloom.sources.jsonl import read_lines

SILVER = "id string, text string, label int, split string, n int"


def keep_first(rows, seen=()):
    seen, out = set(seen), []
    for r in rows:
        key = (r[1], r[2] or 0, r[3] or "")
        if key not in seen:
            seen.add(key)
            out.append(r)
    return out


def test_first_of_each_key_survives(spark):
    keys = [("rain", 0, "b"), ("sun", 1, "a"), ("sun", 0, "a"), ("rain", 0, "b"), ("sun", 1, "b"), ("sun", 1, "a"), ("rain", 0, "b")]
    rows = [(f"k{n}", *key, n) for n, key in enumerate(keys)]
    out = dedup_keep_first(spark.createDataFrame(rows, SILVER), "n").orderBy("n").collect()
    assert [r["n"] for r in out] == [0, 1, 2, 4]


def test_second_batch_drops_seen_keys(spark):
    first = spark.createDataFrame([("1", "wind", 1, "u", 0), ("2", None, 0, "u", 1)], SILVER)
    second = spark.createDataFrame([("3", "wind", 1, "u", 0), ("4", "wind", 0, "u", 1), ("5", None, 0, "u", 2)], SILVER)
    kept = dedup_keep_first(first, "n")
    assert kept.count() == 2
    assert [r["id"] for r in dedup_keep_first(second, "n", existing=kept).collect()] == ["4"]
    stored_key = kept.withColumn("text_key", text_key(F.col("text"))).drop("text")
    assert [r["id"] for r in dedup_keep_first(second, "n", existing=stored_key).collect()] == ["4"]
    assert tuple(dedup_counts(second, kept).first()) == (3, 1, 2)


def random_rows(n, seed):
    """A third of the rows are copies of one text."""
    rng = random.Random(seed)
    return [
        (str(i), "hot" if rng.random() < 0.34 else f"t{rng.randrange(n // 2)}", rng.choice([0, 1, None]), rng.choice(["a", "b", None]), i)
        for i in range(n)
    ]


def test_same_result_for_any_partitioning(spark):
    rows = random_rows(3000, 1)
    want = keep_first(rows)
    for parts in (1, 7, 23):
        df = spark.createDataFrame(rows, SILVER).repartition(parts, F.rand(parts))
        assert [tuple(r) for r in dedup_keep_first(df, "n").orderBy("n").collect()] == want
        assert tuple(dedup_counts(df).first()) == (3000, len(want), 3000 - len(want))
    again = dedup_keep_first(spark.createDataFrame(want, SILVER), "n")
    assert again.count() == len(want)


def test_batches_against_existing(spark):
    rows = random_rows(2000, 2)
    a, b = rows[:1200], rows[1200:]
    first = keep_first(a)
    existing = spark.createDataFrame(a, SILVER)
    got = dedup_keep_first(spark.createDataFrame(b, SILVER).repartition(5), "n", existing).orderBy("n").collect()
    assert [tuple(r) for r in got] == keep_first(b, [(r[1], r[2] or 0, r[3] or "") for r in first])
    assert tuple(dedup_counts(spark.createDataFrame(b, SILVER), existing).first())[1] == len(got)


def test_one_shuffle_and_partial_aggregation(spark, plan):
    df = spark.createDataFrame(random_rows(10, 3), SILVER)
    text = plan(dedup_keep_first(df, "n"))
    assert text.count("Exchange") == 1 and "partial_min_by" in text and "Python" not in text
    keys = plan(dedup_keys(df))
    assert keys.count("Exchange") == 1 and "SortAggregate" not in keys


def test_job_from_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text(
        '{"id":"1","text":"<p>Hi  THERE</p>","label":1,"split":"train"}\n{"id":"2","text":"hi there","label":1,"split":"train"}\n'
        '{"id":"3","text":"","label":0,"split":"train"}\nbad\n{"id":"4","text":"x","label":2}\n'
    )
    result = silver_job(read_lines(spark, str(tmp_path)))
    assert sorted(tuple(r) for r in result.silver.collect()) == [
        ("1", "hi there", 1, "train", None), ("3", "", 0, "train", None)
    ]
    assert sorted(r["error"] for r in result.quarantine.collect()) == ["invalid label: 2", "malformed message"]
    assert tuple(result.counts.first()) == (3, 2, 1)
    assert silver_job(read_lines(spark, str(tmp_path)), dedup=False).silver.count() == 3
    assert silver_job(read_lines(spark, str(tmp_path)), existing=result.silver).silver.count() == 0
