"""Commits, as-of reads, lookups and listings."""

import pytest
from pyspark.sql import functions as F

from silverloom.schemas import GOLD, PREDICTION
from silverloom.session import new_folder, shared_folder, written
from silverloom.sinks.files import read_csv, write_csv
from silverloom.sinks.tables import append_commit, append_table, conform
from silverloom.sources.tables import (
    as_of,
    describe_gold,
    list_commits,
    list_objects,
    list_tables,
    load_table,
    lookup,
    read_table,
)


def gold(spark, *ids):
    return spark.createDataFrame([(str(i), f"t{i}", i % 2, [float(i)] * 3, "train", None) for i in ids], GOLD)


def test_commits(spark, tmp_path, values):
    path = str(tmp_path / "t")
    assert append_commit(gold(spark, 1, 2), path, GOLD, 10) == 10
    append_commit(gold(spark, 3), path, GOLD, 20)
    stamp = append_commit(gold(spark, 4), path, GOLD)
    append_commit(gold(spark, 3), path, GOLD, 20)
    table = read_table(spark, path, GOLD)
    assert values(table, "id") == ["1", "2", "3", "4"]
    assert values(as_of(table, 10), "id") == ["1", "2"] and values(as_of(table, 20), "id") == ["1", "2", "3"]
    assert as_of(table, 20).columns == GOLD.fieldNames()
    rows = sorted(tuple(r) for r in list_commits(table).select("commit_id", "n_rows", "is_latest").collect())
    assert rows == [(10, 2, False), (20, 1, False), (stamp, 1, True)]
    assert 1_600_000_000 < list_commits(table).orderBy("commit_id").collect()[-1]["committed_at"].timestamp() < 4_000_000_000


def test_as_of_prunes_commits(spark, tmp_path, plan):
    path = str(tmp_path / "t")
    append_commit(gold(spark, 1), path, GOLD, 10)
    append_commit(gold(spark, 2), path, GOLD, 20)
    assert "commit_id" in plan(as_of(read_table(spark, path, GOLD), 10)).split("PartitionFilters: ")[1].split("PushedFilters")[0]


def test_mismatching_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    append_commit(gold(spark, 1).withColumn("note", F.lit("n")).drop("split"), path, GOLD, 1)
    assert "note" not in read_table(spark, path).columns
    append_commit(gold(spark, 2).withColumn("note", F.lit("n")), path, GOLD, 2, evolve=True)
    merged = spark.read.option("mergeSchema", True).parquet(path).orderBy("id").collect()
    assert [(r["id"], r["split"], r["note"]) for r in merged] == [("1", None, None), ("2", "train", "n")]
    assert conform(gold(spark, 1).drop("label"), GOLD).schema.fieldNames() == GOLD.fieldNames()


def test_rows_per_file(spark, tmp_path):
    append_commit(gold(spark, *range(60)).coalesce(1), str(tmp_path / "t"), GOLD, 1, max_rows_per_file=25)
    files = list_objects(spark, str(tmp_path / "t"), ".parquet")
    assert files.count() == 3 and files.where("n_bytes <= 0").isEmpty()


def test_catalog_tables(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS tables_db LOCATION '{tmp_path}/db'")
    with pytest.raises(LookupError, match="run the gold job"):
        load_table(spark, "tables_db.gold_train", "tables_db.gold")
    append_table(gold(spark, 1), "tables_db.gold", GOLD, 1)
    assert load_table(spark, "tables_db.gold_train", "tables_db.gold").count() == 1
    append_table(gold(spark, 2, 3), "tables_db.gold", GOLD, 2)
    append_table(gold(spark, 2, 3), "tables_db.gold", GOLD, 2)
    assert spark.table("tables_db.gold").count() == 3
    assert list_tables(spark, "tables_db") == ["gold"]


def test_lookup_is_pushed_down(spark, tmp_path, plan):
    path = str(tmp_path / "p")
    rows = [(f"r{i}", "t", "t", 1, 0.5, "m", i, "inference") for i in range(10)]
    append_commit(spark.createDataFrame(rows, PREDICTION), path, PREDICTION, 1)
    hit = lookup(read_table(spark, path, PREDICTION), "r3")
    assert "EqualTo(request_id,r3)" in plan(hit) and hit.count() == 1


def test_describe_and_csv(spark, tmp_path):
    assert tuple(describe_gold(gold(spark, 1, 2)).first()) == (2, 6, 3, 3)
    df = spark.createDataFrame([("1", ' "quoted",\nline '), ("2", "plain")], "id string, text string")
    write_csv(df, str(tmp_path / "csv"))
    assert sorted(read_csv(spark, str(tmp_path / "csv"), "id string, text string").collect()) == sorted(df.collect())


def test_commits_of_one_moment_keep_all_rows(spark, tmp_path, monkeypatch):
    from silverloom.sinks import tables

    monkeypatch.setattr(tables, "now_stamp", lambda: 1_700_000_000_000)
    target = str(tmp_path / "gold")
    first, second = tables.append_commit(gold(spark, 1, 2), target, GOLD), tables.append_commit(gold(spark, 3, 4), target, GOLD)
    assert second == first + 1 and read_table(spark, target, GOLD).count() == 4
    for _ in range(2):
        tables.append_commit(gold(spark, 5, 6), target, GOLD, first)
    rows = list_commits(read_table(spark, target, GOLD)).orderBy("commit_id").collect()
    assert [r["n_rows"] for r in rows] == [4, 2]


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_folder(spark, "x") != new_folder(spark, "x")
    assert written(spark.range(3), "kept").count() == 3
