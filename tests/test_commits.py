"""The commit log: writers at the same time, dead writers, compaction, retention, lookups that skip files."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from silverloom import commits
from silverloom.commits import Part, create_once, history, publish, read_log, visible
from silverloom.schemas import GOLD, PREDICTION
from silverloom.sinks import tables
from silverloom.sinks.tables import append_commit, append_table, compact, expire
from silverloom.sources.tables import lookup, read_table


def gold(spark, *ids):
    return spark.createDataFrame([(str(i), f"t{i}", i % 2, [float(i)] * 3, "train", None) for i in ids], GOLD)


def files(path):
    return [os.path.join(d, n) for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")]


def test_a_file_has_one_maker(spark, tmp_path):
    path = str(tmp_path / "log" / "1.json")
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda i: create_once(spark, path, f"writer {i}"), range(16)))
    assert sum(made) == 1 and open(path).read() == f"writer {made.index(True)}"
    assert os.listdir(tmp_path / "log") == ["1.json"]


def test_writers_at_the_same_time(spark, tmp_path, values):
    path = str(tmp_path / "t")
    with ThreadPoolExecutor(6) as pool:
        ids = list(pool.map(lambda i: append_commit(gold(spark, i, 100 + i), path, GOLD), range(6)))
    assert len(set(ids)) == 6
    table = read_table(spark, path, GOLD)
    assert values(table, "id") == sorted(str(k) for i in range(6) for k in (i, 100 + i))
    placed = {r["id"]: r["commit_id"] for r in table.collect()}
    assert all(placed[str(i)] == placed[str(100 + i)] == ids[i] for i in range(6))
    entries = read_log(spark, path)
    assert [e.version for e in entries] == list(range(6)) and [e.commit_id for e in entries] == sorted(ids)


def test_a_later_commit_never_comes_before_one_that_was_read(spark, tmp_path, monkeypatch, values):
    """A slow writer takes its stamp first and finishes last: reads as of the quick one stay as they were."""
    path, real = str(tmp_path / "t"), tables.publish

    def slow(*args):
        monkeypatch.setattr(tables, "publish", real)
        quick.append(append_commit(gold(spark, 2), path, GOLD))
        before.append(values(read_table(spark, path, GOLD, as_of=quick[0]), "id"))
        return real(*args)

    quick, before = [], []
    append_commit(gold(spark, 0), path, GOLD)
    monkeypatch.setattr(tables, "publish", slow)
    late = append_commit(gold(spark, 1), path, GOLD)
    assert late == quick[0] + 1 and before == [["0", "2"]]
    assert values(read_table(spark, path, GOLD, as_of=quick[0]), "id") == ["0", "2"]
    assert values(read_table(spark, path, GOLD), "id") == ["0", "1", "2"]


def test_dead_writers_are_not_read(spark, tmp_path, monkeypatch, values):
    path = str(tmp_path / "t")
    append_commit(gold(spark, 1), path, GOLD, 10)
    with monkeypatch.context() as patch:
        patch.setattr(tables, "publish", lambda *a: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError):
            append_commit(gold(spark, 2), path, GOLD, 20)
    (tmp_path / "t" / commits.LOG / "00000000000000000001.json").write_text('{"kind": "append", "vers')  # died over its entry
    assert values(read_table(spark, path, GOLD), "id") == ["1"] and len(files(path)) > 1
    append_commit(gold(spark, 3), path, GOLD, 30)
    assert values(read_table(spark, path, GOLD), "id") == ["1", "3"]
    assert [e.version for e in read_log(spark, path)] == [0, 2]
    gone = expire(spark, path, before=0, orphans_before_ms=1 << 60)
    assert len(gone) == 1 and gone[0].startswith("commit_id=20/") and values(read_table(spark, path, GOLD), "id") == ["1", "3"]


def test_tables_without_a_log_are_taken_over(spark, tmp_path, values):
    path = str(tmp_path / "t")
    gold(spark, 1, 2).write.parquet(f"{path}/commit_id=5/writer=old")
    assert values(read_table(spark, path, GOLD), "id") == ["1", "2"]
    assert values(read_table(spark, path, GOLD, since=6), "id") == []
    append_commit(gold(spark, 3), path, GOLD, 6)
    assert values(read_table(spark, path, GOLD), "id") == ["1", "2", "3"] and values(read_table(spark, path, GOLD, as_of=5), "id") == ["1", "2"]


def test_compaction_and_retention(spark, tmp_path, values):
    path = str(tmp_path / "t")
    for i in range(10):
        append_commit(gold(spark, i), path, GOLD, 10 * i)
    want = {c: values(read_table(spark, path, GOLD, as_of=c), "id") for c in range(0, 100, 10)}
    assert compact(spark, path, small_rows=100, at_least=11) == 0
    assert compact(spark, path, small_rows=100, at_least=10) == 10
    assert len(visible(read_log(spark, path))) == 1
    append_commit(gold(spark, 5), path, GOLD, 50)  # a replay: the commit is complete
    append_commit(gold(spark, 77), path, GOLD, 200)
    assert {c: values(read_table(spark, path, GOLD, as_of=c), "id") for c in want} == want
    assert values(read_table(spark, path, GOLD), "id") == sorted([str(i) for i in range(10)] + ["77"])
    assert values(read_table(spark, path, GOLD, since=100), "id") == ["77"]
    assert [r["n_rows"] for r in history(spark, path).orderBy("commit_id").collect()] == [1] * 11
    assert expire(spark, path, before=80) == []  # reads as of 80 need the parts that were compacted at 90
    assert {c: values(read_table(spark, path, GOLD, as_of=c), "id") for c in (80, 90)} == {c: want[c] for c in (80, 90)}
    with pytest.raises(ValueError, match="folded"):
        read_table(spark, path, GOLD, as_of=40)
    assert len(expire(spark, path, before=90)) == 10
    assert values(read_table(spark, path, GOLD, as_of=90), "id") == want[90]
    assert len(read_log(spark, path)) <= 3 and len({os.path.dirname(f) for f in files(path)}) == 2


def test_a_hundred_batches_leave_few_files(spark, tmp_path):
    path = str(tmp_path / "t")
    one = gold(spark, 1).coalesce(1).cache()
    for i in range(1, 41):
        append_commit(one, path, GOLD, i)
        if i % 10 == 0:
            compact(spark, path, small_rows=1000, at_least=5)
            expire(spark, path, before=i)
    assert read_table(spark, path, GOLD).count() == 40 and len(files(path)) <= 11
    assert len(os.listdir(tmp_path / "t" / commits.LOG)) <= 24  # with check sums
    one.unpersist()


def test_a_compaction_gives_way_to_a_commit_written_again(spark, tmp_path, monkeypatch, values):
    path, real = str(tmp_path / "t"), tables.publish
    for i in range(3):
        append_commit(gold(spark, i), path, GOLD, i)

    def overtaken(*args):
        monkeypatch.setattr(tables, "publish", real)
        append_commit(gold(spark, 50), path, GOLD, 1)
        return real(*args)

    monkeypatch.setattr(tables, "publish", overtaken)
    assert compact(spark, path, small_rows=100, at_least=2) == 0
    assert values(read_table(spark, path, GOLD), "id") == ["0", "2", "50"]


def test_publishing_is_tried_again(spark, tmp_path):
    path, tries = str(tmp_path), []

    def make(entries):
        tries.append(len(entries))
        if len(tries) == 1:  # somebody else takes the number
            publish(spark, path, lambda e: ("append", [Part("commit_id=1/writer=x", 1, "x", 1)], []))
        return "append", [Part("commit_id=2/writer=y", 2, "y", 1)], []

    assert publish(spark, path, make).version == 1 and tries == [0, 1]


def test_an_empty_log(spark, tmp_path):
    (tmp_path / "t" / commits.LOG).mkdir(parents=True)
    assert read_table(spark, str(tmp_path / "t"), GOLD).columns == [*GOLD.fieldNames(), "commit_id"]
    with pytest.raises(ValueError, match="schema"):
        read_table(spark, str(tmp_path / "t"))


def test_catalog_writers_at_the_same_time(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS race_db LOCATION '{tmp_path}/db'")
    with ThreadPoolExecutor(3) as pool:
        ids = list(pool.map(lambda i: append_table(gold(spark, i, 10 + i), "race_db.gold", GOLD), range(3)))
    assert len(set(ids)) == 3 and spark.table("race_db.gold").count() == 6


def scanned(df):
    """Rows that the scans of a collected frame produced."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_lookup_opens_few_files(spark, tmp_path):
    path = str(tmp_path / "p")
    for c in range(4):  # ids are random: no file's range of ids excludes another's
        ids = spark.range(5000).select(F.md5(F.concat_ws("-", F.lit(c), "id")).alias("request_id"), *[
            F.lit(None).cast(f.dataType).alias(f.name) for f in PREDICTION.fields[1:]
        ])
        append_commit(ids.coalesce(1), path, PREDICTION, 1000 + c, keys=["request_id"])
    wanted = spark.range(1).select(F.md5(F.lit("2-77"))).first()[0]
    hit = lookup(read_table(spark, path, PREDICTION), wanted)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert hit.count() == 1 and scanned(hit) == 5000  # one file of four, by its Bloom filter
        late = lookup(read_table(spark, path, PREDICTION, since=1003), wanted)
        assert late.count() == 0 and scanned(late) == 0 and len(late.inputFiles()) == 1
        compact(spark, path, small_rows=10_000, at_least=2, keys=["request_id"])
        again = lookup(read_table(spark, path, PREDICTION), wanted)
        assert again.count() == 1 and len(again.inputFiles()) == 2 and scanned(again) <= 10_500
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
