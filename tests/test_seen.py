"""The index of keys that a layer holds."""

from pyspark.sql import functions as F

from silverloom.commits import read_log, visible
from silverloom.operators import seen as module
from silverloom.operators.dedup import KEY, with_key
from silverloom.operators.seen import SeenKeys
from silverloom.plans.jobs import build_silver, rejected_path
from silverloom.plans.silver import silver_job
from silverloom.schemas import REVIEW
from silverloom.sources.tables import read_silver


def silver(spark, *texts, split="train"):
    return spark.createDataFrame([(str(i), t, 1, split, None) for i, t in enumerate(texts)], REVIEW)


def opened(df):
    """Files that the scans of a frame open."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size()))


def test_a_small_batch_opens_few_files(spark, tmp_path):
    index = SeenKeys(spark, str(tmp_path / "keys"))
    for start in (0, 2000):  # history in two parts, over all buckets
        index.add(with_key(silver(spark, *(f"text {i}" for i in range(start, start + 2000)))))
    assert index.count() == 4000 and SeenKeys(spark, index.path, 7).keys([]).isEmpty()
    batch = with_key(silver(spark, "text 77", "new"))
    near = index.near(batch)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert opened(near) <= 4 and opened(index.keys()) == 128  # two buckets of two parts
        assert "PartitionFilters: [" in near._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    kept = silver_job(silver(spark, "text 77", "new", "new", "text 3999"), order="id", existing=index).silver
    assert [r["text"] for r in kept.collect()] == ["new"]


def test_adding_again_replaces(spark, tmp_path):
    index = SeenKeys(spark, str(tmp_path / "keys"))
    for _ in range(2):
        index.add(with_key(silver(spark, "a", "b", "a")), 5, "stream-0")
    assert index.count() == 2 and index.count("stream-0") == 0 and index.keys(but="stream-0").isEmpty()
    assert sorted(index.keys().columns) == sorted(KEY)


def test_parts_are_compacted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(module, "COMPACT_EVERY", 4)
    index = SeenKeys(spark, str(tmp_path / "keys"))
    for i in range(12):
        index.add(with_key(silver(spark, f"t{i}")), i + 1, "s")
    assert index.count() == 12 and index.keys().distinct().count() == 12
    assert len(visible(read_log(spark, index.path))) < 9


def test_an_index_that_lacks_keys_is_built_anew(spark, tmp_path):
    index = SeenKeys(spark, str(tmp_path / "keys"))
    layer = silver(spark, "a", "b", "c")
    index.add(with_key(silver(spark, "a")))
    index.cover(layer)
    assert index.count() == 3 and index.keys().distinct().count() == 3
    before = read_log(spark, index.path)
    index.cover(layer)
    assert read_log(spark, index.path) == before
    SeenKeys(spark, str(tmp_path / "none")).cover(None)


def bronze(path, split, *lines):
    folder = path / f"split={split}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{len(list(folder.iterdir()))}.jsonl").write_text("\n".join(lines))


def test_a_job_that_is_taken_up_again(spark, tmp_path):
    """Rejects stand once, silver once; good and rejected together are the input."""
    source, target = tmp_path / "bronze", str(tmp_path / "silver")
    bronze(source, "train", '{"id": "1", "text": "A", "label": 1, "split": "train"}', "bad", '{"id": "2", "text": "b", "label": 7}')
    for _ in range(3):
        build_silver(spark, str(source), target, "train")
    assert read_silver(spark, target).count() == 1 and spark.read.json(rejected_path(target)).count() == 2
    bronze(source, "train", '{"id": "3", "text": "C", "label": 1, "split": "train"}', '{"id": "4", "text": "a", "label": 1, "split": "train"}')
    rows = build_silver(spark, str(source), target, "train").collect()
    assert sorted(r["text"] for r in rows) == ["a", "c"]
    assert spark.read.json(rejected_path(target)).count() == 2


def test_a_job_that_died_before_its_index(spark, tmp_path, monkeypatch):
    source, target = tmp_path / "bronze", str(tmp_path / "silver")
    bronze(source, "train", '{"id": "1", "text": "A", "label": 1, "split": "train"}')
    with monkeypatch.context() as patch:
        patch.setattr(SeenKeys, "add", lambda *a: None)
        build_silver(spark, str(source), target, "train")
    assert build_silver(spark, str(source), target, "train").agg(F.count("*")).first()[0] == 1
