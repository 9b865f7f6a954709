"""Tables with a commit log: writers at the same time, unfinished writes, compaction, retention, pruned lookups."""

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from silverloom.commits import COMMIT, LOG, WRITER, history, read_log, visible
from silverloom.operators.sampling import latest_per_request
from silverloom.queries.data import GOLD_SQL, PREDICTIONS_SQL, gold, predictions
from silverloom.schemas import GOLD, PREDICTION
from silverloom.session import new_folder
from silverloom.sinks.tables import append_commit, compact, conform, expire
from silverloom.sources.tables import list_commits, lookup, read_table
from silverloom.streaming.run import wait_for_prediction


def _by_class(spark, sf):
    """One commit for each class of vectors: 1000, 2000, ..."""
    path = new_folder(spark, "gold_table")
    for c in range(10):
        append_commit(gold(spark, sf).where(F.col("class") == c), path, GOLD, commit_id=1000 * (c + 1))
    return path


def append_unfinished(spark, sf):
    """What a killed writer left, a part without an entry and half an entry, is never read."""
    path = new_folder(spark, "gold_table")
    rows = gold(spark, sf)
    append_commit(rows.where("class < 5"), path, GOLD, commit_id=1000)
    conform(rows, GOLD).write.parquet(f"{path}/{COMMIT}=2000/{WRITER}=killed")
    spark.createDataFrame([('{"kind": "append", "version": 1, "add',)], "value string").coalesce(1).write.mode("append").text(f"{path}/{LOG}")
    append_commit(rows.where("class >= 5"), path, GOLD, commit_id=3000)
    return list_commits(read_table(spark, path, GOLD)).select("commit_id", "n_rows", "is_latest")


def append_concurrent(spark, sf):
    """Four writers at the same time: no commit is lost, none shares its id with another."""
    path = new_folder(spark, "gold_table")

    def write(i):
        append_commit(gold(spark, sf).where(F.col("class") % 4 == i), path, GOLD)

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(write, range(4)))
    rows = read_table(spark, path, GOLD)
    return rows.agg(F.countDistinct("commit_id").alias("n_commits"), F.count("*").alias("n_rows"), F.countDistinct("id").alias("n_ids"))


def commit_history(spark, sf):
    """The commits as the log tells them, without a look at the data."""
    return history(spark, _by_class(spark, sf)).select("commit_id", "n_rows", "is_latest")


def compacted_as_of(spark, sf):
    """Ten small commits put into one: a read as of the fourth gives what it gave before, a plain read everything."""
    path = _by_class(spark, sf)
    compact(spark, path)
    parts = len(visible(read_log(spark, path)))
    early = read_table(spark, path, GOLD, as_of=4000).agg(F.count("*").alias("n_early"), F.max(F.col("id").cast("long")).alias("last_early"))
    whole = read_table(spark, path, GOLD).agg(F.count("*").alias("n_rows")).scalar()
    return early.select("*", whole.alias("n_rows"), F.lit(parts).cast("long").alias("n_parts"))


def expired_commits(spark, sf):
    """The parts that a compaction replaced are removed: the rows stay, and so few files."""
    path = _by_class(spark, sf)
    compact(spark, path)
    gone = len(expire(spark, path, before=10_000))
    rows = read_table(spark, path, GOLD)
    return rows.groupBy("label").agg(F.count("*").alias("n_rows"), F.lit(gone).cast("long").alias("n_removed"))


def _predictions_by_day(spark, sf):
    path = new_folder(spark, "predictions")
    rows = predictions(spark, sf)
    for day in range(4):
        append_commit(rows.where(F.col("event_id") % 4 == day), path, PREDICTION, commit_id=day + 1, keys=["request_id"])
    return path


def lookup_since(spark, sf):
    """Predictions of one request from the third commit on: earlier files are not listed, the others have Bloom filters."""
    stored = lookup(read_table(spark, _predictions_by_day(spark, sf), PREDICTION, since=3), "7")
    return stored.select("text", "pred_label", "pred_score", "created_at_ms", "commit_id")


def waited_prediction(spark, sf):
    """The newest prediction of a request, as a caller that waits for it gets it."""
    row = wait_for_prediction(spark, _predictions_by_day(spark, sf), "7", timeout=60, since=1)
    found = lookup(predictions(spark, sf), "7").where(F.col("created_at_ms") == row["created_at_ms"])
    return latest_per_request(found, ["created_at_ms"]).select("request_id", "created_at_ms", F.lit(row["split"]).alias("split"))


QUERIES = {
    f.__name__: f
    for f in (
        append_unfinished,
        append_concurrent,
        commit_history,
        compacted_as_of,
        expired_commits,
        lookup_since,
        waited_prediction,
    )
}

_COMMITS = "SELECT label AS class, (label + 1) * 1000 AS commit_id, vec_id FROM embeddings"

ORACLE = {
    "append_unfinished": """SELECT CASE WHEN label < 5 THEN 1000 ELSE 3000 END::BIGINT AS commit_id, count(*) AS n_rows,
  label >= 5 AS is_latest FROM embeddings GROUP BY 1, 3""",
    "append_concurrent": "SELECT 4::BIGINT AS n_commits, count(*) AS n_rows, count(DISTINCT vec_id) AS n_ids FROM embeddings",
    "commit_history": f"SELECT commit_id::BIGINT AS commit_id, count(*) AS n_rows, class = 9 AS is_latest FROM ({_COMMITS}) GROUP BY 1, 3",
    "compacted_as_of": f"""SELECT count(*) FILTER (commit_id <= 4000) AS n_early, max(vec_id) FILTER (commit_id <= 4000) AS last_early,
  count(*) AS n_rows, 1::BIGINT AS n_parts FROM ({_COMMITS})""",
    "expired_commits": f"SELECT label, count(*) AS n_rows, 10::BIGINT AS n_removed FROM ({GOLD_SQL}) GROUP BY label",
    "lookup_since": f"""SELECT text, pred_label, pred_score, created_at_ms, event_id % 4 + 1 AS commit_id FROM ({PREDICTIONS_SQL})
  WHERE request_id = '7' AND event_id % 4 >= 2""",
    "waited_prediction": f"""SELECT request_id, max(created_at_ms) AS created_at_ms, 'inference' AS split FROM ({PREDICTIONS_SQL})
  WHERE request_id = '7' GROUP BY request_id""",
}
