"""Scoring a stream of requests into four sinks and a dead-letter topic."""

import time
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from silverloom.commits import child_names, remove_path
from silverloom.constants import DEFAULT_MODEL_VERSION, INFERENCE_SPLIT, VECTOR_SIZE
from silverloom.models.encode import to_gold
from silverloom.operators.messages import requests_from_messages, to_message
from silverloom.operators.predict import Step, now_ms, predict, to_predictions
from silverloom.operators.splits import inference_only
from silverloom.schemas import GOLD, PREDICTION
from silverloom.sinks.files import write_dead_letters
from silverloom.sinks.tables import append_commit, compact
from silverloom.streaming.run import batch_stamp, replace_batch, stream_id

#: Batches between two compactions of the tables a stream appends to, and the column their rows are looked up by.
COMPACT_EVERY = 50
LOOKED_UP = ["request_id"]


class Sinks(NamedTuple):
    """Folders; all but ``staging`` and ``gold`` are always written. Set ``gold`` to None to leave it out.

    With ``dead_letter_servers`` the dead letters go to the topic ``dead_letters`` of that broker; a batch that is replayed may
    send its letters twice.
    """

    staging: str
    bronze: str
    silver: str
    predictions: str
    dead_letters: str
    gold: str | None = None
    dead_letter_servers: str | None = None


class BatchReport(NamedTuple):
    batch_id: int
    consumed: int
    succeeded: int
    failed: int
    seconds: float
    gold_error: str | None


def score_requests(
    messages: DataFrame, encode: Step, score: Step, size: int = VECTOR_SIZE, created_at_ms: Column | None = None
) -> DataFrame:
    """Request messages to scored rows; ``error`` is set where a message could not be parsed or encoded."""

    def encode_or_mark(df: DataFrame) -> DataFrame:
        encoded = encode(df)
        if "encode_error" not in encoded.columns:
            encoded = encoded.withColumn("encode_error", F.lit(None).cast("string"))
        failed = F.col("embedding").isNull() & (F.col("cleaned_text") != "")
        zero = F.array_repeat(F.lit(0.0).cast("float"), size)
        return encoded.withColumn(
            "error", F.when(F.col("error").isNull() & failed, F.coalesce("encode_error", F.lit("encoding failed"))).otherwise(F.col("error"))
        ).withColumn("embedding", F.coalesce("embedding", zero)).drop("encode_error")

    requests = inference_only(requests_from_messages(messages))
    scored = predict(requests, encode_or_mark, score, size=size)
    stamp = now_ms() if created_at_ms is None else created_at_ms
    return scored.withColumn("split", F.lit(INFERENCE_SPLIT)).withColumn("created_at_ms", stamp)


def write_batch(
    batch: DataFrame,
    batch_id: int,
    encode: Step,
    score: Step,
    sinks: Sinks,
    size: int = VECTOR_SIZE,
    model_version: str = DEFAULT_MODEL_VERSION,
    created_at_ms: Column | None = None,
    compact_every: int = COMPACT_EVERY,
) -> BatchReport:
    """Score one micro-batch and write it everywhere, in order: bronze, silver, predictions, gold, dead letters.

    The scored rows are written to the staging folder first and every sink reads them from there, so all sinks see the
    same generated ids even when executors are lost in between. Each sink replaces its own part for this batch, which
    makes a replay harmless. Gold is best effort; its failure is reported and does not stop the predictions.

    Every ``compact_every`` batches the small commits of predictions and gold are put together (0: never). What earlier
    batches of this stream have staged is removed: a stream only ever replays its last batch.
    """
    started = time.monotonic()
    spark = batch.sparkSession
    stream = stream_id(batch)
    commit = batch_stamp(spark, sinks.staging, stream, batch_id)
    ok = F.col("error").isNull()
    scored = score_requests(batch, encode, score, size, created_at_ms)
    staged_path = f"{sinks.staging}/stream={stream}/batch_id={batch_id}"
    scored.write.mode("overwrite").parquet(staged_path)
    staged = spark.read.schema(scored.schema).parquet(staged_path)
    good = staged.where(ok)

    for path, text in ((sinks.bronze, "text"), (sinks.silver, "cleaned_text")):
        records = good.select("id", F.col(text).alias("text"), "label", "split", "request_id")
        lines = records.select(to_message(records).alias("value"), "split")
        replace_batch(lines, path, stream, batch_id, "text", "split")

    writer = f"{stream}-{batch_id}"
    predictions = to_predictions(good, model_version, F.col("created_at_ms"))
    _with_tries(lambda: append_commit(predictions, sinks.predictions, PREDICTION, commit, writer=writer, keys=LOOKED_UP))

    gold_error = None
    if sinks.gold is not None:
        try:
            gold = to_gold(good.withColumn("text", F.col("cleaned_text")))
            append_commit(gold, sinks.gold, GOLD, commit, writer=writer)
        except Exception as error:
            gold_error = str(error).splitlines()[0]

    letters = staged.where(~ok).select("error", F.col("created_at_ms").alias("ts_ms"), "payload")
    if sinks.dead_letter_servers is not None:
        write_dead_letters(letters, sinks.dead_letters, servers=sinks.dead_letter_servers)
    else:
        write_dead_letters(letters, f"{sinks.dead_letters}/stream={stream}/batch_id={batch_id}", mode="overwrite")

    if compact_every and (batch_id + 1) % compact_every == 0:
        compact(spark, sinks.predictions, before=commit, keys=LOOKED_UP)
        if sinks.gold is not None:
            compact(spark, sinks.gold, before=commit)
    _tidy(spark, sinks.staging, stream, batch_id)

    counts = staged.agg(F.count("*").alias("consumed"), F.count_if(ok).alias("succeeded")).first()
    return BatchReport(
        batch_id,
        counts["consumed"],
        counts["succeeded"],
        counts["consumed"] - counts["succeeded"],
        time.monotonic() - started,
        gold_error,
    )


def _tidy(spark: SparkSession, staging: str, stream: str, batch_id: int) -> None:
    """Remove staged rows and stamps of batches that cannot be replayed any more."""
    for folder in (f"{staging}/stream={stream}", f"{staging}/stamps/stream={stream}"):
        for name in child_names(spark, folder):
            number = name.removeprefix("batch_id=")
            if number.isdigit() and int(number) < batch_id:
                remove_path(spark, f"{folder}/{name}")


def _with_tries(write: Callable[[], object], tries: int = 3, wait: float = 2.0) -> None:
    for attempt in range(tries):
        try:
            write()
            return
        except Exception:
            if attempt == tries - 1:
                raise
            time.sleep(wait)


def inference_stream(
    messages: DataFrame,
    encode: Step,
    score: Step,
    sinks: Sinks,
    checkpoint: str,
    size: int = VECTOR_SIZE,
    model_version: str = DEFAULT_MODEL_VERSION,
    on_batch: Callable[[BatchReport], None] | None = None,
    compact_every: int = COMPACT_EVERY,
) -> DataStreamWriter:
    """The streaming query; ``on_batch`` receives the counts and the duration of each batch."""

    def process(batch: DataFrame, batch_id: int) -> None:
        report = write_batch(batch, batch_id, encode, score, sinks, size, model_version, compact_every=compact_every)
        if on_batch is not None:
            on_batch(report)

    return messages.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
