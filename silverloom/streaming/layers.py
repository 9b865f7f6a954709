"""Topic to bronze, and bronze to silver, as streams."""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.storagelevel import StorageLevel

from silverloom.commits import path_exists
from silverloom.operators.dedup import TEXT_KEY, dedup_keep_first, text_key, with_key
from silverloom.operators.messages import bronze_from_messages, silver_from_messages, to_message
from silverloom.operators.seen import SeenKeys
from silverloom.session import is_missing_path
from silverloom.streaming.run import batch_stamp, replace_batch, stream_id

ARRIVAL = "_arrival"
STREAM_KEY = [TEXT_KEY, "label", "split"]


def bronze_stream(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    default_split: str,
    quarantine_path: str | None = None,
    rows_per_file: int = 0,
    name: str | None = None,
) -> DataStreamWriter:
    """Parse, validate and route messages to ``path/split=<split>/``; invalid ones go to ``quarantine_path``.

    Without ``quarantine_path`` they go to the folder ``<path>_rejected``.

    Metric ``bronze`` of the query counts the messages of each batch.
    """

    rejected = quarantine_path or f"{path.rstrip('/')}_rejected"

    def process(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            good, bad = bronze_from_messages(batch, default_split)
            lines = good.select(to_message(good).alias("value"), "split")
            stream = stream_id(batch)
            replace_batch(lines, path, stream, batch_id, "text", "split", maxRecordsPerFile=rows_per_file)
            replace_batch(bad, rejected, stream, batch_id, "json")
        finally:
            batch.unpersist()

    observed = messages.observe("bronze", F.count(F.lit(1)).alias("consumed"))
    return _writer(observed, process, checkpoint, name)


def silver_stream(
    lines: DataFrame, path: str, checkpoint: str, dedup: bool = True, name: str | None = None
) -> DataStreamWriter:
    """Clean and deduplicate bronze lines into the Parquet folder ``path``, against itself and within each batch.

    The keys of what has been written are indexed in the folder ``<path>_keys``; a batch reads only the buckets its own keys
    fall into. Rows of the same batch are never compared with: a replayed batch gives the same result. Lines that do not
    become silver go to the folder ``<path>_rejected``.
    """
    base = path.rstrip("/")
    covered: list[str] = []  # once in each run the index is compared with the layer

    def process(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            stream = stream_id(batch)
            good, bad = silver_from_messages(batch)
            replace_batch(bad, f"{path.rstrip('/')}_rejected", stream, batch_id, "json")
            if dedup:
                ordered = good.withColumn(ARRIVAL, F.monotonically_increasing_id())
                seen, writer = SeenKeys(batch.sparkSession, f"{base}_keys"), f"{stream}-{batch_id}"
                if not covered:
                    seen.cover(_earlier(batch.sparkSession, path, stream, batch_id), writer)
                    covered.append(writer)
                earlier = seen.near(with_key(good), writer)
                good = dedup_keep_first(ordered, ARRIVAL, earlier, keep=good.columns)
            replace_batch(good.withColumn(TEXT_KEY, text_key(F.col("text"))), path, stream, batch_id, "parquet")
            if dedup:
                written = f"{base}/stream={stream}/batch_id={batch_id}"
                if path_exists(batch.sparkSession, written):
                    rows = batch.sparkSession.read.schema(f"{TEXT_KEY} binary, label int, split string").parquet(written)
                    seen.add(rows, batch_stamp(batch.sparkSession, f"{base}_keys/_runs", stream, batch_id), writer)
        finally:
            batch.unpersist()

    return _writer(lines, process, checkpoint, name)


def _earlier(spark: SparkSession, path: str, stream: str, batch_id: int) -> DataFrame | None:
    """Keys of what other streams and the earlier batches of this one have written."""
    schema = f"{TEXT_KEY} binary, label int, split string, stream string, batch_id bigint"
    try:
        keys = spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if is_missing_path(error):
            return None
        raise
    return keys.where((F.col("stream") != stream) | (F.col("batch_id") < batch_id)).drop("stream", "batch_id")


def dedup_stream(silver: DataFrame, time: str | None = None, within: str | None = None) -> DataFrame:
    """Streaming deduplication that keeps every key once in the state store; any one row per key survives.

    Before the shuffle each Arrow batch of a task is thinned to one row per key, without state, so a text that floods the
    stream reaches its reducer a few times only. With ``within`` (and the timestamp column ``time``) a key is forgotten after
    that delay, which bounds the state. Call ``large_state`` first to keep the state outside the heap.
    """
    keyed = silver.withColumn(TEXT_KEY, text_key(F.col("text")))
    thinned = keyed.mapInArrow(_one_of_each, keyed.schema)
    if within is None:
        return thinned.dropDuplicates(STREAM_KEY).drop(TEXT_KEY)
    return thinned.withWatermark(time, within).dropDuplicatesWithinWatermark(STREAM_KEY).drop(TEXT_KEY)


def _one_of_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of each key in a batch."""
    for batch in batches:
        keys = pa.table([*(batch.column(c) for c in STREAM_KEY), pa.array(range(batch.num_rows))], [*STREAM_KEY, "row"])
        first = keys.group_by(STREAM_KEY).aggregate([("row", "min")]).column("row_min").combine_chunks()
        yield batch.take(first.sort())


def large_state(spark: SparkSession) -> None:
    """Keep streaming state in RocksDB, outside the heap: the keys of a deduplication without end outgrow memory."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def _writer(df: DataFrame, process, checkpoint: str, name: str | None) -> DataStreamWriter:
    writer = df.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return writer.queryName(name) if name else writer
