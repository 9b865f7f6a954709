"""Message topics: a ``value`` column of JSON text, from a broker or from text files.

A broker is read when ``servers`` is given (the Kafka connector must then be on the class path); otherwise ``topic`` is
a folder of text files.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverloom.session import written


def topic_snapshot(spark: SparkSession, topic: str, servers: str | None = None, ordered: bool = False) -> DataFrame:
    """What the topic holds now, read once and kept: ``value`` and ``arrival``, the same for everyone who uses the result.

    Messages that come later are not in it, whatever reads it how often. With ``ordered``, ``arrival`` rises by partition and
    offset of a broker's topic, by name and place of the files of a folder; else it only tells rows apart.
    """
    if servers is None:
        place = [F.col("_metadata.file_path"), F.col("_metadata.file_block_start")]
        rows = spark.read.text(topic).select("value", *[c.alias(f"_{i}") for i, c in enumerate(place)])
    else:
        records = _broker(spark, topic, servers)
        rows = records.select(F.col("value").cast("string").alias("value"), F.col("partition").alias("_0"), F.col("offset").alias("_1"))
    rows = rows.withColumn("_2", F.monotonically_increasing_id())
    sorted_rows = rows.orderBy("_0", "_1", "_2") if ordered else rows  # numbered by the sorted partitions
    return written(sorted_rows.select("value", F.monotonically_increasing_id().alias("arrival")), "topic")


def topic_batch(spark: SparkSession, topic: str, servers: str | None = None) -> DataFrame:
    """Everything the topic holds, from its beginning; each use of the result reads anew and may find more."""
    if servers is None:
        return spark.read.text(topic).select("value")
    return _value(_broker(spark, topic, servers))


def _broker(spark: SparkSession, topic: str, servers: str) -> DataFrame:
    reader = spark.read.format("kafka").option("startingOffsets", "earliest").option("endingOffsets", "latest")
    return reader.option("kafka.bootstrap.servers", servers).option("subscribe", topic).load()


def topic_stream(
    spark: SparkSession, topic: str, servers: str | None = None, max_per_trigger: int | None = None
) -> DataFrame:
    """The topic as a stream, from its beginning on the first start and from the checkpoint later.

    ``max_per_trigger`` paces the stream: messages of a broker, files of a folder per micro-batch.
    """
    if servers is None:
        reader = spark.readStream.format("text")
        if max_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_per_trigger)
        return reader.load(topic).select("value")
    reader = spark.readStream.format("kafka").option("startingOffsets", "earliest")
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return _value(reader.option("kafka.bootstrap.servers", servers).option("subscribe", topic).load())


def _value(records: DataFrame) -> DataFrame:
    return records.select(F.col("value").cast("string").alias("value"))
