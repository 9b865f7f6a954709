"""File and topic sinks of the layers."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverloom.operators.dedup import TEXT_KEY, text_key
from silverloom.operators.messages import to_message
from silverloom.schemas import REVIEW


def write_layer(df: DataFrame, path: str, rows_per_file: int = 0, mode: str = "append") -> None:
    """Complete JSON lines below ``path/split=<split>/``; null fields are left out.

    Every task writes one file per split, or several of at most ``rows_per_file`` lines.
    """
    lines = df.select(to_message(df).alias("value"), "split")
    lines.write.mode(mode).partitionBy("split").option("maxRecordsPerFile", rows_per_file).text(path)


def write_silver(df: DataFrame, path: str, mode: str = "append") -> None:
    """Silver as Parquet below ``path/split=<split>/``, each row with its ``text_key``."""
    keyed = df.select(*REVIEW.fieldNames(), text_key(F.col("text")).alias(TEXT_KEY))
    keyed.write.mode(mode).partitionBy("split").parquet(path)


def write_gold_parquet(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).option("compression", "snappy").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, quotes doubled, for BI tools."""
    keep_blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(header=True, escape='"', **keep_blanks).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What ``write_csv`` wrote; texts may hold line breaks."""
    return spark.read.schema(schema).options(header=True, escape='"', multiLine=True).csv(path)


def publish(df: DataFrame, topic: str, servers: str | None = None, mode: str = "append") -> None:
    """Send reviews or requests as JSON messages: to a broker when ``servers`` is given, else to text files (in ``mode``)."""
    messages = df.select(to_message(df).alias("value"))
    if servers is None:
        messages.write.mode(mode).text(topic)
    else:
        send(messages, topic, servers)


def send(messages: DataFrame, topic: str, servers: str) -> None:
    """Send messages, a column ``value``, to a topic of a broker."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def write_dead_letters(df: DataFrame, path: str, mode: str = "append", servers: str | None = None) -> None:
    """Failed messages as ``{error, ts_ms, payload}``: to the topic ``path`` of a broker when ``servers`` is given, else as lines."""
    letters = df.select(F.to_json(F.struct("error", "ts_ms", "payload")).alias("value"))
    if servers is None:
        letters.write.mode(mode).text(path)
    else:
        letters.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", path).save()
