"""All documents in 40 shards, equal texts together where the row quotas allow."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverloom.llm.sharding import balanced_shards, measured
from silverloom.llm.tables import table

SHARDS = 40


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = balanced_shards(measured(table(spark, sf_dir, "documents").select("doc_id", "text")), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


QUERIES = {"op10_sharding": op10_sharding}
ORACLE: dict[str, str] = {}
