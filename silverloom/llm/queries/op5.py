"""Near-duplicates among all embeddings."""

from pyspark.sql import DataFrame, SparkSession

from silverloom.llm.pq_dedup import near_duplicates
from silverloom.llm.tables import table


def op5_pq_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return found.withColumn("kept", found["vec_id"] == found["component_id"])


QUERIES = {"op5_pq_dedup": op5_pq_dedup}
ORACLE: dict[str, str] = {}
