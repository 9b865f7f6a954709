"""SimHash near-duplicates over every whole document."""

from pyspark.sql import DataFrame, SparkSession

from silverloom.llm.simhash import hexadecimal, near_duplicates
from silverloom.llm.tables import table


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", hexadecimal(found["bits"]).alias("fingerprint"), "component_id")


QUERIES = {"op9_simhash": op9_simhash}
ORACLE: dict[str, str] = {}
