"""Passages of 13 words and more that stand in an earlier document, removed from every whole document."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverloom.llm.substring_dedup import remove_repeats
from silverloom.llm.tables import table


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op4_substring_dedup": op4_substring_dedup}
ORACLE: dict[str, str] = {}
