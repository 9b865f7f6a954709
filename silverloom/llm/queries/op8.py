"""400-byte strings that stand anywhere else too, removed from every whole document."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverloom.llm.suffix_dedup import remove_repeats
from silverloom.llm.tables import table


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select(
        "doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


QUERIES = {"op8_suffix_array_dedup": op8_suffix_array_dedup}
ORACLE: dict[str, str] = {}
