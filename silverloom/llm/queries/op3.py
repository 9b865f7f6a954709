"""The language of every whole document."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverloom.llm.language_id import fit, held_out, predict
from silverloom.llm.tables import table


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    profiles = fit(docs.where(~held_out()))
    return docs.select("doc_id", held_out().alias("held_out"), predict(F.col("text"), profiles).alias("p")).select(
        "doc_id", "held_out", "p.lang_pred", "p.score"
    )


QUERIES = {"op3_language_id": op3_language_id}
ORACLE: dict[str, str] = {}
