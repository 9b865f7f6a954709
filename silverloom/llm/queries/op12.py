"""Personal data in every whole document."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverloom.llm.personal_data import KINDS, fit, with_personal_spans
from silverloom.llm.tables import table


def listed(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def number(kind: str) -> Column:
    """Base spans of a kind."""
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_personal_spans(docs, fit(docs))
    return found.select("doc_id", *map(number, KINDS), F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))


QUERIES = {"op12_personal_data": op12_personal_data}
ORACLE: dict[str, str] = {}
