"""The main text of every page."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverloom.llm.html_extract import main_text
from silverloom.llm.tables import table


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


QUERIES = {"op7_html_extraction": op7_html_extraction}
ORACLE: dict[str, str] = {}
