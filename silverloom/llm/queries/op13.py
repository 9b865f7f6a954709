"""Periodic runs of words in every whole document, a tenth of them made periodic first."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverloom.llm.periodic_runs import with_runs
from silverloom.llm.tables import table

BLANKS = r"[\x20\x09-\x0D]+"


def looped(docs: DataFrame) -> DataFrame:
    """doc_id and text; where crc32(doc_id) ends in 0, the words from a on repeat p words of the text.

    A text without words stays as it is; so does one without doc_id.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    parts = F.filter(F.split("text", BLANKS), lambda w: w != "")
    chosen = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, parts).alias("w"))
    n, g = F.size("w"), F.floor(F.col("h") / 10)
    sized = chosen.withColumn("a", F.when(n > 0, (g % n).cast("int"))).withColumn(
        "p", (1 + F.floor((n - F.col("a")) / (3 + g % 8))).cast("int")
    )
    copies = F.ceil((n - F.col("a")) / F.col("p")).cast("int")
    loop = F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), copies))
    damaged = F.array_join(F.slice(F.concat(F.slice("w", 1, F.col("a")), loop), 1, n), " ")
    return sized.select("doc_id", F.when(F.col("a").isNotNull(), damaged).otherwise(F.col("text")).alias("text"))


def longest(runs: str) -> Column:
    """The run with the greatest length; of equal ones the first, then the one of the smallest period."""
    keyed = F.transform(F.col(runs), lambda r: F.struct(-r["length"], r["start"], r["period"]))
    return F.array_min(keyed)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_runs(looped(table(spark, sf_dir, "documents").select("doc_id", "text")))
    best = found.select("doc_id", "periodic.runs", "periodic.collapsed", longest("periodic.runs").alias("best"))
    length = -F.col("best.col1")
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        length.alias("length"),
        F.col("best.period").alias("period"),
        F.floor(1000 * length / F.col("best.period")).alias("exponent_milli"),
        F.sha2(text, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {"op13_periodic_runs": op13_periodic_runs}
ORACLE: dict[str, str] = {}
