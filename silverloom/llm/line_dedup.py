"""Lines that stand on many sites, kept once: built-in DataFrame functions only.

A line counts by its text without blanks at the ends; lines of blanks do not count. For the hash of each line a HyperLogLog
sketch of its sites is aggregated, partly before the shuffle, so a line that a third of all documents has reaches its reducer
as one small sketch for each task. Lines whose estimate is near the threshold or above are candidates; those near it get their
distinct sites counted exactly. A line of at least ``MIN_SITES`` sites is boilerplate and stays only where it comes first (by
doc_id, then by its place), so that text that many sites copied is not lost.

Only candidate lines are joined and counted, and only their places return to the documents. Joins of lines have tables of
their own on both sides, so that a hot line can be split among tasks.

Defined results: a null text stays null and has no lines. A null site is no site. A null doc_id comes before all others. Rows
with one doc_id and one text are one document: either both keep a line or neither. A document that loses all lines keeps an
empty text; no row is removed. An empty table gives no rows. All columns of the input stay, but an input column named n_lines
or n_removed is replaced.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverloom.llm.tables import settled

MIN_SITES = 10
#: Buckets of a sketch are 2**LOG_K; its relative standard error is 1.04 / 2**(LOG_K / 2). Near is within three of them.
LOG_K = 12
_ROW, _DROP = "_line_row", "_line_drop"


def near_width(sites: int, log_k: int = LOG_K) -> float:
    """How far from the threshold an estimate needs an exact count."""
    return max(1.0, 3 * 1.04 / 2 ** (log_k / 2) * sites)


def lines_of(docs: DataFrame, doc_id: str, text: str, site: str) -> DataFrame:
    """doc_id, row, site, pos, line (hash) of every line that counts."""
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), _row(doc_id, text).alias("row"), F.col(site).cast("string").alias("site"),
        F.posexplode(F.split(F.col(text), "\n")).alias("pos", "content"),
    )
    content = F.trim("content")
    return rows.where(content != "").select("doc_id", "row", "site", "pos", F.xxhash64(content).alias("line"))


def _row(doc_id: str, text: str):
    return F.xxhash64(doc_id, text)


def candidates(lines: DataFrame, min_sites: int) -> DataFrame:
    """line and near of all lines whose estimate is not clearly below the threshold."""
    width = near_width(min_sites)
    sketches = lines.select("line", "site").groupBy("line").agg(F.hll_sketch_agg("site", LOG_K).alias("sketch"))
    estimated = sketches.select("line", F.hll_sketch_estimate("sketch").alias("sites")).where(F.col("sites") >= min_sites - width)
    return settled(estimated.select("line", (F.col("sites") <= min_sites + width).alias("near")), "line_candidates")


def boilerplate_places(lines: DataFrame, min_sites: int) -> DataFrame:
    """doc_id, row and the places (drop) of boilerplate lines that came before in another place."""
    hits = settled(lines.join(candidates(lines, min_sites), "line"), "line_hits")
    exact = hits.where("near").select("line", "site").distinct().groupBy("line").agg(F.count("site").alias("sites"))
    first = hits.groupBy("line", "near").agg(F.min(F.struct("doc_id", "pos")).alias("first"))
    found = first.join(exact, "line", "left").where(~F.col("near") | (F.col("sites") >= min_sites)).select("line", "first")
    placed = hits.join(settled(found, "boilerplate"), "line")
    again = placed.where(~F.struct("doc_id", "pos").eqNullSafe(F.col("first")))
    return again.groupBy("doc_id", "row").agg(F.collect_set("pos").alias("drop"))


def drop_boilerplate(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", site: str = "source", min_sites: int = MIN_SITES
) -> DataFrame:
    """``docs`` with repeated boilerplate lines taken out of the text, and n_lines and n_removed."""
    docs = docs.drop("n_lines", "n_removed")
    drops = settled(boilerplate_places(lines_of(docs, doc_id, text, site), min_sites), "line_drops")
    drops = drops.select(F.col("doc_id").alias("_line_doc"), F.col("row").alias(_ROW), F.col("drop").alias(_DROP))
    same = _row(doc_id, text).eqNullSafe(drops[_ROW]) & docs[doc_id].eqNullSafe(drops["_line_doc"])
    joined = docs.join(drops, same, "left")
    lines = F.split(F.col(text), "\n")
    kept = F.array_join(F.filter(lines, lambda _, i: ~F.array_contains(F.col(_DROP), i)), "\n")
    cleaned = joined.withColumns({
        "n_lines": F.coalesce(F.size(lines), F.lit(0)).cast("long"),
        "n_removed": F.coalesce(F.size(_DROP), F.lit(0)).cast("long"),
        text: F.when(F.col(_DROP).isNull(), F.col(text)).otherwise(kept),
    })
    return cleaned.withColumn("n_lines", F.greatest("n_lines", F.lit(0))).withColumn("n_removed", F.greatest("n_removed", F.lit(0))).select(
        *docs.columns, "n_lines", "n_removed"
    )
