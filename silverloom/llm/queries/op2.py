"""Boilerplate lines of many sites, kept once."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverloom.llm.line_dedup import MIN_SITES, drop_boilerplate
from silverloom.llm.tables import table


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = drop_boilerplate(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return cleaned.select("doc_id", "n_lines", "n_removed", F.md5("text").alias("kept_md5"))


SQL = f"""
WITH d AS (SELECT doc_id, source, string_split(text, chr(10)) AS a FROM documents WHERE text IS NOT NULL),
l AS (
    SELECT doc_id, source, i, a[i + 1] AS line, trim(a[i + 1]) AS content
    FROM (SELECT *, unnest(range(len(a))) AS i FROM d)
), b AS (
    SELECT content, min({{'doc_id': doc_id, 'i': i}}) AS first FROM l WHERE content <> ''
    GROUP BY content HAVING count(DISTINCT source) >= {MIN_SITES}
), m AS (
    SELECT l.*, b.first IS NOT NULL AND b.first <> {{'doc_id': l.doc_id, 'i': l.i}} AS gone FROM l LEFT JOIN b USING (content)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
       md5(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_md5
FROM m GROUP BY doc_id
UNION ALL SELECT doc_id, 0, 0, NULL FROM documents WHERE text IS NULL
"""

QUERIES = {"op2_line_dedup": op2_line_dedup}
ORACLE = {"op2_line_dedup": SQL}
