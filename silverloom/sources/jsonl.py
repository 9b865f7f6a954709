"""JSON lines: scan, parse, keep the malformed ones apart."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverloom.constants import WHITE_SPACE

ORDER = "line_order"

# Spark names the files of its text sink *.txt.
FILES = "*.{jsonl,json,txt}"

MESSAGE_FIELDS = "id variant, text variant, label variant, split variant, request_id variant"


def strip_blanks(line: Column) -> Column:
    """A line without white space of any kind at its ends."""
    return F.regexp_replace(line, f"^{WHITE_SPACE}+|{WHITE_SPACE}+$", "")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank lines of every JSON lines file below ``path``: ``value`` and ``line_order``.

    ``line_order`` sorts by file, then by position in the file. It is taken at the scan, before any shuffle.
    """
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", FILES).text(path)
    order = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    return lines.select(strip_blanks(F.col("value")).alias("value"), order.alias(ORDER)).where("value <> ''")


def with_parsed(lines: DataFrame, fields: str, out: str = "parsed", value: str = "value") -> DataFrame:
    """Add ``out``: one struct of ``fields``, NULL where the line is not exactly one JSON object.

    Reading the line as a one-element array makes trailing content an error. The explode of a one-element array keeps
    the parse from being copied into every filter that is later put on its fields.
    """
    parsed = F.from_json(
        F.concat(F.lit("["), F.col(value), F.lit("]")), f"array<struct<{_typed(fields)}>>", {"allowSingleQuotes": "false"}
    )
    rows = lines.select("*", F.explode(F.array(parsed)).alias("_rows"))
    one = F.when(F.size("_rows") == 1, F.element_at("_rows", 1))
    return rows.withColumn(out, one).drop("_rows")


def _typed(fields: str) -> str:
    return ", ".join(":".join(part.split(None, 1)) for part in fields.split(", "))


def split_malformed(lines: DataFrame, fields: str, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Parsed lines, and the lines that are not one JSON object as ``value`` and ``error``."""
    parsed = with_parsed(lines, fields, value=value)
    bad = parsed.where(F.col("parsed").isNull())
    good = parsed.where(F.col("parsed").isNotNull())
    return good, bad.select(F.col(value).alias("value"), F.lit("malformed message").alias("error"))


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Records of the well-formed lines below ``path``, typed by ``schema``; the other lines are skipped."""
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    good = with_parsed(read_lines(spark, path), fields).where(F.col("parsed").isNotNull())
    return good.select("parsed.*", ORDER)
