"""Reading tables: append commits, as-of reads, lookups, listings.

A table is a Parquet folder (or a catalog table) partitioned by ``commit_id``. The id is an epoch-millisecond stamp, so
it orders the commits and dates them. Of a folder with a commit log only finished commits are read.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverloom.commits import COMMIT, WRITER, read_log, read_parts, visible
from silverloom.schemas import SILVER
from silverloom.session import is_missing_path


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, as_of: int | None = None, since: int | None = None
) -> DataFrame:
    """The table with its ``commit_id`` column; ``schema`` (without it) saves the footer reads.

    ``as_of`` gives the rows right after that commit, ``since`` those of this commit and later ones (commits that were
    compacted together count as the last of them). Other parts are not even listed.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(T.StructType(schema.fields + [T.StructField(COMMIT, T.LongType())]))
    entries = read_log(spark, path)
    if entries is None:  # a folder without a log: what it holds
        rows = reader.parquet(path).drop(WRITER)
        bounds = [F.col(COMMIT) <= as_of] * (as_of is not None) + [F.col(COMMIT) >= since] * (since is not None)
        return rows.where(bounds[0] if len(bounds) == 1 else bounds[0] & bounds[1]) if bounds else rows
    if as_of is not None and entries and entries[0].kind == "fold" and as_of < entries[0].commit_id:
        raise ValueError(f"commits before {entries[0].commit_id} have been folded: no read as of {as_of}")
    parts = visible(entries, as_of, since)
    if parts:
        return read_parts(spark, path, parts, reader)
    known = visible(entries)
    if schema is None and known:
        return read_parts(spark, path, known[:1], reader).limit(0)
    if schema is None:
        raise ValueError(f"{path} has no commit yet: give its schema")
    return spark.createDataFrame([], T.StructType(schema.fields + [T.StructField(COMMIT, T.LongType())]))


def load_table(spark: SparkSession, name: str, fallback: str) -> DataFrame:
    """The named catalog table, else the fallback table, else an error that says what to run first."""
    for candidate in dict.fromkeys((name, fallback)):
        if spark.catalog.tableExists(candidate):
            return spark.table(candidate)
    raise LookupError(f"neither {name} nor {fallback} exists: run the gold job for this table first")


def as_of(table: DataFrame, commit_id: int) -> DataFrame:
    """Rows present right after a commit. The condition is on the partition column, so later files are not opened."""
    return table.where(F.col(COMMIT) <= F.lit(commit_id)).drop(COMMIT)


def list_commits(table: DataFrame) -> DataFrame:
    """One row per commit: id, time, rows added, and whether it is the latest. Only row counts are read."""
    commits = table.groupBy(COMMIT).agg(F.count("*").alias("n_rows"))
    latest = commits.agg(F.max(COMMIT)).scalar()
    return commits.select(
        COMMIT,
        F.timestamp_millis(COMMIT).alias("committed_at"),
        "n_rows",
        (F.col(COMMIT) == latest).alias("is_latest"),
    )


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per named table."""
    counts = [t.agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows") for n, t in tables.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


def list_objects(spark: SparkSession, path: str, suffix: str = "") -> DataFrame:
    """Path, size and modification time of every file below ``path``; contents are not read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").load(path)
    )
    return files.select(F.col("path").alias("object_key"), F.col("length").alias("n_bytes"), "modificationTime")


def read_silver(spark: SparkSession, path: str, split: str | None = None) -> DataFrame | None:
    """Stored silver, or one split of it; None before the first write."""
    try:
        silver = spark.read.schema(SILVER).parquet(path)
    except AnalysisException as error:
        if is_missing_path(error):
            return None
        raise
    return silver if split is None else silver.where(F.col("split") == split)


def lookup(table: DataFrame, request_id: str) -> DataFrame:
    """Rows of one request; the equality reaches the Parquet scan."""
    return table.where(F.col("request_id") == request_id)


def describe_gold(gold: DataFrame) -> DataFrame:
    """Rows, columns and vector lengths of a gold table."""
    size = F.size("embedding")
    return gold.agg(
        F.count("*").alias("n_rows"),
        F.lit(len(gold.columns)).cast("bigint").alias("n_columns"),
        F.min(size).alias("min_dim"),
        F.max(size).alias("max_dim"),
    )
