"""Keep-first deduplication on (text, label, split)."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TEXT_KEY = "text_key"
KEY = ["text_key", "_label", "_split"]


def text_key(c: Column) -> Column:
    """A fixed-width stand-in for a text of any length; a null text counts as empty."""
    return F.unhex(F.sha2(F.coalesce(c, F.lit("")), 256))


def with_key(df: DataFrame) -> DataFrame:
    key = text_key(F.col("text")) if TEXT_KEY not in df.columns else None
    return df.select(
        "*",
        *([] if TEXT_KEY in df.columns else [key.alias(TEXT_KEY)]),
        F.coalesce(F.col("label").cast("int"), F.lit(0)).alias("_label"),
        F.coalesce(F.col("split"), F.lit("")).alias("_split"),
    )


def dedup_keys(df: DataFrame) -> DataFrame:
    """The distinct keys of ``df``: what a later batch needs to know about an earlier one.

    A ``text_key`` column, when ``df`` stores one, is used instead of hashing the texts again, so only narrow columns
    are read.
    """
    keyed = df if set(KEY) <= set(df.columns) else with_key(df)
    return keyed.select(*KEY).distinct()


def dedup_keep_first(
    df: DataFrame,
    order: str | Sequence[str],
    existing: DataFrame | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """One row per (text, label, split): the first in ``order``; keys already in ``existing`` are dropped.

    Each task keeps one row per key before the shuffle, so a text copied into a third of all rows still reaches its
    reducer as one row per task. The anti join comes after that, on the same partitioning, with unique keys on both
    sides. ``keep`` narrows the columns that travel.
    """
    columns = list(keep or [c for c in df.columns if c != TEXT_KEY])
    order = [order] if isinstance(order, str) else list(order)
    ordering = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    first = F.min_by(F.struct(*columns), ordering).alias("_first")
    survivors = with_key(df).groupBy(*KEY).agg(first)
    if existing is not None:
        survivors = survivors.join(dedup_keys(existing), KEY, "left_anti")
    return survivors.select("_first.*")


def dedup_counts(df: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Rows read, kept and skipped, from the keys alone: no text is shuffled."""
    groups = with_key(df).groupBy(*KEY).agg(F.count("*").alias("n"))
    if existing is None:
        kept = F.lit(1)
    else:
        seen = dedup_keys(existing).withColumn("_seen", F.lit(True))
        groups = groups.join(seen, KEY, "left")
        kept = F.when(F.col("_seen").isNull(), 1).otherwise(0)
    total = F.coalesce(F.sum("n"), F.lit(0))
    written = F.coalesce(F.sum(kept), F.lit(0))
    return groups.agg(total.alias("n_valid"), written.alias("n_kept"), (total - written).alias("n_skipped"))
