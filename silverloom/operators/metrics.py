"""Counts, histograms and accuracy."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverloom.constants import REQUEST_BOUNDS


def counters(df: DataFrame, *labels: str) -> DataFrame:
    """Rows per label combination."""
    return df.groupBy(*labels).agg(F.count("*").alias("n"))


def histogram(
    df: DataFrame, value: str, bounds: Sequence[float] = REQUEST_BOUNDS, labels: Sequence[str] = ()
) -> DataFrame:
    """Cumulative buckets: observations up to each bound, with ``+Inf`` for all, and their total and count.

    One pass computes every bucket; the few result rows are then unfolded.
    """
    v = F.col(value)
    buckets = [F.coalesce(F.sum(F.when(v <= b, 1).otherwise(0)), F.lit(0)).alias(f"b{i}") for i, b in enumerate(bounds)]
    sums = df.where(v.isNotNull()).groupBy(*labels).agg(
        *buckets, F.count("*").alias("total_count"), F.coalesce(F.sum(v), F.lit(0.0)).alias("total_sum")
    )
    rows = [F.struct(F.lit(str(b)).alias("le"), F.col(f"b{i}").alias("n")) for i, b in enumerate(bounds)]
    rows.append(F.struct(F.lit("+Inf").alias("le"), F.col("total_count").alias("n")))
    return sums.select(*labels, F.inline(F.array(*rows)), "total_count", "total_sum")


def accuracy(df: DataFrame, predicted: str = "pred_label", label: str = "label") -> DataFrame:
    """Rows and the share of right predictions; the share is null without rows."""
    hit = (F.col(predicted).cast("bigint") == F.col(label).cast("bigint")).cast("double")
    return df.agg(F.count("*").alias("n_rows"), F.avg(hit).alias("accuracy"))


def class_summary(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows, the number of distinct labels, and the lowest and highest of them."""
    return counters(df, label).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count(label).alias("n_labels"),
        F.min(label).alias("min_label"),
        F.max(label).alias("max_label"),
    )


def require_two_classes(df: DataFrame, label: str = "label") -> int:
    """The number of rows; an error when there are none or only one class among them."""
    row = class_summary(df, label).first()
    if row["n_rows"] == 0:
        raise ValueError("no training rows")
    if row["n_labels"] < 2:
        raise ValueError(f"every training row is labelled {row['min_label']}: nothing to tell apart")
    return row["n_rows"]
