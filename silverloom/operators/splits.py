"""Filters on the split column."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverloom.constants import INFERENCE_SPLIT


def split_filter(df: DataFrame, value: str | None, column: str = "split") -> DataFrame:
    """Rows of one split; all rows when no value is asked for or the column does not exist."""
    if value is None or column not in df.columns:
        return df
    return df.where(F.col(column) == value)


def split_filter_or_all(df: DataFrame, value: str | None, column: str = "split") -> DataFrame:
    """The same, but all rows when the split is empty.

    One row decides, and a plain filter remains that can prune partitions.
    """
    rows = split_filter(df, value, column)
    return df if rows is df or rows.isEmpty() else rows


def inference_only(df: DataFrame, split: str = INFERENCE_SPLIT) -> DataFrame:
    """Requests of the inference split; a request without a split counts as one."""
    return df.where(F.coalesce(F.col("split"), F.lit(split)) == split)
