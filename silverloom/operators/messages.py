"""Raw rows, messages and the bronze and silver records made from them."""

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverloom.constants import INFERENCE_SPLIT, UNKNOWN_SPLIT
from silverloom.functions.coerce import bronze_label, long_text, silver_label, text_of, text_or_null
from silverloom.functions.text import clean_text
from silverloom.schemas import REVIEW
from silverloom.sources.jsonl import MESSAGE_FIELDS, with_parsed

FIELDS = REVIEW.fieldNames()


class Checked(NamedTuple):
    """Accepted records, and the rejected ones as ``value`` (the original message) and ``error``."""

    good: DataFrame
    quarantine: DataFrame


def reviews_from_raw(df: DataFrame, split: str = UNKNOWN_SPLIT, index: str = "id") -> DataFrame:
    """Raw ``text``, ``label`` rows as reviews. A label other than 0 or 1 fails the query and is named."""
    bad = F.concat(F.lit("unexpected label: "), F.coalesce(F.col("label").cast("string"), F.lit("null")))
    label = F.when(F.col("label").isin(0, 1), F.col("label").cast("int")).otherwise(F.raise_error(bad).cast("int"))
    return df.select(
        F.col(index).cast("string").alias("id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        label.alias("label"),
        F.lit(split).alias("split"),
        F.lit(None).cast("string").alias("request_id"),
    )


def _checked(df: DataFrame, label: Column, keep: list[str]) -> DataFrame:
    error = (
        F.when(F.col("parsed").isNull(), "malformed message")
        .when(F.col("label").isNull(), F.concat(F.lit("invalid label: "), F.to_json("parsed.label")))
    )
    return df.withColumn("label", label).withColumn("error", error).select("value", "parsed", "label", "error", *keep)


def _extra_columns(messages: DataFrame, value: str) -> list[str]:
    return [c for c in messages.columns if c != value]


def _split(rows: DataFrame, columns: dict[str, Column], keep: list[str], settle: Callable[[DataFrame], DataFrame] | None) -> Checked:
    """Good and bad rows; ``settle`` gets both as one table, whose messages are parsed and cleaned when it is made and not again."""
    if settle is not None:
        ok = F.col("error").isNull()
        both = [F.when(ok, c).alias(name) for name, c in columns.items()]
        rows = settle(rows.select(F.when(~ok, F.col("value")).alias("value"), "error", *both, *keep))
        columns = {name: F.col(name) for name in columns}
    good = rows.where("error is null").select(*[c.alias(name) for name, c in columns.items()], *keep)
    return Checked(good, rows.where("error is not null").select("value", "error"))


def bronze_from_messages(
    messages: DataFrame, default_split: str, value: str = "value", settle: Callable[[DataFrame], DataFrame] | None = None
) -> Checked:
    """Messages as bronze records, leniently: falsy labels are 0, numbers are truncated, other values pass unchecked.

    Other columns of ``messages`` (an order, an offset) are kept on the good side. ``settle`` writes a table and reads it back:
    who uses both sides has the messages parsed once.
    """
    keep = _extra_columns(messages, value)
    parsed = with_parsed(messages.withColumnRenamed(value, "value"), MESSAGE_FIELDS)
    rows = _checked(parsed, bronze_label(F.col("parsed.label")), keep)
    columns = {
        "id": text_of(F.col("parsed.id")),
        "text": long_text(F.col("parsed.text")),
        "label": F.col("label"),
        "split": F.coalesce(text_or_null(F.col("parsed.split")), F.lit(default_split)),
        "request_id": _request_id(F.col("parsed.request_id")),
    }
    return _split(rows, columns, keep, settle)


def silver_from_messages(
    messages: DataFrame, value: str = "value", settle: Callable[[DataFrame], DataFrame] | None = None
) -> Checked:
    """Bronze lines as silver records, strictly: the label must equal 0 or 1, the text is cleaned. ``settle`` as for bronze."""
    keep = _extra_columns(messages, value)
    parsed = with_parsed(messages.withColumnRenamed(value, "value"), MESSAGE_FIELDS)
    rows = _checked(parsed, silver_label(F.col("parsed.label")), keep)
    columns = {
        "id": text_of(F.col("parsed.id")),
        "text": clean_text(long_text(F.col("parsed.text"))),
        "label": F.col("label"),
        "split": text_of(F.col("parsed.split"), UNKNOWN_SPLIT),
        "request_id": _request_id(F.col("parsed.request_id")),
    }
    return _split(rows, columns, keep, settle)


def silver_from_bronze(bronze: DataFrame) -> Checked:
    """The same for bronze records that are already columns."""
    keep = [c for c in bronze.columns if c not in FIELDS]
    label = F.coalesce("label", F.lit(0))
    ok = label.isin(0, 1)
    good = bronze.where(ok).select(
        F.coalesce("id", F.lit("")).alias("id"),
        clean_text(F.col("text")).alias("text"),
        label.cast("int").alias("label"),
        F.coalesce("split", F.lit(UNKNOWN_SPLIT)).alias("split"),
        "request_id",
        *keep,
    )
    error = F.concat(F.lit("invalid label: "), label.cast("string"))
    bad = bronze.where(~ok).select(to_message(bronze).alias("value"), error.alias("error"))
    return Checked(good, bad)


def _request_id(v: Column) -> Column:
    return F.nullif(text_of(v, ""), F.lit(""))


def to_message(df: DataFrame) -> Column:
    """A review as JSON text; ``request_id`` appears only when set."""
    return F.to_json(F.struct(*[F.col(c) for c in FIELDS if c in df.columns]))


def build_requests(df: DataFrame, request_id: str = "request_id", text: str = "text") -> DataFrame:
    """Scoring requests in the message layout: id equals request_id, label 0, split inference."""
    rid = F.col(request_id).cast("string")
    return df.select(
        rid.alias("id"),
        F.col(text).alias("text"),
        F.lit(0).alias("label"),
        F.lit(INFERENCE_SPLIT).alias("split"),
        rid.alias("request_id"),
    )


def requests_from_messages(messages: DataFrame, value: str = "value") -> DataFrame:
    """Request messages as columns, with ``error`` set where a message cannot be scored.

    ``split`` is null only when the field is missing: a JSON null does not count as an inference request.
    """
    parsed = with_parsed(messages.withColumnRenamed(value, "value"), MESSAGE_FIELDS)
    rows = _checked(parsed, bronze_label(F.col("parsed.label")), [])
    split = F.col("parsed.split")
    return rows.select(
        text_or_null(F.col("parsed.request_id")).alias("request_id"),
        text_or_null(F.col("parsed.id")).alias("id"),
        long_text(F.col("parsed.text")).alias("text"),
        F.when(split.isNotNull(), text_of(split)).alias("split"),
        "label",
        "error",
        F.col("value").alias("payload"),
    )
