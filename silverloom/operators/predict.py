"""From requests to predictions."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverloom.constants import DEFAULT_MODEL_VERSION, INFERENCE_SPLIT
from silverloom.functions.scores import linear_logit, logistic, threshold_label
from silverloom.functions.text import clean_text
from silverloom.schemas import PREDICTION

# Adds ``embedding``, or ``pred_label`` and ``pred_score``, to a frame.
Step = Callable[[DataFrame], DataFrame]


def _given(name: str) -> Column:
    return F.nullif(F.col(name), F.lit(""))


def resolve_identity(requests: DataFrame, new_id: Column | None = None) -> DataFrame:
    """Fill ``request_id`` from itself, else ``id``, else a new UUID; and ``id`` from itself, else that.

    A new UUID differs every time it is computed. Write the result before using it twice, or pass ``new_id``.
    """
    fresh = F.uuid() if new_id is None else new_id
    id_ = _given("id") if "id" in requests.columns else F.lit(None).cast("string")
    rid = F.coalesce(_given("request_id"), id_, fresh)
    return requests.withColumn("request_id", rid).withColumn("id", F.coalesce(id_, F.col("request_id")))


def linear_step(weights, intercept: float = 0.0, embedding: str = "embedding") -> Step:
    """Scoring with known weights."""

    def step(df: DataFrame) -> DataFrame:
        s = logistic(linear_logit(F.col(embedding), weights, intercept))
        return df.withColumn("pred_score", s).withColumn("pred_label", threshold_label(F.col("pred_score")))

    return step


def empty_text_rule(df: DataFrame, cleaned: str = "cleaned_text", size: int | None = None) -> DataFrame:
    """An empty cleaned text scores 0 with label 0; with ``size``, its vector is zero."""
    empty = F.col(cleaned) == ""
    out = df.withColumn("pred_label", F.when(empty, F.lit(0)).otherwise(F.col("pred_label")).cast("bigint")).withColumn(
        "pred_score", F.when(empty, F.lit(0.0)).otherwise(F.col("pred_score"))
    )
    if size is not None:
        zero = F.array_repeat(F.lit(0.0).cast("float"), size)
        out = out.withColumn("embedding", F.when(empty, zero).otherwise(F.col("embedding")))
    return out


def predict(requests: DataFrame, encode: Step, score: Step, new_id: Column | None = None, size: int | None = None) -> DataFrame:
    """Resolve ids, clean, encode, score, apply the empty-text rule. One narrow pass without a shuffle.

    ``encode`` adds ``embedding`` from ``cleaned_text``, ``score`` adds ``pred_label`` and ``pred_score``.
    """
    cleaned = resolve_identity(requests, new_id).withColumn("cleaned_text", clean_text(F.col("text")))
    return empty_text_rule(score(encode(cleaned)), size=size)


def now_ms() -> Column:
    return F.unix_millis(F.current_timestamp())


def to_predictions(
    scored: DataFrame, model_version: str = DEFAULT_MODEL_VERSION, created_at_ms: Column | None = None
) -> DataFrame:
    """Rows of the predictions table."""
    values = {
        "text": F.coalesce("text", F.lit("")),
        "model_version": F.lit(model_version),
        "created_at_ms": now_ms() if created_at_ms is None else created_at_ms,
        "split": F.lit(INFERENCE_SPLIT),
    }
    columns = [(f, values[f.name] if f.name in values else F.col(f.name)) for f in PREDICTION.fields]
    return scored.select(*[c.cast(f.dataType).alias(f.name) for f, c in columns])


def to_responses(scored: DataFrame) -> DataFrame:
    """What a caller gets back."""
    return scored.select("request_id", "pred_label", "pred_score", "cleaned_text")
