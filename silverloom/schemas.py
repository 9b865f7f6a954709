"""Schemas of the layers."""

from pyspark.sql import types as T

REVIEW = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("label", T.IntegerType()),
        T.StructField("split", T.StringType()),
        T.StructField("request_id", T.StringType()),
    ]
)

# Stored silver rows also carry the hash of their text, so that later batches compare keys without reading texts.
SILVER = T.StructType([*REVIEW.fields, T.StructField("text_key", T.BinaryType())])

GOLD = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("label", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("split", T.StringType()),
        T.StructField("request_id", T.StringType()),
    ]
)

PREDICTION = T.StructType(
    [
        T.StructField("request_id", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("cleaned_text", T.StringType()),
        T.StructField("pred_label", T.LongType()),
        T.StructField("pred_score", T.DoubleType()),
        T.StructField("model_version", T.StringType()),
        T.StructField("created_at_ms", T.LongType()),
        T.StructField("split", T.StringType()),
    ]
)

DEAD_LETTER = T.StructType(
    [
        T.StructField("error", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
        T.StructField("payload", T.StringType()),
    ]
)

REQUEST = T.StructType(
    [
        T.StructField("request_id", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("split", T.StringType()),
        T.StructField("label", T.IntegerType()),
    ]
)
