"""Text to vectors."""

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import IDF, HashingTF, Normalizer, SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverloom.constants import ENCODE_BATCH, VECTOR_SIZE
from silverloom.schemas import GOLD

TOKENS = "_tokens"
VECTOR = "_vector"

# Called once per task; the returned function maps a batch of texts to a 2-D array, or one vector per text.
EncoderFactory = Callable[[], Callable[[Sequence[str]], np.ndarray]]


def tokens(c: Column, max_tokens: int | None = None) -> Column:
    """Words of a cleaned text: all of them, or the first ``max_tokens``."""
    words = F.filter(F.split(c, " "), lambda w: w != "")
    return words if max_tokens is None else F.slice(words, 1, max_tokens)


def _tokenizer(text_col: str, max_tokens: int | None) -> SQLTransformer:
    words = f"filter(split({text_col}, ' '), w -> w <> '')"
    if max_tokens is not None:
        words = f"slice({words}, 1, {int(max_tokens)})"
    return SQLTransformer(statement=f"SELECT *, {words} AS {TOKENS} FROM __THIS__")


def text_stages(size: int = VECTOR_SIZE, max_tokens: int | None = None, text_col: str = "text") -> list:
    """Tokenise, hash and weight the words, and scale the vector to length one. ``max_tokens`` cuts texts off if given."""
    return [
        _tokenizer(text_col, max_tokens),
        HashingTF(inputCol=TOKENS, outputCol="_tf", numFeatures=size),
        IDF(inputCol="_tf", outputCol="_tfidf"),
        Normalizer(inputCol="_tfidf", outputCol=VECTOR),
    ]


def fit_encoder(texts: DataFrame, size: int = VECTOR_SIZE, max_tokens: int | None = None) -> PipelineModel:
    """The default encoder. The word weights are one pass of map-side sums over ``size`` counters."""
    return Pipeline(stages=text_stages(size, max_tokens)).fit(texts.select("text"))


def encode(
    df: DataFrame,
    encoder: Transformer | EncoderFactory,
    text_col: str = "text",
    out_col: str = "embedding",
    batch_size: int = ENCODE_BATCH,
    errors: bool = False,
) -> DataFrame:
    """Add one float vector per text; an empty text is encoded like any other.

    A Spark ML encoder runs in the JVM. A Python encoder is loaded once per task and receives batches of texts over
    Arrow: only the text column is sent, the other columns stay where they are. A text that makes it raise an error gets a
    null vector; with ``errors`` the column ``encode_error`` tells why.
    """
    if isinstance(encoder, Transformer):
        return _encode_ml(df, encoder, text_col, out_col)

    @F.pandas_udf("embedding array<float>, encode_error string")
    def vectors(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        run = encoder()
        for texts in batches:
            found = [_attempt(run, texts.iloc[i : i + batch_size].tolist()) for i in range(0, len(texts), batch_size)]
            both = [pair for part in found for pair in part]
            yield pd.DataFrame({"embedding": [v for v, _ in both], "encode_error": [e for _, e in both]}, dtype=object)

    names = [c for c in df.columns if c != out_col]
    encoded = df.withColumn("_encoded", vectors(F.col(text_col)))
    vector = F.col("_encoded.embedding").alias(out_col)
    return encoded.select(*names, vector, *([F.col("_encoded.encode_error")] if errors else []))


def _attempt(run: Callable[[Sequence[str]], np.ndarray], texts: list[str]) -> list[tuple[np.ndarray | None, str | None]]:
    """A vector for each text; where a batch fails, each text is tried alone and keeps its own error."""
    try:
        return [(None if v is None else np.asarray(v, dtype=np.float32), None) for v in run(texts)]
    except Exception as error:
        if len(texts) > 1:
            return [pair for text in texts for pair in _attempt(run, [text])]
        return [(None, f"{type(error).__name__}: {error}"[:500])]


def _encode_ml(df: DataFrame, encoder: Transformer, text_col: str, out_col: str) -> DataFrame:
    names = [c for c in df.columns if c != out_col]
    source = df.withColumn("text", F.col(text_col)) if text_col != "text" else df
    packed = source.select(F.struct(*[F.col(c) for c in df.columns]).alias("_row"), "text")
    out = encoder.transform(packed).select("_row.*", vector_to_array(F.col(VECTOR), "float32").alias(out_col))
    return out.select(*names, out_col)


def to_gold(df: DataFrame) -> DataFrame:
    """Encoded silver rows in the gold layout, with the defaults for absent values."""
    defaults = {"id": "", "text": "", "label": 0, "split": "unknown"}
    columns = []
    for field in GOLD.fields:
        c = F.col(field.name) if field.name in df.columns else F.lit(None)
        if field.name in defaults:
            c = F.coalesce(c, F.lit(defaults[field.name]))
        columns.append(c.cast(field.dataType).alias(field.name))
    return df.select(*columns)


def gold_from_silver(silver: DataFrame, encoder: Transformer | EncoderFactory) -> DataFrame:
    """Silver to gold: encode, then lay out."""
    return to_gold(encode(silver, encoder))
