"""Byte-level BPE over every whole document."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverloom.llm.byte_bpe import Vocabulary, decode, encode
from silverloom.llm.tables import table

RANKS = "byte_bpe_multi_50k.tiktoken"


def vocabulary(spark: SparkSession) -> Vocabulary:
    return Vocabulary(spark, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def digests(encoded: DataFrame) -> list:
    """Length and hashes of the ids and of the decoded bytes."""
    return [
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    ]


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = vocabulary(spark)
    coded = decode(encode(table(spark, sf_dir, "documents").select("doc_id", "text"), words), words)
    return coded.select("doc_id", *digests(coded))


QUERIES = {"op1_byte_bpe": op1_byte_bpe}
ORACLE: dict[str, str] = {}
