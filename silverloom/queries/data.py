"""The test tables as reviews, messages, vectors, requests and predictions; in Spark and in SQL."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverloom.operators.messages import build_requests

# Label fragments of a message, and what bronze and silver make of each. None: the record is rejected.
LABEL_CASES = [
    # (fragment, bronze, silver)
    ("", 0, 0),
    ("null", 0, None),
    ("0", 0, 0),
    ("1", 1, 1),
    ("2", 2, None),
    ("-3", -3, None),
    ("true", 1, 1),
    ("false", 0, 0),
    ("1.0", 1, 1),
    ("1.9", 1, None),
    ('"1"', 1, None),
    ('" 1 "', 1, None),
    ('"1.0"', None, None),
    ('"abc"', None, None),
    ('""', 0, None),
    ("[1]", None, None),
    ('{"a":1}', None, None),
    ("[]", 0, None),
    ("{}", 0, None),
]
# Whole lines that are not review objects, and one empty object.
LINE_CASES = ["bad", "[1]", "{}"]
N_CASES = len(LABEL_CASES) + len(LINE_CASES)
EMPTY_OBJECT = N_CASES - 1

# Any fixed weights do; these are spread over both signs.
WEIGHTS = [((i * 37) % 64 - 31.5) / 64 for i in range(64)]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def texts(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table of texts."""
    return table(spark, sf, name)


def split_of(key: Column) -> Column:
    """A seeded train/test assignment, about 3 to 13."""
    digit = F.substring(F.md5(F.concat(F.lit("split:"), key.cast("string"))), 1, 1)
    return F.when(digit.isin("0", "1", "2"), "test").otherwise("train")


def split_sql(key: str) -> str:
    return f"CASE WHEN substr(md5('split:' || {key}::VARCHAR), 1, 1) IN ('0','1','2') THEN 'test' ELSE 'train' END"


def reviews(spark: SparkSession, sf: str, how: str = "inner") -> DataFrame:
    """Documents with their label; with ``how='left'`` also the unlabelled ones, as label 0."""
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    docs = table(spark, sf, "documents").select("doc_id", "text").join(labels, "doc_id", how)
    return docs.select(
        "doc_id",
        F.col("doc_id").cast("string").alias("id"),
        "text",
        F.coalesce("quality", F.lit(0)).cast("int").alias("label"),
        split_of(F.col("doc_id")).alias("split"),
        F.lit(None).cast("string").alias("request_id"),
    )


REVIEWS_SQL = f"""SELECT doc_id, doc_id::VARCHAR AS id, text, coalesce(quality, 0)::INTEGER AS label,
  {split_sql('doc_id')} AS split FROM documents JOIN labels USING (doc_id)"""
REVIEWS_ALL_SQL = REVIEWS_SQL.replace("JOIN labels", "LEFT JOIN labels")


def messages(spark: SparkSession, sf: str) -> DataFrame:
    """Every document as one message line; the label takes the forms of LABEL_CASES in turn."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    case = F.pmod("doc_id", F.lit(N_CASES))
    body = F.to_json(F.struct(F.col("doc_id").cast("string").alias("id"), "text", split_of(F.col("doc_id")).alias("split")))
    fragments = F.array(*[F.lit(f) for f, _, _ in LABEL_CASES])
    opened = F.substr(body, F.lit(1), F.length(body) - 1)
    labelled = F.concat(opened, F.lit(',"label":'), F.get(fragments, case.cast("int")), F.lit("}"))
    line = F.when(case == 0, body).when(case < len(LABEL_CASES), labelled)
    for i, text in enumerate(LINE_CASES):
        line = line.when(case == len(LABEL_CASES) + i, F.lit(text))
    return docs.select(line.alias("value"), "doc_id")


def _case_sql(values: list, other: str = "NULL") -> str:
    whens = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values) if v is not None)
    return f"CASE doc_id % {N_CASES} {whens} ELSE {other} END"


BRONZE_LABEL_SQL = _case_sql([b for _, b, _ in LABEL_CASES] + [None, None, 0])
SILVER_LABEL_SQL = _case_sql([s for _, _, s in LABEL_CASES] + [None, None, 0])


def _errors(column: int) -> list:
    quoted = ["'invalid label: " + f + "'" if case[column] is None else None for case in LABEL_CASES for f in [case[0]]]
    return quoted + ["'malformed message'", "'malformed message'", None]


BRONZE_ERROR_SQL = _case_sql(_errors(1))
SILVER_ERROR_SQL = _case_sql(_errors(2))


def message_sql(label: str, text: str, default_split: str) -> str:
    """The records made of ``messages``."""
    empty = f"doc_id % {N_CASES} = {EMPTY_OBJECT}"
    return f"""SELECT CASE WHEN {empty} THEN '' ELSE doc_id::VARCHAR END AS id,
  CASE WHEN {empty} THEN '' ELSE {text} END AS text, ({label})::INTEGER AS label,
  CASE WHEN {empty} THEN '{default_split}' ELSE {split_sql('doc_id')} END AS split, doc_id
  FROM documents WHERE ({label}) IS NOT NULL"""


# The white-space class spelled out, for an engine without the Unicode property.
WS_SQL = (
    r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}-\x{2029}\x{202f}\x{205f}\x{3000}]+"
)


def html_sql(c: str) -> str:
    return f"regexp_replace({c}, '<[^>]+>', ' ', 'g')"


def ws_sql(c: str) -> str:
    return f"trim(regexp_replace({c}, '{WS_SQL}', ' ', 'g'))"


def strip_sql(c: str) -> str:
    return rf"regexp_replace(regexp_replace({c}, '^{WS_SQL}', ''), '{WS_SQL}$', '')"


def clean_sql(c: str) -> str:
    return f"lower({ws_sql(html_sql(c))})"


def gold(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors with a binary label and a split."""
    vectors = table(spark, sf, "embeddings")
    vec_id = F.col("vec_id").cast("string")
    return vectors.select(
        vec_id.alias("id"),
        F.concat(F.lit("vector "), vec_id).alias("text"),
        (F.col("label") >= 5).cast("bigint").alias("label"),
        "embedding",
        split_of(F.col("vec_id")).alias("split"),
        F.lit(None).cast("string").alias("request_id"),
        F.col("label").alias("class"),
    )


GOLD_SQL = f"""SELECT vec_id::VARCHAR AS id, 'vector ' || vec_id AS text, (label >= 5)::BIGINT AS label, embedding,
  {split_sql('vec_id')} AS split, label AS class FROM embeddings"""


def turns(spark: SparkSession, sf: str) -> DataFrame:
    """Every conversation turn as a request: system turns have only an id, assistant turns an empty request_id."""
    key = F.concat_ws("-", "conv_id", "turn")
    return texts(spark, sf, "conversations").select(
        F.when(F.col("role") == "system", F.lit(None)).when(F.col("role") == "assistant", "").otherwise(key).alias("request_id"),
        F.when(F.col("role") == "user", F.lit(None)).otherwise(F.concat(F.lit("turn-"), key)).alias("id"),
        F.when(F.col("role") == "system", " <b> </b>\n").otherwise(F.col("text")).alias("text"),
        F.lit("inference").alias("split"),
        F.lit(0).alias("label"),
    )


TURNS_SQL = """SELECT CASE WHEN role = 'user' THEN conv_id || '-' || turn ELSE 'turn-' || conv_id || '-' || turn END AS request_id,
  CASE WHEN role = 'user' THEN conv_id || '-' || turn ELSE 'turn-' || conv_id || '-' || turn END AS id,
  CASE WHEN role = 'system' THEN ' <b> </b>' ELSE text END AS text FROM conversations"""


def user_requests(spark: SparkSession, sf: str) -> DataFrame:
    """Every conversation turn in the request message layout."""
    keyed = table(spark, sf, "conversations").withColumn("request_id", F.concat_ws("-", "conv_id", "turn"))
    return build_requests(keyed)


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Events as prediction rows: several per request."""
    us = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    return table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("request_id"),
        F.col("props").alias("text"),
        F.col("event_type").alias("cleaned_text"),
        (F.col("value") >= 50).cast("bigint").alias("pred_label"),
        F.col("value").alias("pred_score"),
        F.lit("logreg").alias("model_version"),
        F.floor(us / 1000).alias("created_at_ms"),
        F.lit("inference").alias("split"),
        "event_id",
    )


PREDICTIONS_SQL = """SELECT user_id::VARCHAR AS request_id, props AS text, event_type AS cleaned_text,
  (value >= 50)::BIGINT AS pred_label, value AS pred_score, 'logreg' AS model_version, epoch_us(ts) // 1000 AS created_at_ms,
  'inference' AS split, event_id FROM events"""


def size_vector(df: DataFrame) -> DataFrame:
    """A two-number encoding that SQL can repeat: length and number of words of the cleaned text."""
    text = F.col("cleaned_text")
    words = F.size(F.filter(F.split(text, " "), lambda w: w != ""))
    return df.withColumn("embedding", F.array(F.length(text) / 1000.0, words / 100.0).cast("array<float>"))


SIZE_WEIGHTS, SIZE_INTERCEPT = [1.5, -2.25], 0.125


def words_sql(text: str) -> str:
    """Words of a cleaned text."""
    return f"CASE WHEN {text} = '' THEN 0 ELSE len(string_split({text}, ' ')) END"


def size_score_sql(text: str) -> str:
    words = words_sql(text)
    z = (
        f"((length({text}) / 1000.0::DOUBLE)::FLOAT::DOUBLE * {SIZE_WEIGHTS[0]}"
        f" + (({words}) / 100.0::DOUBLE)::FLOAT::DOUBLE * ({SIZE_WEIGHTS[1]}) + {SIZE_INTERCEPT})"
    )
    return f"CASE WHEN {text} = '' THEN 0.0::DOUBLE ELSE 1.0::DOUBLE / (1.0::DOUBLE + exp(-{z})) END"
