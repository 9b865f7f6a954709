"""Splits, samples, lookups, traces, metrics and scoring."""

from pyspark.sql import functions as F

from silverloom.constants import PROCESSING_BOUNDS, REQUEST_BOUNDS
from silverloom.functions.scores import argmax, float_vector, positive_probability, threshold_label
from silverloom.operators.metrics import accuracy, class_summary, counters, histogram
from silverloom.operators.predict import (
    empty_text_rule,
    linear_step,
    now_ms,
    predict,
    resolve_identity,
    to_predictions,
    to_responses,
)
from silverloom.operators.sampling import first_rows, latest_per_request, sample_balanced, sample_exact, tail, with_position
from silverloom.operators.splits import inference_only, split_filter, split_filter_or_all
from silverloom.operators.trace import request_trace
from silverloom.queries.data import (
    GOLD_SQL,
    PREDICTIONS_SQL,
    REVIEWS_SQL,
    SIZE_INTERCEPT,
    SIZE_WEIGHTS,
    TURNS_SQL,
    WEIGHTS,
    clean_sql,
    gold,
    predictions,
    reviews,
    size_score_sql,
    size_vector,
    table,
    turns,
)
from silverloom.session import written
from silverloom.sources.tables import lookup

_SIZE_SCORE = linear_step(SIZE_WEIGHTS, SIZE_INTERCEPT)


def _by_case(cases):
    out = None
    for name, df in cases.items():
        part = df.agg(F.count("*").alias("n"), F.sum(F.col("id").cast("bigint")).alias("id_sum")).select(
            F.lit(name).alias("scenario"), "n", "id_sum"
        )
        out = part if out is None else out.unionByName(part)
    return out


def split_filters(spark, sf):
    """By value, without a value, and without the column."""
    g = gold(spark, sf)
    return _by_case({
        "train": split_filter(g, "train"),
        "test": split_filter(g, "test"),
        "no value": split_filter(g, None),
        "no column": split_filter(g.drop("split"), "train"),
    })


def split_fallback(spark, sf):
    """A split that exists, and one that does not."""
    g = gold(spark, sf)
    return _by_case({"train": split_filter_or_all(g, "train"), "absent": split_filter_or_all(g, "validation")})


def inference_gate(spark, sf):
    """Documents as messages whose split is their language: absent for English, inference for French."""
    lang = F.col("lang")
    split = F.when(lang == "fr", "inference").when(lang != "en", lang)
    return inference_only(table(spark, sf, "documents").select("doc_id", split.alias("split"))).groupBy(
        F.coalesce("split", F.lit("absent")).alias("split")
    ).agg(F.count("*").alias("n"))


def sample_rows(spark, sf):
    return sample_exact(table(spark, sf, "documents"), 500, "doc_id").select("doc_id", "lang", "text")


def one_split_halves(spark, sf):
    """Sixty labelled documents, as many of each label: thirty at most, also where the other label has fewer."""
    rows = reviews(spark, sf).select("doc_id", "label")
    return sample_balanced(rows, 60, "doc_id", "label", refill=False)


def language_shares(spark, sf):
    """Forty documents, split evenly between languages (null is one); rare ones would give all they have."""
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return sample_balanced(docs, 40, "doc_id", "lang").groupBy("lang").agg(F.count("*").alias("n"), F.max("doc_id").alias("last"))


def sample_not_needed(spark, sf):
    """A sample larger than the table is the table."""
    return sample_exact(table(spark, sf, "embeddings"), 10**12, "vec_id").select("vec_id", "label")


def shuffle_positions(spark, sf):
    return with_position(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id", 42)


def order_positions(spark, sf):
    return with_position(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id")


def first_documents(spark, sf):
    return first_rows(table(spark, sf, "documents").select("doc_id", "lang"), 100, "doc_id")


def latest_prediction(spark, sf):
    return latest_per_request(predictions(spark, sf), ["created_at_ms", "event_id"]).drop("event_id")


def prediction_lookup(spark, sf):
    """Looked up in a written predictions table, as a caller does."""
    stored = written(predictions(spark, sf), "predictions")
    return latest_per_request(lookup(stored, "7"), ["created_at_ms", "event_id"]).drop("event_id")


def predictions_tail(spark, sf):
    return tail(predictions(spark, sf), 5, key="event_id").drop("event_id")


def request_traces(spark, sf):
    """Documents traced through tables that share some of their ids."""
    def ids(name, column):
        return table(spark, sf, name).select(F.col(column).cast("string").alias("request_id"))

    layers = {
        "bronze": ids("documents", "doc_id"),
        "silver": ids("labels", "doc_id"),
        "gold": ids("embeddings", "vec_id"),
        "predictions": ids("events", "user_id"),
    }
    return request_trace(ids("documents", "doc_id"), layers)


def request_traces_repeated(spark, sf):
    """Users of many events each, traced through pages and conversations."""
    def ids(name, column):
        return table(spark, sf, name).select(F.col(column).cast("string").alias("request_id"))

    layers = {"pages": ids("pages", "page_id"), "conversations": ids("conversations", "conv_id")}
    return request_trace(ids("events", "user_id"), layers)


def label_counts(spark, sf):
    return counters(gold(spark, sf), "label")


def counters_by_split_label(spark, sf):
    return counters(gold(spark, sf), "split", "label")


def class_check(spark, sf):
    return class_summary(gold(spark, sf)).unionByName(class_summary(table(spark, sf, "labels"), "quality"))


def latency_histogram(spark, sf):
    seconds = table(spark, sf, "events").select((F.col("value") / 10).alias("seconds"))
    return histogram(seconds, "seconds").withColumn("total_sum", F.round("total_sum", 3))


def processing_histogram(spark, sf):
    seconds = table(spark, sf, "events").select("event_type", (F.col("value") / 10).alias("seconds"))
    return histogram(seconds, "seconds", PROCESSING_BOUNDS, ["event_type"]).withColumn("total_sum", F.round("total_sum", 3))


def softmax_label(spark, sf):
    l0, l1 = F.col("value") / 50, F.lit(1.0) - F.col("value") / 100
    events = table(spark, sf, "events").select("event_id", l0.alias("l0"), l1.alias("l1"))
    scored = events.withColumn("score", positive_probability(F.col("l0"), F.col("l1")))
    return scored.select(
        "event_id",
        F.round("score", 6).alias("score"),
        threshold_label(F.col("score")).alias("label"),
        argmax(F.array("l0", "l1")).alias("best"),
    )


def score_linear(spark, sf):
    return linear_step(WEIGHTS)(gold(spark, sf)).select("id", "pred_label", F.round("pred_score", 6).alias("pred_score"))


def accuracy_fixed_model(spark, sf):
    return accuracy(linear_step(WEIGHTS)(gold(spark, sf))).withColumn("accuracy", F.round("accuracy", 9))


def vector_cast(spark, sf):
    """Vectors to doubles and back."""
    back = float_vector(F.col("embedding").cast("array<double>"))
    v = table(spark, sf, "embeddings").select("vec_id", back.alias("v"))
    return v.select("vec_id", F.size("v").cast("bigint").alias("dim"), F.round(F.array_max("v").cast("double"), 6).alias("highest"))


def identity_resolution(spark, sf):
    return resolve_identity(turns(spark, sf)).select("request_id", "id")


def fresh_request_ids(spark, sf):
    """Requests without any id get a UUID each, and a time stamp."""
    bare = turns(spark, sf).select(F.lit(None).cast("string").alias("request_id"), F.lit("").alias("id"), "text")
    stamped = written(resolve_identity(bare).withColumn("created_at_ms", now_ms()), "requests")
    rid = F.col("request_id")
    return stamped.agg(
        F.count("*").alias("n"),
        F.count_distinct(rid).alias("n_distinct"),
        F.count_if(rid.rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")).alias("n_uuids"),
        F.count_if(rid == F.col("id")).alias("n_same_id"),
        (F.min("created_at_ms") > 1_600_000_000_000).alias("stamped"),
    )


def empty_text(spark, sf):
    """Turns without text score 0, with a zero vector."""
    scored = predict(turns(spark, sf), size_vector, _SIZE_SCORE, size=2)
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x)
    return scored.where("cleaned_text = ''").select("request_id", "pred_label", "pred_score", total.alias("vector_sum"))


def hard_label_score(spark, sf):
    """A model that gives labels only: the label is the score; the empty-text rule still applies."""
    df = predictions(spark, sf).withColumn("pred_score", F.col("pred_label").cast("double"))
    ruled = empty_text_rule(df.withColumn("cleaned_text", F.when(F.col("cleaned_text") == "error", "").otherwise(F.col("cleaned_text"))))
    return ruled.groupBy("cleaned_text", "pred_label", "pred_score").agg(F.count("*").alias("n"))


def predict_batch(spark, sf):
    scored = predict(turns(spark, sf), size_vector, _SIZE_SCORE, size=2)
    rows = to_predictions(scored, created_at_ms=F.lit(1_700_000_000_000))
    return rows.drop("text").withColumn("pred_score", F.round("pred_score", 6))


def predict_responses(spark, sf):
    scored = predict(turns(spark, sf), size_vector, _SIZE_SCORE, size=2)
    return to_responses(scored).withColumn("pred_score", F.round("pred_score", 6))


QUERIES = {
    f.__name__: f
    for f in (
        split_filters,
        split_fallback,
        inference_gate,
        sample_rows,
        sample_not_needed,
        one_split_halves,
        language_shares,
        shuffle_positions,
        order_positions,
        first_documents,
        latest_prediction,
        prediction_lookup,
        predictions_tail,
        request_traces,
        request_traces_repeated,
        label_counts,
        counters_by_split_label,
        class_check,
        latency_histogram,
        processing_histogram,
        softmax_label,
        score_linear,
        accuracy_fixed_model,
        vector_cast,
        identity_resolution,
        fresh_request_ids,
        empty_text,
        hard_label_score,
        predict_batch,
        predict_responses,
    )
}


def _cases_sql(cases: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS scenario, count(*) AS n, sum(vec_id)::BIGINT AS id_sum FROM g WHERE {w}"
        for n, w in cases.items()
    )


_G = f"WITH g AS (SELECT id::BIGINT AS vec_id, split FROM ({GOLD_SQL}))"


def _histogram_sql(bounds, labels: str = "") -> str:
    sep = f"{labels}, " if labels else ""
    group = f"GROUP BY {labels}" if labels else ""
    parts = [(str(b), f"count(*) FILTER (value / 10 <= {b})") for b in bounds] + [("+Inf", "count(*)")]
    return " UNION ALL ".join(
        f"SELECT {sep}'{le}' AS le, {n} AS n, count(*) AS total_count, round(sum(value / 10), 3) AS total_sum FROM events {group}"
        for le, n in parts
    )


_W = "[" + ", ".join(f"{w!r}::DOUBLE" for w in WEIGHTS) + "]"
_SCORED = f"""SELECT id, label, 1.0::DOUBLE / (1.0::DOUBLE + exp(-list_dot_product(embedding::DOUBLE[], {_W}))) AS score FROM ({GOLD_SQL})"""
_TURNS = f"""SELECT request_id, cleaned_text, {size_score_sql('cleaned_text')} AS score FROM (
  SELECT request_id, {clean_sql('text')} AS cleaned_text FROM ({TURNS_SQL}))"""

ORACLE = {
    "split_filters": f"{_G} "
    + _cases_sql({"train": "split = 'train'", "test": "split = 'test'", "no value": "true", "no column": "true"}),
    "split_fallback": f"{_G} " + _cases_sql({"train": "split = 'train'", "absent": "true"}),
    "inference_gate": """SELECT CASE WHEN lang = 'en' THEN 'absent' ELSE 'inference' END AS split, count(*) AS n FROM documents
  WHERE lang IN ('en', 'fr') GROUP BY 1""",
    "sample_rows": "SELECT doc_id, lang, text FROM documents ORDER BY md5('42:' || doc_id::VARCHAR) LIMIT 500",
    "one_split_halves": f"""SELECT doc_id, label FROM ({REVIEWS_SQL})
  QUALIFY row_number() OVER (PARTITION BY label ORDER BY md5('42:' || doc_id::VARCHAR)) <= 30""",
    "language_shares": """WITH s AS (SELECT lang, count(*) AS size, row_number() OVER (ORDER BY count(*), lang NULLS FIRST) - 1 AS i,
    count(*) OVER () AS c FROM documents GROUP BY lang), d AS (SELECT doc_id, lang, row_number() OVER (
    PARTITION BY lang ORDER BY md5('42:' || doc_id::VARCHAR)) AS r FROM documents)
  SELECT lang, count(*) AS n, max(doc_id) AS last FROM d JOIN s USING (lang) WHERE r <= 40 // c + (i < 40 % c)::INTEGER GROUP BY lang""",
    "sample_not_needed": "SELECT vec_id, label FROM embeddings",
    "shuffle_positions": "SELECT doc_id, lang, row_number() OVER (ORDER BY md5('42:' || doc_id::VARCHAR)) - 1 AS position FROM documents",
    "order_positions": "SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) - 1 AS position FROM documents",
    "first_documents": "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 100",
    "latest_prediction": f"""SELECT * EXCLUDE (event_id) FROM ({PREDICTIONS_SQL})
  QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY created_at_ms DESC, event_id DESC) = 1""",
    "prediction_lookup": f"""SELECT * EXCLUDE (event_id) FROM ({PREDICTIONS_SQL}) WHERE request_id = '7'
  ORDER BY created_at_ms DESC, event_id DESC LIMIT 1""",
    "predictions_tail": f"SELECT * EXCLUDE (event_id) FROM ({PREDICTIONS_SQL}) ORDER BY created_at_ms DESC, event_id LIMIT 5",
    "request_traces": """SELECT doc_id::VARCHAR AS request_id, true AS in_bronze, doc_id IN (SELECT doc_id FROM labels) AS in_silver,
  doc_id IN (SELECT vec_id FROM embeddings) AS in_gold, doc_id IN (SELECT user_id FROM events) AS in_predictions FROM documents""",
    "request_traces_repeated": """SELECT DISTINCT user_id::VARCHAR AS request_id, user_id IN (SELECT page_id FROM pages) AS in_pages,
  user_id IN (SELECT conv_id FROM conversations) AS in_conversations FROM events""",
    "label_counts": f"SELECT label, count(*) AS n FROM ({GOLD_SQL}) GROUP BY label",
    "counters_by_split_label": f"SELECT split, label, count(*) AS n FROM ({GOLD_SQL}) GROUP BY split, label",
    "class_check": f"""SELECT count(*) AS n_rows, count(DISTINCT label) AS n_labels, min(label) AS min_label, max(label) AS max_label FROM ({GOLD_SQL})
  UNION ALL SELECT count(*), count(DISTINCT quality), min(quality), max(quality) FROM labels""",
    "latency_histogram": _histogram_sql(REQUEST_BOUNDS),
    "processing_histogram": _histogram_sql(PROCESSING_BOUNDS, "event_type"),
    "softmax_label": """SELECT event_id, round(1.0::DOUBLE / (1.0::DOUBLE + exp(l0 - l1)), 6) AS score,
  (1.0::DOUBLE / (1.0::DOUBLE + exp(l0 - l1)) >= 0.5)::BIGINT AS label, CASE WHEN l1 > l0 THEN 1 ELSE 0 END::BIGINT AS best
  FROM (SELECT event_id, value / 50 AS l0, 1.0::DOUBLE - value / 100 AS l1 FROM events)""",
    "score_linear": f"SELECT id, (score >= 0.5)::BIGINT AS pred_label, round(score, 6) AS pred_score FROM ({_SCORED})",
    "accuracy_fixed_model": f"""SELECT count(*) AS n_rows, round(avg(((score >= 0.5)::BIGINT = label)::INTEGER), 9) AS accuracy FROM ({_SCORED})""",
    "vector_cast": "SELECT vec_id, len(embedding) AS dim, round(list_max(embedding)::DOUBLE, 6) AS highest FROM embeddings",
    "identity_resolution": f"SELECT request_id, id FROM ({TURNS_SQL})",
    "fresh_request_ids": """SELECT count(*) AS n, count(*) AS n_distinct, count(*) AS n_uuids, count(*) AS n_same_id, true AS stamped
  FROM conversations""",
    "empty_text": f"""SELECT request_id, 0::BIGINT AS pred_label, 0.0::DOUBLE AS pred_score, 0.0::DOUBLE AS vector_sum FROM ({_TURNS})
  WHERE cleaned_text = ''""",
    "hard_label_score": f"""SELECT CASE WHEN cleaned_text = 'error' THEN '' ELSE cleaned_text END AS cleaned_text,
  CASE WHEN cleaned_text = 'error' THEN 0 ELSE pred_label END::BIGINT AS pred_label,
  CASE WHEN cleaned_text = 'error' THEN 0 ELSE pred_label END::DOUBLE AS pred_score, count(*) AS n FROM ({PREDICTIONS_SQL}) GROUP BY ALL""",
    "predict_batch": f"""SELECT request_id, cleaned_text, (score >= 0.5)::BIGINT AS pred_label, round(score, 6) AS pred_score,
  'logreg' AS model_version, 1700000000000 AS created_at_ms, 'inference' AS split FROM ({_TURNS})""",
    "predict_responses": f"""SELECT request_id, (score >= 0.5)::BIGINT AS pred_label, round(score, 6) AS pred_score, cleaned_text
  FROM ({_TURNS})""",
}
