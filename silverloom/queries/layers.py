"""Messages, bronze, silver, gold and tables."""

from pyspark.sql import functions as F

from silverloom.functions.text import clean_text
from silverloom.models.encode import to_gold
from silverloom.operators.dedup import dedup_keep_first
from silverloom.operators.messages import (
    bronze_from_messages,
    build_requests,
    reviews_from_raw,
    silver_from_messages,
    to_message,
)
from silverloom.operators.seen import SeenKeys
from silverloom.plans.jobs import Places, backfill, build_silver, ingest_bronze, rejected_path
from silverloom.plans.silver import silver_job
from silverloom.queries.data import (
    BRONZE_ERROR_SQL,
    BRONZE_LABEL_SQL,
    EMPTY_OBJECT,
    GOLD_SQL,
    N_CASES,
    REVIEWS_ALL_SQL,
    REVIEWS_SQL,
    SILVER_ERROR_SQL,
    SILVER_LABEL_SQL,
    clean_sql,
    gold,
    message_sql,
    messages,
    reviews,
    split_of,
    split_sql,
    table,
    texts,
)
from silverloom.schemas import GOLD, REVIEW
from silverloom.session import new_folder
from silverloom.sinks.files import publish, read_csv, write_csv, write_gold_parquet, write_layer, write_silver
from silverloom.sinks.tables import append_commit
from silverloom.sources.jsonl import ORDER, read_jsonl, read_lines
from silverloom.sources.reviews import load_reviews
from silverloom.sources.tables import as_of, describe_gold, list_commits, list_objects, list_tables, read_silver, read_table, row_counts
from silverloom.sources.topic import topic_batch


def silver_documents(spark, sf):
    """Clean every document, keep the first of each (text, label, split), count per split and language."""
    docs = texts(spark, sf, "documents").select(
        "doc_id", "lang", clean_text(F.col("text")).alias("text"), F.lit(0).alias("label"), split_of(F.col("doc_id")).alias("split")
    )
    kept = dedup_keep_first(docs, "doc_id", keep=["doc_id", "lang", "split"])
    return kept.groupBy("lang", "split").agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("first_doc"))


def reviews_strict(spark, sf):
    labelled = reviews(spark, sf).select("doc_id", "text", "label")
    return reviews_from_raw(labelled, "train", index="doc_id").drop("request_id")


def reviews_by_position(spark, sf):
    labelled = reviews(spark, sf).select("doc_id", "text", "label")
    return load_reviews(labelled, "train", "doc_id", limit=0).drop("request_id")


def reviews_in_order(spark, sf):
    labelled = reviews(spark, sf).select("doc_id", "text", "label")
    return load_reviews(labelled, "test", "doc_id", shuffle=False).drop("request_id")


def bronze_coerce(spark, sf):
    return bronze_from_messages(messages(spark, sf), "train").good.drop("request_id")


def bronze_invalid(spark, sf):
    return bronze_from_messages(messages(spark, sf), "train").quarantine.groupBy("error").agg(F.count("*").alias("n"))


def silver_validate(spark, sf):
    return silver_from_messages(messages(spark, sf)).good.drop("request_id")


def silver_reject(spark, sf):
    return silver_from_messages(messages(spark, sf)).quarantine.groupBy("error").agg(F.count("*").alias("n"))


def silver_dedup(spark, sf):
    return silver_job(reviews(spark, sf, "left"), order="doc_id").silver.drop("request_id")


def silver_no_dedup(spark, sf):
    return silver_job(reviews(spark, sf, "left"), order="doc_id", dedup=False).silver.drop("request_id")


def silver_dedup_counts(spark, sf):
    return silver_job(reviews(spark, sf, "left"), order="doc_id").counts


def _two_batches(spark, sf):
    """The unlabelled documents, written as a first silver batch, and the labelled ones as the second; label: is it long?"""
    labels = table(spark, sf, "labels").select("doc_id")
    docs = texts(spark, sf, "documents").select(
        "doc_id",
        F.col("doc_id").cast("string").alias("id"),
        "text",
        (F.length("text") >= 500).cast("int").alias("label"),
        F.when(F.col("lang") == "en", "train").otherwise("test").alias("split"),
        F.lit(None).cast("string").alias("request_id"),
    )
    first = silver_job(docs.join(labels, "doc_id", "left_anti"), order="doc_id").silver
    path = new_folder(spark, "silver")
    write_silver(first, path)
    return read_silver(spark, path), docs.join(labels, "doc_id", "left_semi")


def silver_incremental(spark, sf):
    """Only what the first batch did not have."""
    first, second = _two_batches(spark, sf)
    return silver_job(second, order="doc_id", existing=first).silver.drop("request_id")


def silver_by_index(spark, sf):
    """The same increment against the index of the first batch's keys, of which only its own buckets are read."""
    first, second = _two_batches(spark, sf)
    seen = SeenKeys(spark, new_folder(spark, "keys"))
    seen.add(first)
    return silver_job(second, order="doc_id", existing=seen).silver.drop("request_id")


def backfill_resumed(spark, sf):
    """Bronze and silver built three times over: what was taken and what was rejected stand there once."""
    topic, bronze, target = (new_folder(spark, n) for n in ("topic", "bronze", "silver"))
    messages(spark, sf).select("value").write.text(topic)
    for _ in range(3):
        ingest_bronze(spark, topic, bronze, "train", mode="overwrite")
        build_silver(spark, bronze, target, "train")
    good = spark.read.option("recursiveFileLookup", True).text(bronze).agg(F.count("*").alias("n"))
    bad = spark.read.schema("error string").json(rejected_path(bronze)).agg(F.count("*").alias("n"))
    silver = read_silver(spark, target).agg(F.count("*").alias("n"))
    unfit = spark.read.schema("error string").json(rejected_path(target)).agg(F.count("*").alias("n"))
    named = zip(("bronze", "bronze_rejected", "silver", "silver_rejected"), (good, bad, silver, unfit), strict=True)
    counts = [c.select(F.lit(n).alias("layer"), "n") for n, c in named]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])


def silver_incremental_counts(spark, sf):
    first, second = _two_batches(spark, sf)
    return silver_job(second, order="doc_id", existing=first).counts


def message_json(spark, sf):
    """Reviews to messages and back."""
    sent = reviews(spark, sf, "left")
    lines = sent.select(to_message(sent).alias("value"), F.instr(to_message(sent), "request_id").alias("mentions"))
    return bronze_from_messages(lines, "unknown").good.drop("request_id")


def request_messages(spark, sf):
    keyed = table(spark, sf, "conversations").withColumn("rid", F.concat_ws("-", "conv_id", "turn"))
    sent = build_requests(keyed, "rid")
    return bronze_from_messages(sent.select(to_message(sent).alias("value")), "unknown").good


def topic_roundtrip(spark, sf):
    topic = new_folder(spark, "topic")
    publish(reviews(spark, sf, "left"), topic)
    return bronze_from_messages(topic_batch(spark, topic), "unknown").good.drop("request_id")


def _bronze_layer(spark, sf):
    path = new_folder(spark, "bronze")
    write_layer(reviews(spark, sf, "left"), path)
    return path


def bronze_partitioned_roundtrip(spark, sf):
    return read_jsonl(spark, _bronze_layer(spark, sf), REVIEW).select("id", "text", "label", "split")


def bronze_split_reads(spark, sf):
    """The layer read as a whole and split by split."""
    path = _bronze_layer(spark, sf)
    whole = read_jsonl(spark, path, REVIEW).groupBy("split").agg(F.count("*").alias("n"))
    parts = [
        read_jsonl(spark, f"{path}/split={s}", REVIEW).groupBy("split").agg(F.count("*").alias("n_alone"))
        for s in ("train", "test")
    ]
    return whole.join(parts[0].unionByName(parts[1]), "split", "left")


def silver_from_files(spark, sf):
    """Bronze lines on disk to silver, written and read again."""
    path = new_folder(spark, "silver")
    write_layer(silver_job(read_lines(spark, _bronze_layer(spark, sf)), order=ORDER).silver, path)
    return read_jsonl(spark, path, REVIEW).select("text", "label", "split")


def layer_objects(spark, sf):
    """The files of a layer and their bytes per split."""
    files = list_objects(spark, _bronze_layer(spark, sf), ".txt")
    split = F.regexp_extract("object_key", "split=([^/]+)/", 1)
    by_split = files.groupBy(split.alias("split")).agg(F.count("*").alias("n_files"), F.sum("n_bytes").alias("n_bytes"))
    return by_split.select("split", (F.col("n_files") > 0).alias("has_files"), "n_bytes")


def _shown(df):
    v = F.col("embedding")
    return df.select(
        "id", "text", "label", "split", F.size(v).cast("bigint").alias("dim"), F.round(v[0].cast("double"), 6).alias("first_value"),
        F.round(F.element_at(v, -1).cast("double"), 6).alias("last_value"),
    )


_SHOWN_SQL = """id, text, label, split, len(embedding) AS dim, round(embedding[1]::DOUBLE, 6) AS first_value,
  round(embedding[len(embedding)]::DOUBLE, 6) AS last_value"""


def gold_roundtrip(spark, sf):
    path = new_folder(spark, "gold")
    write_gold_parquet(to_gold(gold(spark, sf)), path)
    return _shown(spark.read.schema(GOLD).parquet(path))


def gold_inspect(spark, sf):
    path = new_folder(spark, "gold")
    write_gold_parquet(to_gold(gold(spark, sf)), path)
    return describe_gold(spark.read.schema(GOLD).parquet(path)).select(
        "n_rows", "n_columns", F.col("min_dim").cast("bigint").alias("min_dim"), F.col("max_dim").cast("bigint").alias("max_dim")
    )


def _three_commits(spark, sf):
    path = new_folder(spark, "gold_table")
    rows = gold(spark, sf)
    for commit, part in ((1000, rows.where("class < 3")), (2000, rows.where("class between 3 and 6")), (3000, rows.where("class > 6"))):
        append_commit(part, path, GOLD, commit_id=commit)
    return read_table(spark, path, GOLD)


def commits_list(spark, sf):
    return list_commits(_three_commits(spark, sf)).select("commit_id", "n_rows", "is_latest")


def gold_as_of(spark, sf):
    return _shown(as_of(_three_commits(spark, sf), 2000))


def append_common_columns(spark, sf):
    """A commit with an unknown column and without a known one."""
    path = new_folder(spark, "gold_table")
    append_commit(gold(spark, sf).drop("request_id"), path, GOLD, commit_id=1)
    out = read_table(spark, path)
    return _shown(out.where(F.lit(",".join(sorted(out.columns))) == "commit_id,embedding,id,label,request_id,split,text"))


def append_new_column(spark, sf):
    """A commit that brings a column of its own."""
    path = new_folder(spark, "gold_table")
    append_commit(gold(spark, sf), path, GOLD, commit_id=1, evolve=True)
    return read_table(spark, path).groupBy("class").agg(F.count("*").alias("n"))


def append_twice(spark, sf):
    """The same commit written twice counts once."""
    path = new_folder(spark, "gold_table")
    for _ in range(2):
        append_commit(gold(spark, sf), path, GOLD, commit_id=7)
    return list_commits(read_table(spark, path, GOLD)).select("commit_id", "n_rows")


def append_two_writers(spark, sf):
    """Two writers of one commit: the rows of both stay, and writing again replaces only one's own."""
    path = new_folder(spark, "gold_table")
    for writer in ("a", "b", "a"):
        append_commit(gold(spark, sf), path, GOLD, commit_id=7, writer=writer)
    return list_commits(read_table(spark, path, GOLD)).select("commit_id", "n_rows")


def ingest_accounts(spark, sf):
    """Messages taken into bronze and messages rejected, as the job has written them."""
    topic, path = new_folder(spark, "topic"), new_folder(spark, "bronze")
    messages(spark, sf).select("value").write.text(topic)
    ingest_bronze(spark, topic, path, "train")
    kept = spark.read.option("recursiveFileLookup", True).text(path).agg(F.count("*").alias("n"))
    rejected = spark.read.schema("error string").json(rejected_path(path)).agg(F.count("*").alias("n"))
    return kept.select(F.lit("kept").alias("part"), "n").unionByName(rejected.select(F.lit("rejected").alias("part"), "n"))


def table_row_counts(spark, sf):
    return row_counts({name: table(spark, sf, name) for name in ("documents", "labels", "embeddings", "events", "conversations")})


def csv_export(spark, sf):
    path = new_folder(spark, "csv")
    write_csv(reviews(spark, sf, "left").select("id", "label", F.substring("text", 1, 100).alias("text")), path)
    return read_csv(spark, path, "id string, label int, text string")


def backfill_tables(spark, sf):
    """The whole job, from raw rows to a classifier: rows per gold table and the accuracy measured on each split."""
    root = new_folder(spark, "run")
    database = "run_" + root.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/tables'")
    raw = reviews(spark, sf, "left")
    datasets = {s: raw.where(F.col("split") == s).select("doc_id", "text", "label") for s in ("train", "test")}
    trained = backfill(spark, Places(root, database), datasets, "doc_id", size=256)
    tables = {name: spark.table(f"{database}.{name}") for name in list_tables(spark, database)}
    score = F.when(F.col("table_name") == "gold_train", trained.metrics["train_accuracy"]).otherwise(trained.metrics["test_accuracy"])
    return row_counts(tables).withColumn("measured", score.between(0, 1))


QUERIES = {
    f.__name__: f
    for f in (
        silver_documents,
        reviews_strict,
        reviews_by_position,
        reviews_in_order,
        bronze_coerce,
        bronze_invalid,
        silver_validate,
        silver_reject,
        silver_dedup,
        silver_no_dedup,
        silver_dedup_counts,
        silver_incremental,
        silver_by_index,
        backfill_resumed,
        silver_incremental_counts,
        message_json,
        request_messages,
        topic_roundtrip,
        bronze_partitioned_roundtrip,
        bronze_split_reads,
        silver_from_files,
        layer_objects,
        gold_roundtrip,
        gold_inspect,
        commits_list,
        gold_as_of,
        append_common_columns,
        append_new_column,
        append_twice,
        append_two_writers,
        ingest_accounts,
        table_row_counts,
        csv_export,
        backfill_tables,
    )
}

_FIRST = "row_number() OVER (PARTITION BY text, label, split ORDER BY doc_id) = 1"
_SILVER_ALL = f"SELECT doc_id, id, {clean_sql('text')} AS text, label, split FROM ({REVIEWS_ALL_SQL})"
_INCREMENT = f"""WITH s AS (SELECT doc_id, doc_id::VARCHAR AS id, {clean_sql('text')} AS text, (length(text) >= 500)::INTEGER AS label,
    CASE WHEN lang = 'en' THEN 'train' ELSE 'test' END AS split, doc_id IN (SELECT doc_id FROM labels) AS labelled FROM documents)"""
_NEW = "labelled AND (text, label, split) NOT IN (SELECT (text, label, split) FROM s WHERE NOT labelled)"
_THREE = f"SELECT *, CASE WHEN class < 3 THEN 1000 WHEN class <= 6 THEN 2000 ELSE 3000 END AS commit_id FROM ({GOLD_SQL})"

ORACLE = {
    "silver_documents": f"""SELECT lang, split, count(*) AS n_docs, min(doc_id) AS first_doc FROM (
  SELECT doc_id, lang, split FROM (SELECT doc_id, lang, {clean_sql('text')} AS text, 0 AS label, {split_sql('doc_id')} AS split FROM documents)
  QUALIFY {_FIRST}) GROUP BY lang, split""",
    "reviews_strict": f"SELECT id, text, label, 'train' AS split FROM ({REVIEWS_SQL})",
    "reviews_by_position": f"""SELECT (row_number() OVER (ORDER BY md5('42:' || doc_id::VARCHAR)) - 1)::VARCHAR AS id, text, label,
  'train' AS split FROM ({REVIEWS_SQL})""",
    "reviews_in_order": f"""SELECT (row_number() OVER (ORDER BY doc_id) - 1)::VARCHAR AS id, text, label, 'test' AS split
  FROM ({REVIEWS_SQL})""",
    "bronze_coerce": message_sql(BRONZE_LABEL_SQL, "text", "train"),
    "bronze_invalid": f"SELECT {BRONZE_ERROR_SQL} AS error, count(*) AS n FROM documents WHERE ({BRONZE_ERROR_SQL}) IS NOT NULL GROUP BY 1",
    "silver_validate": message_sql(SILVER_LABEL_SQL, clean_sql("text"), "unknown"),
    "silver_reject": f"SELECT {SILVER_ERROR_SQL} AS error, count(*) AS n FROM documents WHERE ({SILVER_ERROR_SQL}) IS NOT NULL GROUP BY 1",
    "silver_dedup": f"SELECT id, text, label, split FROM ({_SILVER_ALL}) QUALIFY {_FIRST}",
    "silver_no_dedup": f"SELECT id, text, label, split FROM ({_SILVER_ALL})",
    "silver_dedup_counts": f"""SELECT count(*) AS n_valid, count(DISTINCT (text, label, split)) AS n_kept,
  count(*) - count(DISTINCT (text, label, split)) AS n_skipped FROM ({_SILVER_ALL})""",
    "silver_incremental": f"{_INCREMENT} SELECT id, text, label, split FROM s WHERE {_NEW} QUALIFY {_FIRST}",
    "silver_by_index": f"{_INCREMENT} SELECT id, text, label, split FROM s WHERE {_NEW} QUALIFY {_FIRST}",
    "backfill_resumed": f"""WITH b AS (SELECT ({BRONZE_LABEL_SQL}) AS label, {clean_sql('text')} AS text,
    CASE WHEN doc_id % {N_CASES} = {EMPTY_OBJECT} THEN '' ELSE text END AS raw,
    CASE WHEN doc_id % {N_CASES} = {EMPTY_OBJECT} THEN 'train' ELSE {split_sql('doc_id')} END AS split,
    doc_id % {N_CASES} = {EMPTY_OBJECT} AS bare FROM documents)
  SELECT 'bronze' AS layer, count(label) AS n FROM b UNION ALL SELECT 'bronze_rejected', count(*) - count(label) FROM b
  UNION ALL SELECT 'silver', count(DISTINCT (CASE WHEN bare THEN '' ELSE text END, label)) FROM b WHERE label IN (0, 1) AND split = 'train'
  UNION ALL SELECT 'silver_rejected', count(*) FROM b WHERE label NOT IN (0, 1) AND split = 'train'""",
    "silver_incremental_counts": f"""{_INCREMENT} SELECT (SELECT count(*) FROM s WHERE labelled) AS n_valid, count(DISTINCT (text, label, split)) AS n_kept,
  (SELECT count(*) FROM s WHERE labelled) - count(DISTINCT (text, label, split)) AS n_skipped FROM s WHERE {_NEW}""",
    "message_json": f"SELECT id, text, label, split, 0 AS mentions FROM ({REVIEWS_ALL_SQL})",
    "request_messages": """SELECT conv_id || '-' || turn AS id, text, 0 AS label, 'inference' AS split,
  conv_id || '-' || turn AS request_id FROM conversations""",
    "topic_roundtrip": f"SELECT id, text, label, split FROM ({REVIEWS_ALL_SQL})",
    "bronze_partitioned_roundtrip": f"SELECT id, text, label, split FROM ({REVIEWS_ALL_SQL})",
    "bronze_split_reads": f"SELECT split, count(*) AS n, count(*) AS n_alone FROM ({REVIEWS_ALL_SQL}) GROUP BY split",
    "silver_from_files": f"SELECT DISTINCT text, label, split FROM ({_SILVER_ALL})",
    "layer_objects": f"""SELECT split, true AS has_files, sum(strlen(to_json({{'id': id, 'text': text, 'label': label, 'split': split}})) + 1)::BIGINT AS n_bytes
  FROM ({REVIEWS_ALL_SQL}) GROUP BY split""",
    "gold_roundtrip": f"SELECT {_SHOWN_SQL} FROM ({GOLD_SQL})",
    "gold_inspect": """SELECT count(*) AS n_rows, 6::BIGINT AS n_columns, min(len(embedding)) AS min_dim, max(len(embedding)) AS max_dim
  FROM embeddings""",
    "commits_list": f"SELECT commit_id::BIGINT AS commit_id, count(*) AS n_rows, commit_id = 3000 AS is_latest FROM ({_THREE}) GROUP BY commit_id",
    "gold_as_of": f"SELECT {_SHOWN_SQL} FROM ({_THREE}) WHERE commit_id <= 2000",
    "append_common_columns": f"SELECT {_SHOWN_SQL} FROM ({GOLD_SQL})",
    "append_new_column": "SELECT label AS class, count(*) AS n FROM embeddings GROUP BY label",
    "append_twice": "SELECT 7::BIGINT AS commit_id, count(*) AS n_rows FROM embeddings",
    "append_two_writers": "SELECT 7::BIGINT AS commit_id, 2 * count(*) AS n_rows FROM embeddings",
    "ingest_accounts": f"""SELECT CASE WHEN ({BRONZE_ERROR_SQL}) IS NULL THEN 'kept' ELSE 'rejected' END AS part, count(*) AS n
  FROM documents GROUP BY 1""",
    "table_row_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in ("documents", "labels", "embeddings", "events", "conversations")
    ),
    "backfill_tables": f"""SELECT 'gold_' || split AS table_name, count(DISTINCT (text, label)) AS n_rows, true AS measured
  FROM ({_SILVER_ALL}) GROUP BY split""",
    "csv_export": f"SELECT id, label, substr(text, 1, 100) AS text FROM ({REVIEWS_ALL_SQL})",
}
