"""Cleaning and tokenising."""

from pyspark.sql import functions as F

from silverloom.functions.text import (
    clean_text,
    normalize_whitespace,
    preview,
    review_prompt,
    sentiment_label,
    sentiment_name,
    strip_html,
)
from silverloom.models.encode import tokens
from silverloom.queries.data import clean_sql, html_sql, strip_sql, table, texts, words_sql, ws_sql


def strip_html_pages(spark, sf):
    return texts(spark, sf, "pages").select("page_id", strip_html(F.col("html")).alias("text"))


def normalize_ws_documents(spark, sf):
    return texts(spark, sf, "documents").select("doc_id", normalize_whitespace(F.col("text")).alias("text"))


def clean_text_pages(spark, sf):
    return texts(spark, sf, "pages").select("page_id", clean_text(F.col("html")).alias("text"))


def clean_text_documents(spark, sf):
    return texts(spark, sf, "documents").select("doc_id", clean_text(F.col("text")).alias("text"))


def clean_text_flags(spark, sf):
    html = F.col("html")
    return texts(spark, sf, "pages").select(
        "page_id",
        F.md5(clean_text(html, lowercase=False)).alias("keep_case"),
        F.md5(clean_text(html, strip_html_tags=False)).alias("keep_tags"),
        F.md5(clean_text(html, collapse_whitespace=False)).alias("keep_blanks"),
        F.md5(clean_text(html, False, False, False)).alias("trim_only"),
        F.md5(clean_text(html, False, True, False)).alias("tags_only"),
        F.md5(clean_text(html, True, False, False)).alias("case_only"),
        F.md5(clean_text(html, False, False, True)).alias("blanks_only"),
    )


def text_previews(spark, sf):
    text = F.col("text")
    return texts(spark, sf, "documents").select(
        "doc_id",
        preview(text, 100).alias("text_100"),
        F.md5(preview(clean_text(text), 2000)).alias("cleaned_2000"),
        preview(F.md5("text"), 8).alias("id_8"),
    )


TEMPLATE = "Note: {sentiment} ({sentiment})"


def review_prompts(spark, sf):
    named = table(spark, sf, "labels").select("quality", sentiment_name(F.col("quality")).alias("sentiment"))
    prompts = named.select(
        "sentiment", sentiment_label(F.col("sentiment")).alias("label"), review_prompt(TEMPLATE, F.col("sentiment")).alias("prompt")
    )
    return prompts.groupBy("sentiment", "label", "prompt").agg(F.count("*").alias("n"))


def token_counts(spark, sf):
    words = tokens(clean_text(F.col("text")))
    return texts(spark, sf, "documents").select("doc_id", F.size(words).cast("bigint").alias("n_tokens"))


QUERIES = {
    f.__name__: f
    for f in (
        strip_html_pages,
        normalize_ws_documents,
        clean_text_pages,
        clean_text_documents,
        clean_text_flags,
        text_previews,
        review_prompts,
        token_counts,
    )
}

ORACLE = {
    "strip_html_pages": f"SELECT page_id, {html_sql('html')} AS text FROM pages",
    "normalize_ws_documents": f"SELECT doc_id, {ws_sql('text')} AS text FROM documents",
    "clean_text_pages": f"SELECT page_id, {clean_sql('html')} AS text FROM pages",
    "clean_text_documents": f"SELECT doc_id, {clean_sql('text')} AS text FROM documents",
    "clean_text_flags": f"""SELECT page_id, md5({ws_sql(html_sql('html'))}) AS keep_case, md5(lower({ws_sql('html')})) AS keep_tags,
  md5({strip_sql('lower(' + html_sql('html') + ')')}) AS keep_blanks, md5({strip_sql('html')}) AS trim_only,
  md5({strip_sql(html_sql('html'))}) AS tags_only, md5({strip_sql('lower(html)')}) AS case_only,
  md5({ws_sql('html')}) AS blanks_only FROM pages""",
    "text_previews": f"""SELECT doc_id, substr(text, 1, 100) AS text_100, md5(substr({clean_sql('text')}, 1, 2000)) AS cleaned_2000,
  substr(md5(text), 1, 8) AS id_8 FROM documents""",
    "review_prompts": """SELECT sentiment, label, 'Note: ' || sentiment || ' (' || sentiment || ')' AS prompt, count(*) AS n
  FROM (SELECT CASE WHEN quality = 1 THEN 'positive' ELSE 'negative' END AS sentiment, CASE WHEN quality = 1 THEN 1 ELSE 0 END AS label FROM labels)
  GROUP BY ALL""",
    "token_counts": f"""SELECT doc_id, {words_sql(clean_sql('text'))} AS n_tokens
  FROM documents""",
}
