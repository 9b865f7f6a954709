"""Coercion rules, malformed lines, requests."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from silverloom.operators.messages import (
    bronze_from_messages,
    build_requests,
    requests_from_messages,
    reviews_from_raw,
    silver_from_bronze,
    silver_from_messages,
    to_message,
)
from silverloom.queries.data import LABEL_CASES
from silverloom.schemas import REVIEW
from silverloom.sinks.files import write_layer
from silverloom.sources.jsonl import read_jsonl, read_lines, split_malformed
from silverloom.sources.reviews import load_reviews, resolve_cap


def lines(spark, *values):
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], "value string, n int")


@pytest.mark.parametrize("make, column", [(bronze_from_messages, 1), (silver_from_messages, 2)])
def test_label_matrix(spark, make, column):
    values = ['{"id":"x"}'] + [f'{{"label":{f}}}' for f, _, _ in LABEL_CASES[1:]]
    args = ("train",) if make is bronze_from_messages else ()
    good, bad = make(lines(spark, *values), *args)
    got = {r["n"]: r["label"] for r in good.collect()}
    assert got == {i: case[column] for i, case in enumerate(LABEL_CASES) if case[column] is not None}
    assert bad.count() == len(values) - len(got)
    assert all(r["error"].startswith("invalid label: ") for r in bad.collect())


@pytest.mark.parametrize(
    "line",
    ["bad", "[1]", "1", '"s"', "null", "[]", '{"id":1} x', '{"id":1}{"id":2}', '{"id":1},{"id":2}', "{'id':1}", '[{"id":1}]',
     '{"id":1', '{"text":"a\tb"}'],
)
def test_lines_that_are_not_one_object(spark, line):
    for good, bad in (bronze_from_messages(lines(spark, line), "train"), silver_from_messages(lines(spark, line))):
        assert good.count() == 0
        assert [tuple(r) for r in bad.collect()] == [(line, "malformed message")]


def test_defaults_and_text_forms(spark):
    values = [
        "{}",
        '{"id":null,"text":null,"split":null,"request_id":null}',
        '{"id":7,"text":5,"split":"","request_id":"r"}',
        '{"id":true,"text":"Ä \\u00e9","split":0,"label":1,"extra":{"a":[1]}}',
        '{"id":1.0,"split":"test"}',
        '{"id":12345678901234567890123,"label":1,"label":0}',
    ]
    rows = sorted(bronze_from_messages(lines(spark, *values), "dflt").good.collect(), key=lambda r: r["n"])
    assert [tuple(r)[:5] for r in rows] == [
        ("", "", 0, "dflt", None),
        ("", "", 0, "dflt", None),
        ("7", "5", 0, "dflt", "r"),
        ("True", "Ä é", 1, "dflt", None),
        ("1.0", "", 0, "test", None),
        ("12345678901234567890123", "", 0, "dflt", None),
    ]
    silver = sorted(silver_from_messages(lines(spark, "{}", '{"split":null,"text":" <b>A</b> "}')).good.collect(), key=lambda r: r["n"])
    assert [tuple(r)[:5] for r in silver] == [("", "", 0, "unknown", None), ("", "a", 0, "unknown", None)]


def test_label_outside_integers_is_rejected(spark):
    good, bad = bronze_from_messages(lines(spark, '{"label":3000000000}', '{"label":1e30}', '{"label":"9999999999"}'), "t")
    assert good.count() == 0 and bad.count() == 3


def test_raw_reviews(spark):
    raw = spark.createDataFrame([("a text", 1, 42), (None, 0, 43)], "text string, label int, id int")
    assert [tuple(r) for r in reviews_from_raw(raw).collect()] == [("42", "a text", 1, "unknown", None), ("43", "", 0, "unknown", None)]
    with pytest.raises(PySparkException, match="unexpected label: 2"):
        reviews_from_raw(spark.createDataFrame([("x", 2, 1)], "text string, label int, id int")).collect()
    with pytest.raises(PySparkException, match="unexpected label: null"):
        reviews_from_raw(spark.createDataFrame([("x", None, 1)], "text string, label int, id int")).collect()


def test_message_leaves_out_missing_request_id(spark):
    df = spark.createDataFrame([("1", 't"é', 1, "test", None), ("2", "u", 0, "train", "r")], REVIEW)
    first, second = (json.loads(r[0]) for r in df.select(to_message(df)).collect())
    assert first == {"id": "1", "text": 't"é', "label": 1, "split": "test"}
    assert second["request_id"] == "r"


def test_requests(spark):
    sent = build_requests(spark.createDataFrame([("r1", "hello")], "request_id string, text string"))
    assert tuple(sent.first()) == ("r1", "hello", 0, "inference", "r1")
    values = ['{"id":0,"request_id":""}', '{"id":"0","request_id":[]}', '{"split":null}', '{"request_id":5,"label":"abc"}', "no"]
    rows = requests_from_messages(lines(spark, *values)).collect()
    assert [(r["request_id"], r["id"], r["split"], r["error"]) for r in rows] == [
        (None, None, None, None),
        (None, "0", None, None),
        (None, None, "", None),
        ("5", None, None, 'invalid label: "abc"'),
        (None, None, None, "malformed message"),
    ]
    assert rows[4]["payload"] == "no"


def test_bronze_columns_to_silver(spark):
    bronze = spark.createDataFrame(
        [("1", "<p>A</p>", 1, "train", None, 5), ("2", "b", 2, "train", None, 6), (None, None, None, None, "r", 7)],
        "id string, text string, label int, split string, request_id string, n int",
    )
    good, bad = silver_from_bronze(bronze)
    assert [tuple(r) for r in good.collect()] == [("1", "a", 1, "train", None, 5), ("", "", 0, "unknown", "r", 7)]
    assert [r["error"] for r in bad.collect()] == ["invalid label: 2"]


def test_files_in_order_and_round_trip(spark, tmp_path):
    folder = tmp_path / "in" / "train"
    folder.mkdir(parents=True)
    (folder / "b.jsonl").write_text('{"id":"3"}\n\n  {"id":"4"}  \nbad\n')
    (folder / "a.jsonl").write_text('{"id":"1"}\n{"id":"2"}')
    (folder / "skip.csv").write_text('{"id":"9"}\n')
    read = read_lines(spark, str(tmp_path / "in"))
    assert [r[0] for r in read.orderBy("line_order").select("value").collect()] == [
        '{"id":"1"}', '{"id":"2"}', '{"id":"3"}', '{"id":"4"}', "bad"
    ]
    good, bad = split_malformed(read, "id string")
    assert (good.count(), bad.count()) == (4, 1)
    assert read_jsonl(spark, str(tmp_path / "in"), REVIEW).count() == 4

    records = spark.createDataFrame([(str(i), f"line\n{i}", i % 2, ("train", "test")[i % 2], None) for i in range(10)], REVIEW)
    write_layer(records, str(tmp_path / "out"), rows_per_file=2)
    back = read_jsonl(spark, str(tmp_path / "out"), REVIEW).drop("line_order")
    assert sorted(back.collect()) == sorted(records.collect())
    files = list((tmp_path / "out" / "split=train").glob("*.txt"))
    assert len(files) >= 3 and all(len(f.read_text().splitlines()) <= 2 for f in files)


def test_dataset_source(spark):
    raw = spark.createDataFrame([(i, f"text {i}", i % 2) for i in range(100)], "key int, text string, label int")
    plain = load_reviews(raw, "train", "key", limit=2, shuffle=False)
    assert [tuple(r)[:4] for r in plain.orderBy("id").collect()] == [("0", "text 0", 0, "train"), ("1", "text 1", 1, "train")]
    mixed = load_reviews(raw, "train", "key", limit=10).orderBy(F.col("id").cast("int")).collect()
    whole = load_reviews(raw.repartition(5), "train", "key", limit=0).orderBy(F.col("id").cast("int")).collect()
    assert len(whole) == 100 and whole[:10] == mixed
    assert [r["text"] for r in whole] != sorted((r["text"] for r in whole), key=lambda t: int(t.split()[1]))
    assert (resolve_cap(0), resolve_cap(None, 5), resolve_cap(3, 5), resolve_cap(0, 5)) == (None, 5, 3, 5)


def test_texts_of_other_kinds(spark):
    """A text keeps the kind it has in the message, as ids do."""
    forms = [("true", "True"), ("false", "False"), ("5", "5"), ("1.0", "1.0"), ('"x"', "x"), ("null", ""), ('""', "")]
    rows = [(f'{{"id":"{i}","text":{form}}}',) for i, (form, _) in enumerate(forms)]
    df = spark.createDataFrame(rows, "value string")
    bronze = {r["id"]: r["text"] for r in bronze_from_messages(df, "train").good.collect()}
    silver = {r["id"]: r["text"] for r in silver_from_messages(df).good.collect()}
    assert bronze == {str(i): want for i, (_, want) in enumerate(forms)}
    assert silver == {i: t.lower() for i, t in bronze.items()}
