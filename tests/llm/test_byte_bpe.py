"""Ids against a rank-based encoder, and the way back."""

import os
import random
import sys

import public_tokenizers
import pytest
import tiktoken

sys.path.insert(0, os.path.dirname(__file__))

from cases import documents, texts  # noqa: E402

from silverloom.llm import byte_bpe  # noqa: E402
from silverloom.llm.queries.op1 import RANKS, digests, op1_byte_bpe, vocabulary  # noqa: E402


@pytest.fixture(scope="module")
def data():
    with open(public_tokenizers.path(RANKS), "rb") as file:
        return file.read()


@pytest.fixture(scope="module")
def other(data):
    ranks = byte_bpe.parse_ranks(data)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_of_random_texts(data, other, monkeypatch):
    coder = byte_bpe.Coder(data, public_tokenizers.PATTERN)
    rng = random.Random(3)
    signs = list("ab'stLl1 2 \n\t\r  .,!é漢字²½Ⅷ\x1c\x85  😀<|>")
    found = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 30))) for _ in range(3000)] + ["<|endoftext|>", "x" * 3000]
    assert [ids.tolist() for ids in coder.encode(found)] == [other.encode_ordinary(t) for t in found]
    monkeypatch.setattr(byte_bpe, "PART", 25)
    monkeypatch.setattr(byte_bpe, "CACHE", 100)
    for text in found[:800]:
        ids = coder.encode([text + " " + text * 3])[0].tolist()
        assert ids == other.encode_ordinary(text + " " + text * 3)
        assert coder.decode(ids) == (text + " " + text * 3).encode()


def test_offsets_cover_the_characters(data):
    coder = byte_bpe.Coder(data, public_tokenizers.PATTERN)
    for text in ("", "plain words", "漢字 and 👩‍👩‍👧 é"):
        ids = coder.encode([text])[0]
        starts, ends = coder.offsets(text, ids)
        for i, (a, b) in enumerate(zip(starts, ends, strict=True)):
            assert coder.table[ids[i]] in text[a:b].encode()
        assert sorted({k for a, b in zip(starts, ends, strict=True) for k in range(a, b)}) == list(range(len(text)))


def test_table(spark, other):
    words = vocabulary(spark)
    coded = byte_bpe.decode(byte_bpe.encode(documents(spark), words, offsets=True), words)
    assert coded.columns.count("ids") == 1
    rows = coded.select("text", "ids", "decoded", "offsets", "n", *digests(coded)).collect()
    assert len(rows) == len(texts())
    for r in rows:
        text = r["text"] or ""
        assert r["ids"] == other.encode_ordinary(text) and bytes(r["decoded"]) == text.encode()
        assert r["n_tokens"] == len(r["ids"]) == len(r["offsets"]) and r["n"] == 1
    assert byte_bpe.encode(documents(spark, []), words).count() == 0


def test_split_characters(spark, other):
    ids = other.encode_ordinary("👩‍👩‍👧")
    words = vocabulary(spark)
    df = spark.createDataFrame([(ids[:1],), (ids,), (None,)], "ids array<int>")
    found = byte_bpe.decode(df, words).select(byte_bpe.split_characters("decoded").alias("t")).collect()
    assert found[0]["t"].endswith("�") and found[1]["t"] == "👩‍👩‍👧" and found[2]["t"] is None


def test_query_reads_all(spark):
    assert op1_byte_bpe(spark, "/root/testdata/sf0.001").count() == 200
