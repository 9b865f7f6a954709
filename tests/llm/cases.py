"""Small tables with the awkward rows that every operator must take."""

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key long, ids string, hash int, row string, n int"
SYLLABLES = {"en": ["the", "th", "ing", "ou", "er"], "es": ["ción", "que", "ado", "os", "la"], "de": ["sch", "ung", "der", "ei", "ich"]}


def sentence(rng: random.Random, lang: str, words: int) -> str:
    out = ["".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(words)]
    return " ".join(out)


def texts(seed: int = 5) -> list[tuple]:
    """(doc_id, text, lang, source): copies, near copies, shared passages, blanks, nulls, odd characters, repeated rows."""
    rng = random.Random(seed)
    rows = []
    for i in range(40):
        lang = rng.choice(list(SYLLABLES))
        lines = [sentence(rng, lang, rng.randint(3, 40)) for _ in range(rng.randint(1, 6))]
        rows.append((i, "\n".join(lines), lang, f"s{rng.randint(0, 12)}"))
    passage, boiler = sentence(rng, "en", 90), "All of it is ours. Do not take it."
    for i in range(40, 56):
        body = sentence(rng, "en", 30)
        rows.append((i, f"{body}\n{passage if i % 2 else ''}\n {boiler}\n{sentence(rng, 'en', 20)}", "en", f"s{i % 14}"))
    for i in range(56, 62):  # copies and near copies
        words = rows[3][1].split(" ")
        if i % 2:
            words[len(words) // 2] = f"edit{i}"
        rows.append((i, " ".join(words), rows[3][2], "s1"))
    loop = sentence(rng, "de", 12) + " "
    odd = [
        "", " \t\n", "!!! 12 ...", "a", "a b", "a b c", "ABC abc\x0bd\x1ce", loop * 9, "  two  blanks \n\n\nlines ", "é" * 500,
        "漢字かな交じり文 ²½Ⅷ", "x y z", "\x00nul\x00" * 120, "😀 family 👩‍👩‍👧", "aaaa " * 200,
    ]
    rows += [(100 + i, t, None if i % 3 else "en", None if i % 4 else "s0") for i, t in enumerate(odd)]
    rows += [(200, None, "en", "s0"), (None, passage, None, None), (None, None, None, None), (201, passage.upper(), "en", "s2")]
    rows += [rows[2], rows[2], (5, "another text of one doc_id", "en", "s3"), (202, sentence(rng, "es", 9000), "es", "s4")]
    return rows


def documents(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    """The rows with columns whose names clash with those inside the operators."""
    rows = texts() if rows is None else rows
    return spark.createDataFrame([(*r, len(r[1] or ""), 7, "own", 3, "r", 1) for r in rows], SCHEMA)
