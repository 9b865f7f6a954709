"""Boilerplate lines and benchmark items against plain Python."""

import os
import re
import sys

sys.path.insert(0, os.path.dirname(__file__))

from cases import documents, sentence, texts  # noqa: E402

from silverloom.llm import decontaminate, line_dedup  # noqa: E402


def lines_kept(rows, sites):
    """Text, lines and lines removed of each row."""
    spread, first = {}, {}
    order = lambda i: (i is not None, i or 0)
    for i, t, _, s, *_ in rows:
        for pos, line in enumerate(t.split("\n") if t is not None else []):
            key = line.strip(" ")
            if key:
                spread.setdefault(key, set()).update({s} - {None})
                first[key] = min(first.get(key, (order(i), pos)), (order(i), pos))
    out = []
    for i, t, *_ in rows:
        if t is None:
            out.append((i, None, 0, 0))
            continue
        lines = t.split("\n")
        kept = [
            line for pos, line in enumerate(lines)
            if not line.strip(" ") or len(spread[line.strip(" ")]) < sites or first[line.strip(" ")] == (order(i), pos)
        ]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def test_lines(spark):
    for sites in (2, 5, 10):
        cleaned = line_dedup.drop_boilerplate(documents(spark), min_sites=sites)
        assert cleaned.columns == [*documents(spark).columns, "n_lines", "n_removed"]
        got = [(r["doc_id"], r["text"], r["n_lines"], r["n_removed"]) for r in cleaned.collect()]
        want = lines_kept(texts(), sites)
        assert sorted(got, key=repr) == sorted(want, key=repr)
        assert sum(w[3] for w in want) > 5
    again = documents(spark).selectExpr("*", "1 as n_lines", "2 as N_REMOVED")
    assert line_dedup.drop_boilerplate(again).columns == [*documents(spark).columns, "n_lines", "n_removed"]


def test_lines_take_no_python(spark, plan):
    assert not re.search("Python|Arrow|Pandas", plan(line_dedup.drop_boilerplate(documents(spark))))


def test_exact_counts_near_the_threshold(spark):
    """Lines of one site less than, as many as, and more than the threshold."""
    rows = [(100 * n + k, f"line of {n}", "en", f"site{k}") for n in (38, 39, 40, 41, 60) for k in range(n)]
    lines = line_dedup.lines_of(documents(spark, rows), "doc_id", "text", "source")
    found = {r["line"]: r["near"] for r in line_dedup.candidates(lines, 40).collect()}
    assert len(found) == 5 - sum(n < 40 - line_dedup.near_width(40) for n in (38, 39)) and list(found.values()).count(False) == 1
    cleaned = line_dedup.drop_boilerplate(documents(spark, rows), min_sites=40).collect()
    assert {r["doc_id"] // 100 for r in cleaned if r["n_removed"]} == {40, 41, 60}
    assert sum(r["n_removed"] for r in cleaned) == 39 + 40 + 59


def test_empty_table_of_lines(spark):
    assert line_dedup.drop_boilerplate(documents(spark, [])).count() == 0


def plain(text):
    return re.sub(r"[\W_]+", " ", (text or "").lower()).split()


def shingles(words, size):
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def expected_pairs(docs, items):
    classes = {}
    for i, t in items:
        words = plain(t)
        if words and i is not None:
            size = min(5, len(words))
            key = (size, frozenset(shingles(words, size)))
            classes[key] = min(classes.get(key, i), i)
    out = {}
    for d, t, *_ in docs:
        words = plain(t)
        for (size, own), item in classes.items():
            shared = len(own & shingles(words, size))
            if shared * 10 >= 8 * len(own):
                out[d, item] = max(out.get((d, item), (0, 0)), (shared, len(own)))
    return out


def leaks():
    """Documents with whole items, most of an item, and too little of one."""
    import random

    rng = random.Random(12)
    items = [(i, sentence(rng, "en", n)) for i, n in enumerate((3, 4, 5, 6, 9, 14, 15, 16, 40, 64, 65, 300))]
    docs = []
    for i, t in items:
        words = t.split()
        for part in (1.0, 0.9, 0.85, 0.7, 0.4):
            n = max(1, round(part * len(words)))
            docs.append((len(docs) + 1000, " ".join([sentence(rng, "de", 60), *words[:n], sentence(rng, "de", 60)]), "de", "s"))
        docs.append((len(docs) + 1000, sentence(rng, "de", 3000) + "! " + ", ".join(words).upper() + " " + sentence(rng, "es", 10), "de", "s"))
    items += [(50, items[5][1].upper() + "!"), (51, ""), (52, None), (None, items[6][1]), (53, "... ---")]
    return docs, items


def test_leaks(spark):
    docs, items = leaks()
    docs += texts() + docs[:2]
    bench = spark.createDataFrame([(i, t, 0, "x") for i, t in items], "item_id long, text string, hash int, item string")
    found = decontaminate.contaminated_pairs(documents(spark, docs), bench).collect()
    want = expected_pairs(docs, items)
    assert {(r["doc_id"], r["item_id"]): (r["n_shared"], r["n_shingles"]) for r in found} == want
    assert len(found) == len(want) > 40
    clean = decontaminate.without_benchmark(documents(spark, docs), bench)
    assert clean.columns == documents(spark).columns
    dirty = {t for d, t, *_ in docs if any(d == k[0] for k in want)}
    assert sorted((r["doc_id"], r["text"]) for r in clean.where("doc_id is not null").collect()) == sorted(
        (d, t) for d, t, *_ in docs if d is not None and t not in dirty
    ) if None not in {t for _, t, *_ in docs} else clean.count() == sum(t not in dirty for _, t, *_ in docs)


def test_full_bitmaps_lose_nothing(spark, monkeypatch):
    docs, items = leaks()
    monkeypatch.setattr(decontaminate, "BITS", (64, 64))
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contaminated_pairs(documents(spark, docs), bench).collect()
    assert {(r["doc_id"], r["item_id"]): (r["n_shared"], r["n_shingles"]) for r in found} == expected_pairs(docs, items)


def test_items_without_id(spark):
    """They are items: of equal size they are told apart, and one with the text of a named item has its name."""
    docs, items = leaks()
    nameless = [(None, items[k][1]) for k in (4, 6)] + [(None, t) for _, t in items[7:9]] + [(None, " ".join(items[8][1].split()[::-1]))]
    bench = spark.createDataFrame([items[4], *nameless, (None, None), (None, "...")], "item_id long, text string")
    found = decontaminate.contaminated_pairs(documents(spark, docs), bench)
    want = expected_pairs(docs, [items[4], *[(1000 + i, t) for i, (_, t) in enumerate(nameless[1:])]])
    got = [(r["doc_id"], r["item_id"], r["n_shared"], r["n_shingles"]) for r in found.collect()]
    key = lambda r: (r[0], r[1] is None, r[2:])
    assert sorted(got, key=key) == sorted(((d, None if i >= 1000 else i, *n) for (d, i), n in want.items()), key=key)
    assert sum(r[1] is None for r in got) > 8 and found.columns == ["doc_id", "item_id", "n_shingles", "n_shared", "containment"]
    dirty = {d for d, _ in want}
    assert {r["doc_id"] for r in decontaminate.without_benchmark(documents(spark, docs), bench).collect()} == {d[0] for d in docs} - dirty
    twins = [(None, "one two three four five six"), (None, "six five four three two one")]
    both = documents(spark, [(7, " ".join(t for _, t in twins), "en", "s")])
    found = decontaminate.contaminated_pairs(both, spark.createDataFrame(twins, "item_id long, text string")).collect()
    assert [(r["doc_id"], r["item_id"], r["n_shared"]) for r in found] == [(7, None, 2)] * 2


def test_empty_tables_of_leaks(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated_pairs(documents(spark), none).count() == 0
    assert decontaminate.without_benchmark(documents(spark), none).count() == len(texts())
    assert decontaminate.contaminated_pairs(documents(spark, []), none).count() == 0


def test_items_are_cut_once(spark, plan, monkeypatch):
    """The filter on empty items is no second evaluation, which would take a second Python worker."""
    seen = []
    monkeypatch.setattr(decontaminate, "settled", lambda df, name: seen.append(plan(df)) or df)
    items = spark.createDataFrame([(1, "one two three four five six"), (2, " .. "), (3, None), (None, "a b")], "item_id long, text string")
    found = decontaminate.item_shingles(items, "item_id", "text", 0.8)
    assert {r["item"] for r in found.collect()} == {1} and seen[0].count("ArrowEvalPython [") == 1
