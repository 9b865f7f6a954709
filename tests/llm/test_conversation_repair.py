"""Repair of conversations against plain recursion."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from silverloom.llm import conversation_repair as cr
from silverloom.llm.conversation_repair import ASSISTANT, START, SYSTEM, USER, Path, Row, before, ended, follow, moves, repair
from silverloom.llm.queries.op11 import damaged, op11_conversation_repair

SCHEMA = "conv_id long, turn long, role string, text string, audit string, kind int, part int"
SIGN = re.compile(r"[^\x20\x09-\x0D]")


def cheapest(rows):
    """Least (cost, audit) from each place on; ``rows`` holds (initial, fault)."""

    @lru_cache(None)
    def rest(i, state, inserted):
        offers = [(0, "")] if i == len(rows) and state in ("", "a") else []
        after = {"": "u", "s": "u", "a": "u", "u": "a"}[state]
        if inserted < 3:
            c, audit = rest(i, after, inserted + 1)
            offers.append((c + 3, "I" + audit))
        if i < len(rows):
            initial, fault = rows[i]
            c, audit = rest(i + 1, state, 0)
            offers.append((c + 4, "D" + audit))
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                c, audit = rest(i + 1, after, 0)
                offers.append((c + 3 + more, "R" + audit))
                if initial == after or (initial == "s" and state == ""):
                    c, audit = rest(i + 1, initial, 0)
                    offers.append((c + more, "K" + audit))
        return min(offers, default=(10**9, ""))

    for i in range(len(rows), -1, -1):
        for state in ("", "s", "u", "a"):
            rest(i, state, 0)
    return rest(0, "", 0)


def plain_damage(rows):
    out = []
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        h = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        out += [(c, t, "user" if h == 4 else role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    return out


def plain(rows, everyone):
    """conv_id: the row of the contract, and the repaired turns."""
    out = {}
    for conv in everyone:
        own = sorted(
            ((t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv),
            key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()),
        )
        seen, faults = set(), []
        for _, role, text in own:
            signs = SIGN.findall(text)
            faults.append("blank" if not signs else "duplicate" if (role, text) in seen else "good" if signs[-1] in ".!?" else "truncated")
            seen.add((role, text))
        turns = {t for t, *_ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        gaps = (gaps + 2**63) % 2**64 - 2**63  # a difference that no long holds wraps around
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(own, own[1:], strict=False)]
        cost, audit = cheapest([(r[1][:1], f) for r, f in zip(own, faults, strict=True)])
        said, i = [], 0
        for edit in audit:
            expected = "assistant" if said and said[-1][0][:1] == "u" else "user"
            if edit == "I":
                said.append((expected, ""))
                continue
            if edit != "D":
                said.append((own[i][1] if edit == "K" else expected, own[i][2]))
            i += 1
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest()
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest, said)
    return out


def compare(found, want):
    rows = {r["conv_id"]: r for r in found.conversations.collect()}
    assert rows.keys() == want.keys()
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    for conv, w in want.items():
        assert tuple(rows[conv][n] for n in names) == w[:-1], conv
    said = {}
    for r in sorted(found.turns.collect(), key=lambda r: r["position"]):
        said.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert said == {c: w[-1] for c, w in want.items() if w[-1]}


def messages(rng, n, conv):
    texts = ["Fine.", "And so on", "Why?", " ", "", "ok.", "Go on!\n", "e. g. this,", "\x1c", "é…"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", "User", "ukulele", None]
    return [(conv, rng.choice([None, i, i, i, i // 2]), rng.choice(roles[: rng.randint(2, 10)]), rng.choice([*texts, None, f"t{i}.", f"u{i}"])) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "own", 1, 2) for r in rows], SCHEMA)


@pytest.mark.parametrize("base", [cr._BASE, 0])  # with 0 all audits of one step have hashes that collide
def test_search(monkeypatch, base):
    monkeypatch.setattr(cr, "_BASE", base)
    if not base:
        monkeypatch.setattr(cr, "_PRIME", 1)
    rng = random.Random(7)
    for _ in range(400):
        rows = [(rng.choice("suax" if rng.random() < 0.3 else "ua"), rng.choice(["good", "good", "truncated", "blank"])) for _ in range(rng.randint(0, 14))]
        given = [Row(r, f != "blank", f == "truncated", int(f == "blank")) for r, f in rows]
        cells, at = {START: (0, Path())}, 0
        while at < len(given):  # any cut into pieces gives the same
            size = rng.randint(1, 6)
            cells = follow(cells, moves(given[at : at + size], (START, SYSTEM, USER, ASSISTANT)))
            at += size
        cost, path = ended(cells)
        assert (cost, "".join(path.labels())) == cheapest(tuple(rows))


def test_paths_part_at_the_first_difference():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.choice("DK") for _ in range(rng.randint(1, 40))] for _ in range(2))
        b = a[: rng.randint(0, len(a))] + b
        n = min(len(a), len(b))
        root = Path()
        ends = []
        for labels in (a[:n], b[:n]):
            node = root
            for label in labels:
                node = Path(node, label)
            ends.append(node)
        assert before(*ends) == (a[:n] < b[:n])


@pytest.mark.parametrize("size", [1, 3, 2048])
def test_awkward_rows(spark, size):
    rng = random.Random(size)
    rows = [m for conv in range(30) for m in messages(rng, rng.randint(1, 12), conv)]
    rows += [(None, None, None, None), (None, 3, "user", "Null."), (77, 2**63 - 1, "user", "Last."), (77, -(2**62), "assistant", "First.")]
    rows += [rows[0]] * 5
    want = plain(rows, {r[0] for r in rows})
    compare(repair(frame(spark, rows), piece=size), want)


def test_damaged_rows(spark):
    rng = random.Random(1)
    rows = [m for conv in range(60) for m in messages(rng, rng.randint(1, 5), conv)]
    gone = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows += [(gone, 0, "user", "It goes.")] * 2 + [(None, None, None, None)]
    found = repair(damaged(frame(spark, rows)), "times")
    compare(found, plain(plain_damage(rows), {r[0] for r in rows}))
    lost = found.conversations.where(F.col("conv_id") == gone).first()
    assert (lost["cost"], lost["audit"], lost["repaired_sha256"]) == (0, "", hashlib.sha256(b"").hexdigest())


def test_one_conversation_of_many_rows(spark):
    """It is cut over all tasks; its equal rows are one."""
    rng = random.Random(8)
    rows = [(5, i, rng.choice(["user", "assistant"]), rng.choice([f"t{i}.", f"t{i}", "same."])) for i in range(3000)]
    rows += [(5, 7, "user", "again and again")] * 2000 + [(6, 0, "user", "Hi."), (6, 1, "assistant", "Hi!")]
    turns = frame(spark, rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the table is small
    try:
        spread = cr.pieces(cr.faults(turns), 200).where("conv_id = 5").select("part", "rows").collect()
        assert len({r["part"] for r in spread}) > 2 and max(r["rows"] for r in spread) < 2300
        compare(repair(turns, piece=200), plain(rows, {5, 6}))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_empty_table(spark):
    found = repair(frame(spark, []))
    assert found.conversations.collect() == [] and found.turns.collect() == []


def test_query_on_the_given_conversations(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = plain(plain_damage(rows), {r[0] for r in rows})
    found = {r["conv_id"]: tuple(r)[1:] for r in op11_conversation_repair(spark, folder).collect()}
    assert found == {c: w[:-1] for c, w in want.items()}
