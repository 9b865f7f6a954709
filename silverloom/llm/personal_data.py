"""Personal data in texts: patterns, and a skip-chain conditional random field that adds what the patterns miss.

The patterns find the base spans (e-mail addresses, IP addresses, card and phone numbers). Words with a digit or an at sign are
the tokens of the field; all other words belong to no kind. A token's variable is one of the four kinds or none. Its potentials
are those of its shape, those it shares with a token that is the next word, and, over any distance, those it shares with
tokens that repeat it or are similar: the same letters and digits whatever the marks between them, or the same last digits.
Loopy message passing (sum-product, in rounds, damped) carries labels along both kinds of edges, so that one entity gets one
label wherever it stands in the document. Tokens of base spans hold their label; a token that gets a kind with enough
confidence adds a span, if the span has enough signs or digits to be of the kind.

The weights are learned from the base spans of all documents by pseudo-likelihood: tokens are counted by shape, label and
labels of their neighbours (at most SHAPES x 36 x 126 x 5 different rows, whatever the corpus), and only these counts reach
the driver. Where the counts say nothing the prior holds: a shape is of no kind (ABSENT), linked tokens agree (AGREE).

Defined results: a null or empty text has no spans. Offsets are code points, ends exclusive. Base matches that fail their check
are dropped and not tried again. Rows are independent: repeated rows, ties and other columns change nothing. A column of the
input with the name of an output column is replaced. Texts are taken whole; the time is linear in their length.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverloom.llm.hashing import pieces
from silverloom.llm.ship import ship

KINDS = ("email", "ip", "card", "phone")
NONE = 0  # labels: none, then the kinds in their order
LABELS = 1 + len(KINDS)
ROUNDS = 30
DAMPING = 0.5
#: Probability at which a token of no base span gets a kind.
CONFIDENCE = 0.8
#: Prior means of the potentials: of no kind for each shape, of one label at both ends of a link over a distance.
ABSENT, AGREE = 3.0, 5.0
#: Letters and digits that a repeated token must have, and last digits that make numbers similar.
KEY, TAIL = 6, 7
#: Bytes of text that are looked at together.
SLICE = 1 << 20

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SIGN = re.compile(r"[0-9@]")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
QUAD = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
DIGITS = re.compile(r"[0-9]++(?:[\x20-][0-9]++)*+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
NUMBER = re.compile(r"[0-9]")
RUN = re.compile(r"[A-Za-z0-9._%+-]")

SHAPES = (
    "email", "at", "quad", "quad_over", "plus", "area", "luhn", "long", "huge", "assigned", "quoted", "code_short", "code_long",
    "dashed_short", "dashed_7", "dashed_long", "dotted_short", "dotted_long", "marked", "digits_1", "digits_2", "digits_3", "digits_4", "digits_6",
    "digits_8", "digits_12",
)
SPAN = "array<struct<kind:string,start:int,end:int>>"

Span = tuple[int, int, int]  # label, start, end


def luhn(digits: str) -> bool:
    """Does the check digit fit?"""
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def small(parts: tuple[str, ...]) -> bool:
    """Are all these numbers 255 or less?"""
    return all(len(p) <= 3 and int(p or 0) <= 255 for p in (part.lstrip("0") for part in parts))


def _emails(text: str) -> Iterator[Span]:
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and RUN.match(text, start - 1):
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        free = match.end() if match else at + 1
        if match:
            yield 1, start, free
        at = text.find("@", free)


def base_spans(text: str) -> list[Span]:
    """The spans of the patterns, by kind, then start."""
    out = list(_emails(text)) if "@" in text else []
    if NUMBER.search(text):
        if "." in text:
            out += [(2, m.start(), m.end()) for m in QUAD.finditer(text) if small(m.groups())]
        for m in DIGITS.finditer(text):
            if m.end() - m.start() >= 13:
                digits = "".join(NUMBER.findall(m.group()))
                if 13 <= len(digits) <= 19 and luhn(digits):
                    out.append((3, m.start(), m.end()))
        if "+" in text:
            out += [(4, m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(NUMBER.findall(m.group())) <= 15]
    return out


def shape(core: str) -> int:
    """What a token looks like: its place in SHAPES."""
    return SHAPES.index(_shape(core))


def _shape(core: str) -> str:
    if "@" in core:
        return "email" if EMAIL.fullmatch(core) else "at"
    n = len(NUMBER.findall(core))
    if any(c.isalpha() for c in core):
        return "assigned" if "=" in core else "quoted" if '"' in core else "code_short" if len(core) < 16 else "code_long"
    quad = QUAD.fullmatch(core)
    if quad:
        return "quad" if small(quad.groups()) else "quad_over"
    if core[0] == "+":
        return "plus"
    if "(" in core:
        return "area"
    if n >= 13:
        return "huge" if n > 19 else "luhn" if luhn("".join(NUMBER.findall(core))) else "long"
    if "-" in core:
        return "dashed_short" if n < 7 else "dashed_7" if n == 7 else "dashed_long"
    if "." in core:
        return "dotted_short" if n < 7 else "dotted_long"
    if n < len(core):
        return "marked"
    return f"digits_{n if n < 5 else 6 if n < 7 else 8 if n < 9 else 12}"


class Tokens(NamedTuple):
    """The field of one document: tokens, and edges between token numbers."""

    spans: list[tuple[int, int]]
    shapes: list[int]
    labels: list[int]  # of the base spans
    next: list[tuple[int, int]]  # a token and the next word
    skip: list[tuple[int, int]]  # a token and the next one that repeats it or is similar


def tokens(text: str, base: list[Span]) -> Tokens:
    spans, shapes, chain, skip, words = [], [], [], set(), []
    last: dict[tuple[str, str], int] = {}
    for number, m in enumerate(WORD.finditer(text)):
        word = m.group()
        if not SIGN.search(word):
            continue
        i, j = m.span()
        while not (text[i].isalnum() or text[i] in "+("):
            i += 1
            if i == j:
                break
        while j > i and not (text[j - 1].isalnum() or text[j - 1] == ")"):
            j -= 1
        if i == j:
            continue
        me, core = len(spans), text[i:j]
        spans.append((i, j))
        shapes.append(shape(core))
        if words and words[-1] == number - 1:
            chain.append((me - 1, me))
        words.append(number)
        key = "".join(c for c in core if c.isalnum()).casefold()
        keys = [("all", key)] if len(key) >= KEY else []
        if key.isdigit() and len(key) >= TAIL:
            keys.append(("tail", key[-TAIL:]))
        for k in keys:
            if k in last and (not chain or chain[-1] != (last[k], me)):
                skip.add((last[k], me))
            last[k] = me
    labels, at = [NONE] * len(spans), sorted(base, key=lambda s: (s[1], s[0]))
    b = 0
    for t, (i, j) in enumerate(spans):
        while b < len(at) and at[b][2] <= i:  # spans of one kind do not overlap, so few of them reach on
            b += 1
        over = [s[0] for s in at[b : b + 2 * LABELS] if s[1] < j and s[2] > i]
        labels[t] = min(over, default=NONE)
    return Tokens(spans, shapes, labels, chain, sorted(skip))


# --- weights -------------------------------------------------------------------------------------------------------------


class Weights(NamedTuple):
    """Log-potentials: of a shape and a label, of neighbours (left, right), of tokens linked over a distance."""

    shape: np.ndarray
    next: np.ndarray
    skip: np.ndarray


def situations(field: Tokens) -> Iterator[str]:
    """For each token: shape, label, label of the left and of the right neighbour, labels at the ends of its skip edges."""
    left, right = {b: a for a, b in field.next}, dict(field.next)
    far: dict[int, list[int]] = {}
    for a, b in field.skip:
        far.setdefault(a, []).append(field.labels[b])
        far.setdefault(b, []).append(field.labels[a])
    for t, kind in enumerate(field.shapes):
        near = ["" if x is None else str(field.labels[x]) for x in (left.get(t), right.get(t))]
        yield f"{kind}|{field.labels[t]}|{near[0]}|{near[1]}|{''.join(map(str, sorted(far.get(t, ()))))}"


def learn(counts: dict[str, int], steps: int = 600, rate: float = 0.1, decay: tuple = (1e-5, 1e-3)) -> Weights:
    """Weights of the greatest penalised pseudo-likelihood of counted situations, by Adam in a fixed number of steps.

    ``decay`` draws the potentials of shapes and of pairs to their prior means. Pairs are held closer: pseudo-likelihood
    trusts the labels of neighbours too much.
    """
    # one vector: shapes, neighbours, far links (symmetric), and a last entry that stays 0
    near = len(SHAPES) * LABELS
    far, nothing = near + LABELS**2, near + 2 * LABELS**2
    prior = np.zeros(nothing + 1)
    prior[NONE:near:LABELS] = ABSENT
    prior[far : nothing : LABELS + 1] = AGREE
    hold = np.where(np.arange(nothing + 1) < near, *decay)
    keys = sorted(counts)
    index = np.full((len(keys), LABELS, 7), nothing)
    chosen = np.zeros((len(keys), LABELS))
    for r, key in enumerate(keys):
        kind, label, left, right, linked = key.split("|")
        chosen[r, int(label)] = 1
        for y in range(LABELS):
            row = [int(kind) * LABELS + y]
            row += [near + int(left) * LABELS + y] if left else []
            row += [near + y * LABELS + int(right)] if right else []
            row += [far + min(y, int(z)) * LABELS + max(y, int(z)) for z in linked]
            index[r, y, : len(row)] = row
    weight = np.array([counts[k] for k in keys], float)
    weight /= max(1.0, weight.sum())
    x, m, v = prior.copy(), np.zeros(nothing + 1), np.zeros(nothing + 1)
    for step in range(1, steps + 1 if keys else 1):
        score = x[index].sum(2)
        p = np.exp(score - score.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        slope = np.repeat(((chosen - p) * weight[:, None])[:, :, None], index.shape[2], axis=2)
        g = np.bincount(index.ravel(), slope.ravel(), nothing + 1) - hold * (x - prior)
        g[nothing] = 0
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        x = x + rate / (1 + step / 200) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-10)
    pair = x[far:nothing].reshape(LABELS, LABELS)
    return Weights(x[:near].reshape(-1, LABELS), x[near:far].reshape(LABELS, LABELS), np.triu(pair) + np.triu(pair, 1).T)


def fit(docs: DataFrame, text: str = "text") -> Weights:
    """Learn from the base spans of all documents. Only counts of situations, bounded in number, come to the driver."""
    ship(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter[str] = Counter()
            for t in batch.column(0).to_pylist():
                found.update(situations(tokens(t, base_spans(t))))
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["s", "n"])

    suspects = docs.select(F.col(text).alias("t")).where(F.col("t").rlike("[0-9@]"))
    counts = suspects.mapInArrow(count, "s string, n long").groupBy("s").agg(F.sum("n").alias("n"))
    return learn({r["s"]: r["n"] for r in counts.collect()})


# --- message passing -----------------------------------------------------------------------------------------------------


def _sums(x: np.ndarray) -> np.ndarray:
    """log of the sum of exponentials over the first label."""
    top = x.max(1, keepdims=True)
    return top[:, 0] + np.log(np.exp(x - top).sum(1))


def marginals(fields: list[Tokens], w: Weights) -> np.ndarray:
    """The probability of each label for the tokens of all these documents, one after the other.

    Documents share no edge and the number of rounds is fixed, so the company of a document changes nothing.
    """
    first = np.concatenate([[0], np.cumsum([len(f.spans) for f in fields])]).astype(np.int64)
    own = w.shape[np.array([s for f in fields for s in f.shapes], np.int64)]
    known = np.array([y for f in fields for y in f.labels], np.int64)
    held = known != NONE
    own[held] = -1e6
    own[held, known[held]] = 0
    edges = [np.array([(a + i, b + i) for f, i in zip(fields, first[:-1], strict=True) for a, b in getattr(f, kind)], np.int64).reshape(-1, 2) for kind in ("next", "skip")]
    both = np.concatenate(edges)
    tables = np.concatenate([np.repeat(t[None], len(e), axis=0) for t, e in zip((w.next, w.skip), edges, strict=True)])
    source, target = np.concatenate([both[:, 0], both[:, 1]]), np.concatenate([both[:, 1], both[:, 0]])
    tables = np.concatenate([tables, tables.transpose(0, 2, 1)])  # [edge, label of source, label of target]
    back = np.concatenate([np.arange(len(both)) + len(both), np.arange(len(both))])
    sent = np.zeros((len(source), LABELS))

    def belief() -> np.ndarray:
        total = own.copy()
        np.add.at(total, target, sent)
        return total

    for _ in range(ROUNDS if len(source) else 0):
        new = _sums((belief()[source] - sent[back])[:, :, None] + tables)
        new -= new.max(1, keepdims=True)
        sent = DAMPING * sent + (1 - DAMPING) * new
    total = belief()
    p = np.exp(total - total.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def enough(label: int, part: str) -> bool:
    """Has a span what its kind needs at least?"""
    n = len(NUMBER.findall(part))
    if label == 1:
        return "@" in part and len(part) >= KEY
    if label == 2:
        return len(re.findall(r"[0-9]+", part)) == 4
    return 12 <= n <= 19 if label == 3 else TAIL <= n <= 15


def added(text: str, field: Tokens, p: np.ndarray) -> list[Span]:
    """Spans of tokens that got a kind; neighbours of one card or phone number are one span if that can be one."""
    best = p.argmax(1)
    label = np.where((p.max(1) >= CONFIDENCE) & (np.array(field.labels) == NONE), best, NONE).tolist()
    follows = {b for _, b in field.next}
    groups: list[list[int]] = []
    for t, y in enumerate(label):
        if y == NONE:
            continue
        if groups and t in follows and groups[-1][-1] == t - 1 and label[t - 1] == y and y >= 3:
            groups[-1].append(t)
        else:
            groups.append([t])
    out = []
    for g in groups:
        y, whole = label[g[0]], (field.spans[g[0]][0], field.spans[g[-1]][1])
        spans = [whole] if enough(y, text[slice(*whole)]) else [field.spans[t] for t in g]
        out += [(y, i, j) for i, j in spans if enough(y, text[i:j])]
    return out


def find(texts: list[str | None], w: Weights) -> list[tuple[list[Span], list[Span]]]:
    """For each text the base spans and all spans, by kind, then start."""
    out: list[tuple[list[Span], list[Span]]] = []
    fields, at = [], []
    for i, t in enumerate(texts):
        base = base_spans(t) if t else []
        out.append((base, base))
        field = tokens(t, base) if t and SIGN.search(t) else None
        if field and field.spans:
            fields.append(field)
            at.append(i)
    if fields:
        p, first = marginals(fields, w), 0
        for i, field in zip(at, fields, strict=True):
            more = added(texts[i], field, p[first : first + len(field.spans)])
            first += len(field.spans)
            if more:
                out[i] = (out[i][0], sorted({*out[i][0], *more}))
    return out


def personal_spans(text: Column, w: Weights) -> Column:
    """base (spans of the patterns) and spans (all) of each text, as a struct."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def struct(column: pa.Array) -> pa.Array:
        signs = pc.match_substring_regex(column, "[0-9@]").to_pylist()
        both = find([t.as_py() if there else None for t, there in zip(column, signs, strict=True)], w)
        listed = [[[{"kind": KINDS[y - 1], "start": i, "end": j} for y, i, j in pair[k]] for pair in both] for k in (0, 1)]
        return pa.StructArray.from_arrays([pa.array(x, kind) for x in listed], ["base", "spans"])

    @F.arrow_udf(f"base {SPAN}, spans {SPAN}")
    def found(column: pa.Array) -> pa.Array:
        table = pa.RecordBatch.from_arrays([column], ["text"])
        parts = [struct(part.column(0)) for part in pieces(iter([table]), "text", SLICE)]
        return pa.concat_arrays(parts) if parts else struct(column)

    return found(text)


def with_personal_spans(docs: DataFrame, w: Weights, text: str = "text") -> DataFrame:
    """Add ``base`` and ``spans`` to every row."""
    ship(docs.sparkSession)
    names = {"base": "_personal.base", "spans": "_personal.spans"}
    rows = docs.withColumn("_personal", personal_spans(F.col(text), w))
    return rows.select(*[F.col(c) for c in docs.columns if c not in names], *[F.col(c).alias(n) for n, c in names.items()])


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span, or spans that overlap, replaced by the kind of the first in brackets."""
    masked = F.aggregate(
        F.sort_array(F.transform(spans, lambda s: F.struct(s["start"], s["end"], s["kind"]))),
        F.struct(F.lit("").alias("done"), F.lit(0).alias("at")),
        lambda a, s: F.when(
            s["start"] >= a["at"],
            F.struct(
                F.concat(a["done"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("done"),
                s["end"].alias("at"),
            ),
        ).otherwise(F.struct(a["done"].alias("done"), F.greatest(a["at"], s["end"]).alias("at"))),
        lambda a: F.concat(a["done"], F.substring(text, a["at"] + 1, F.length(text))),
    )
    return masked
