"""Cheapest repair of the turns of conversations, with an audit of the edits.

A row is at fault if it is blank, a duplicate (role and text seen earlier in its conversation) or truncated (its last sign does
not end a sentence); the first of these counts. Edits go through the rows in order: Keep (0), Rerole to user or assistant (3),
Delete (4; the only choice for blank and duplicate rows), and Insert an empty user or assistant turn anywhere (3); a truncated
row that stays adds 3. What stays must begin with at most one system turn and then alternate user, assistant, to the end, or be
nothing. The audit holds the initials of the edits; of the cheapest repairs the one with the least audit is taken.

The repair is a search over four states (nothing yet, system, user, assistant). An audit is a path of linked nodes: paths
share their beginnings, each node knows its ancestors at distances of powers of two and the rolling hash of its labels, so two
audits of one cost are compared at the step where they part, found by jumps; that what lies before is equal is verified. An
audit of one state is never the beginning of another one of the same rows and cost, so the least beginning is always the best.

Rows are ordered by turn (null first), then role, then hash of the text; equal rows are one row that counts several times, so a
row that is repeated without end costs one. Sorted ranges of rows are cut into pieces of at most PIECE rows, whatever
conversation they belong to: a piece maps each state to the cost and audit of every later state, so a conversation of any
length is searched by many tasks. Only the narrow pieces and the rows that may stay meet by conversation, as a sorted stream:
the digest of a conversation needs its texts in order, and no task holds them. Memory: one piece, and one audit.

Defined results: null roles and texts are one blank. A conversation whose rows are all gone has zeros, an empty audit and the
digest of nothing. A difference of turns that no long holds wraps around. Conversations without id are one conversation. Other columns are ignored. An empty table gives none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverloom.llm.ship import ship
from silverloom.llm.tables import settled

START, SYSTEM, USER, ASSISTANT = range(4)
RIGHT_PAIRS = {"su", "ua", "au"}
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Rows (equal ones counted once) of a piece.
PIECE = 2048

BLANK = r"[\x20\x09-\x0D]"
#: The state after a user or an assistant turn, by the state before it.
NEXT = (USER, USER, ASSISTANT, USER)
#: What an insertion must add at the end.
ENDING = {START: "", ASSISTANT: "", USER: "I", SYSTEM: "II"}

_PRIME, _BASE = (1 << 61) - 1, 0x1F3D5B79A2C4E6
MOVES = "array<struct<entry:int,exit:int,cost:long,audit:string,steps:string>>"
COUNTS = ("blank", "duplicate", "truncated", "illegal")


class Path:
    """A node of shared audits: the label of its step, its ancestors at distances 1, 2, 4, ..., the hash of its labels."""

    __slots__ = ("label", "steps", "up", "hash")

    def __init__(self, parent: Path | None = None, label: str = "", steps: str = ""):
        self.label, self.steps, self.up, self.hash = label, steps, [], 0
        if parent is not None:
            k, above = 0, parent
            while above is not None:
                self.up.append(above)
                above = above.up[k] if k < len(above.up) else None
                k += 1
            self.hash = (parent.hash * _BASE + int.from_bytes(label.encode()) + len(label) + 1) % _PRIME

    def labels(self, what: str = "label") -> list[str]:
        node, out = self, []
        while node.up:
            out.append(getattr(node, what))
            node = node.up[0]
        return out[::-1]


def _same(a: Path, b: Path) -> bool:
    """Have these nodes of one depth the same labels? They are read back to a node that both share."""
    while a is not b and a.up:
        if a.label != b.label:
            return False
        a, b = a.up[0], b.up[0]
    return True


def before(a: Path, b: Path) -> bool:
    """Are the labels of a before those of b? Both have the same number of steps, and no label begins another of its step."""
    x, y = a, b
    if x.hash != y.hash:
        for k in reversed(range(len(x.up))):
            if k < len(x.up) and x.up[k].hash != y.up[k].hash:
                x, y = x.up[k], y.up[k]
        if _same(x.up[0], y.up[0]):
            return x.label < y.label
    return a.labels() < b.labels()  # equal hashes: the same labels, or a collision


Cells = dict[int, tuple[int, Path]]


def best(offers: list[tuple[int, int, Path, str, str]]) -> Cells:
    """For each state the cheapest of (state, cost, path, label, steps), of equal cost the least audit."""
    least: dict[int, int] = {}
    for state, cost, *_ in offers:
        if cost < least.get(state, cost + 1):
            least[state] = cost
    out: Cells = {}
    for state, cost, path, label, steps in offers:
        if cost == least[state]:
            node = Path(path, label, steps)
            if state not in out or before(node, out[state][1]):
                out[state] = (cost, node)
    return out


def step(cells: Cells, initial: str, truncated: bool) -> Cells:
    """One row that may stay. A turn inserted before a deleted row comes behind it instead: that is the lesser audit."""
    offers = []
    for state, (cost, path) in cells.items():
        offers.append((state, cost + DELETE, path, "D", "D"))
        for inserted, now, price in (("", state, cost), ("I", NEXT[state], cost + INSERT)):
            stay = price + TRUNCATED * truncated
            offers.append((NEXT[now], stay + REROLE, path, inserted + "R", inserted + "R"))
            if initial == "s" and now == START:
                offers.append((SYSTEM, stay, path, inserted + "K", inserted + "K"))
            elif initial == "ua"[now == USER]:
                offers.append((NEXT[now], stay, path, inserted + "K", inserted + "K"))
    return best(offers)


class Row(NamedTuple):
    """Equal rows: initial of the role, whether the first of them may stay, whether it is truncated, how many are to go."""

    initial: str
    live: bool
    truncated: bool
    gone: int


def moves(rows: list[Row], entries: tuple[int, ...]) -> list[dict]:
    """From each entry state to each state after the rows: cost, audit, and its part for the rows that may stay."""
    forced = [0]  # rows that must go, behind each row that may stay
    for r in rows:
        if r.live:
            forced.append(0)
        forced[-1] += r.gone
    out = []
    for entry in entries:
        cells: Cells = {entry: (DELETE * sum(forced), Path())}
        for r in rows:
            if r.live:
                cells = step(cells, r.initial, r.truncated)
        for state, (cost, path) in cells.items():
            labels = path.labels()
            audit = "D" * forced[0] + "".join(x + "D" * n for x, n in zip(labels, forced[1:], strict=True))
            out.append({"entry": entry, "exit": state, "cost": cost, "audit": audit, "steps": "".join(labels)})
    return out


def follow(cells: Cells, piece: list[dict]) -> Cells:
    return best([(m["exit"], cells[m["entry"]][0] + m["cost"], cells[m["entry"]][1], m["audit"], m["steps"]) for m in piece if m["entry"] in cells])


def ended(cells: Cells) -> tuple[int, Path]:
    """The cheapest repair: what is missing at the end is inserted."""
    offers = [(0, cost + INSERT * len(ENDING[s]), path, ENDING[s], ENDING[s]) for s, (cost, path) in cells.items()]
    return best(offers)[0]


# --- rows ----------------------------------------------------------------------------------------------------------------


def _whole(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(" "))


def faults(turns: DataFrame, times: str | None = None) -> DataFrame:
    """Equal rows once, as a table: at (conv_id, turn), role, key, text, blank, ends, n (times that it stands there), first.

    ``first`` says that no earlier row of the conversation has this role and text. Rows of no times name their conversation.
    """
    n = F.lit(1) if times is None else F.col(times)
    own = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), _whole(F.col("role")).alias("role"), _whole(F.col("text")).alias("text"), n.cast("long").alias("n"))
    there = F.col("n") > 0
    rows = own.select(
        "conv_id",
        *[F.when(there, F.col(c)).alias(c) for c in ("turn", "role", "text")],
        F.when(there, F.unhex(F.sha2("text", 256))).alias("key"),
        (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        F.col("text").rlike(rf"[.!?]{BLANK}*\z").alias("ends"),
        F.when(there, F.col("n")).otherwise(0).alias("n"),
    )
    grouped = rows.groupBy(F.struct("conv_id", "turn").alias("at"), "role", "key").agg(
        F.first("text").alias("text"), F.first("blank").alias("blank"), F.first("ends").alias("ends"), F.sum("n").alias("n")
    )
    seen = rows.where(there & ~F.col("blank")).groupBy("conv_id", "role", "key").agg(
        F.max(F.col("turn").isNull()).alias("early"), F.min("turn").alias("least")
    )
    turn = F.when(~F.col("early"), F.col("least")).alias("turn")
    first = seen.select(F.struct("conv_id", turn).alias("at"), "role", "key", F.lit(True).alias("first"))
    return settled(grouped.join(first, ["at", "role", "key"], "left"), "turns")


ORDER = ("conv_id", "turn", "role", "key")


def pieces(rows: DataFrame, size: int = PIECE) -> DataFrame:
    """The pieces of all conversations: part and number give their order."""
    kind = rows.schema["at"].dataType["conv_id"].dataType.simpleString()
    narrow = rows.select(
        "at.conv_id", "at.turn", "role", "key", F.substring("role", 1, 1).alias("initial"), "n",
        F.when(F.col("n") == 0, "none").when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate")
        .when(F.col("ends"), "good").otherwise("truncated").alias("fault"),
    )
    ordered = narrow.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, schema = TaskContext.get().partitionId(), 0, None
        held: list[tuple] = []
        mine: tuple = ()
        opens = False  # does the conversation surely begin here

        def piece() -> pa.RecordBatch:
            out = {"conv_id": mine[0], "part": part, "number": number} | _piece(held, (START,) if opens else (START, SYSTEM, USER, ASSISTANT))
            return pa.RecordBatch.from_pylist([out], schema)

        for batch in batches:
            if schema is None:
                schema = _piece_schema(batch.schema.field("conv_id").type)
            for row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "n", "fault")), strict=True):
                if mine and (row[0] != mine[0] or len(held) >= size):
                    yield piece()
                    opens, number, held = row[0] != mine[0], number + 1, []
                mine = row
                held.append(row[1:])
        if mine:
            yield piece()

    return ordered.select("conv_id", "turn", "initial", "n", "fault").mapInArrow(
        cut,
        f"conv_id {kind}, part int, number long, rows long, first string, last string, "
        + "".join(f"{c} long, " for c in COUNTS)
        + f"least long, most long, distinct long, moves {MOVES}",
    )


def _piece_schema(conv_id: pa.DataType) -> pa.Schema:
    long, text = pa.int64(), pa.string()
    move = pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", long), ("audit", text), ("steps", text)])
    return pa.schema(
        [("conv_id", conv_id), ("part", pa.int32()), ("number", long), ("rows", long), ("first", text), ("last", text)]
        + [(c, long) for c in (*COUNTS, "least", "most", "distinct")]
        + [("moves", pa.list_(move))]
    )


def _piece(held: list[tuple], entries: tuple[int, ...]) -> dict:
    """Counts and moves of sorted rows (turn, initial, n, fault)."""
    rows, out = [], dict.fromkeys(COUNTS, 0) | {"rows": 0, "first": None, "last": None}
    for _, initial, n, fault in held:
        if not n:
            continue
        live = fault in ("good", "truncated")
        rows.append(Row(initial, live, fault == "truncated", n - live))
        if out["rows"]:
            out["illegal"] += out["last"] + initial not in RIGHT_PAIRS
        else:
            out["first"] = initial
        out["illegal"] += (n - 1) * (2 * initial not in RIGHT_PAIRS)
        if live:
            out["truncated"] += fault == "truncated"
            out["duplicate"] += n - 1
        else:
            out[fault] += n
        out["last"] = initial
        out["rows"] += n
    turns = [t for t, _, n, _ in held if n and t is not None]
    distinct = sum(a != b for a, b in zip(turns, [None, *turns], strict=False))
    return out | {"least": min(turns, default=None), "most": max(turns, default=None), "distinct": distinct, "moves": moves(rows, entries)}


class Conversation:
    """The pieces of one conversation in order, then the rows that may stay."""

    def __init__(self, conv_id):
        self.conv_id, self.cells = conv_id, {START: (0, Path())}
        self.counts = dict.fromkeys(COUNTS, 0)
        self.last = self.least = self.most = None
        self.distinct, self.audit, self.steps, self.at = 0, None, "", 0
        self.state, self.position = START, 0
        self.digest = hashlib.sha256()

    def add(self, piece: dict) -> None:
        self.cells = follow(self.cells, piece["moves"])
        for c in COUNTS:
            self.counts[c] += piece[c]
        if piece["rows"]:
            if self.last is not None:
                self.counts["illegal"] += self.last + piece["first"] not in RIGHT_PAIRS
            self.last = piece["last"]
        if piece["distinct"]:
            self.distinct += piece["distinct"] - (self.most == piece["least"])
            self.least = piece["least"] if self.least is None else self.least
            self.most = piece["most"]

    def settle(self) -> None:
        """Choose the repair."""
        if self.audit is None:
            self.cost, path = ended(self.cells)
            self.audit, self.steps, self.cells = "".join(path.labels()), "".join(path.labels("steps")), {}

    def _say(self, role: str, text: str, edit: str) -> dict:
        self.state = SYSTEM if self.state == START and role[:1] == "s" else NEXT[self.state]
        self.digest.update((("\n" if self.position else "") + f"{role}:{text}").encode())
        self.position += 1
        return {"conv_id": self.conv_id, "position": self.position - 1, "role": role, "text": text, "edit": edit}

    def _expected(self) -> str:
        return "assistant" if self.state == USER else "user"

    def _inserted(self) -> Iterator[dict]:
        while self.steps[self.at : self.at + 1] == "I":
            self.at += 1
            yield self._say(self._expected(), "", "insert")

    def take(self, role: str, text: str) -> Iterator[dict]:
        """The repaired turns up to the next row that may stay."""
        self.settle()
        yield from self._inserted()
        edit = self.steps[self.at]
        self.at += 1
        if edit == "K":
            yield self._say(role, text, "keep")
        elif edit == "R":
            yield self._say(self._expected(), text, "rerole")

    def close(self) -> Iterator[dict]:
        self.settle()
        yield from self._inserted()

    def summary(self) -> dict:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.distinct
        gaps = (gaps + (1 << 63)) % (1 << 64) - (1 << 63)  # a long, as in SQL without checks
        own = {"conv_id": self.conv_id, "gaps": gaps, "cost": self.cost, "audit": self.audit}
        return own | self.counts | {"repaired_sha256": self.digest.hexdigest()}


class Repair(NamedTuple):
    """``conversations``: conv_id, gaps, the counts of faults, cost, audit, repaired_sha256. ``turns``: conv_id, position,
    role, text and edit (keep, rerole, insert) of every repaired turn. Each is worked out when used."""

    conversations: DataFrame
    turns: DataFrame


def repair(turns: DataFrame, times: str | None = None, piece: int = PIECE) -> Repair:
    """Repair conversations of conv_id, turn, role, text; ``times`` names a column with how often a row stands there.

    A task searches pieces of ``piece`` rows.
    """
    ship(turns.sparkSession)
    rows = faults(turns, times)
    kind = rows.schema["at"].dataType["conv_id"].dataType.simpleString()
    found = pieces(rows, piece)
    live = rows.where("n > 0 and not blank and first").select("at.conv_id", "at.turn", "role", "key", "text")
    sent = found.select("conv_id", F.lit(0).alias("kind"), "part", "number", F.struct(*[c for c in found.columns if c not in ("conv_id", "part", "number")]).alias("piece")).unionByName(
        live.withColumn("kind", F.lit(1)), allowMissingColumns=True
    )
    ordered = sent.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "part", "number", "turn", "role", "key")
    ordered = ordered.select("conv_id", "kind", "piece", "role", "text")

    def stream(batches: Iterator[pa.RecordBatch], summaries: bool, schema: list) -> Iterator[pa.RecordBatch]:
        own: Conversation | None = None
        out: list[dict] = []
        types = None

        def closed() -> list[dict]:
            last = list(own.close())
            return [own.summary()] if summaries else last

        for batch in batches:
            types = types or pa.schema([("conv_id", batch.schema.field("conv_id").type), *schema])
            for conv_id, is_row, piece, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own is None or own.conv_id != conv_id:
                    out += closed() if own else []
                    own = Conversation(conv_id)
                if is_row:
                    said = own.take(role, text)
                    for turn in said:
                        if not summaries:
                            out.append(turn)
                else:
                    own.add(piece)
            yield pa.RecordBatch.from_pylist(out, types)
            out = []
        if own:
            yield pa.RecordBatch.from_pylist(closed(), types)

    long, string = pa.int64(), pa.string()
    summary = [("gaps", long), *[(c, long) for c in COUNTS], ("cost", long), ("audit", string), ("repaired_sha256", string)]
    said = [("position", long), ("role", string), ("text", string), ("edit", string)]

    def ddl(fields: list) -> str:
        return f"conv_id {kind}, " + ", ".join(f"{n} {'long' if t == long else 'string'}" for n, t in fields)

    return Repair(
        ordered.mapInArrow(lambda b: stream(b, True, summary), ddl(summary)),
        ordered.mapInArrow(lambda b: stream(b, False, said), ddl(said)),
    )
