"""Shards of even row counts that keep linked documents together: balanced label propagation.

Rows of equal link values (here: equal texts) are linked. Each linked row starts in a random shard. In every round the rows
of a group vote, and the joins of votes and rows move rows towards the shard that most of their neighbours are in, as far as
the quotas of the shards go: of the rows that want into a shard, the part that fits moves. Small groups move as a whole,
groups of more than an eighth of a shard row by row. At last each shard keeps as many of its linked rows as its quota holds,
group by group, and all other rows fill what is left, so that the counts of the shards differ by one at most.

Only counts for each shard, and for each shard and hash bucket, reach the driver or are broadcast: their number is bounded by
the parameters. Rows are numbered in hash buckets, never in one task; a group of more than ``HEAVY`` rows spreads over them.

Defined results: a null text counts as empty, and such rows are linked to each other. Null and repeated doc_ids are rows like
any other. An empty table gives no rows. With fewer rows than shards some shards stay empty. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverloom.llm.tables import settled

ROUNDS = 4
BUCKETS = 4096
HEAVY = 1_000
_PART = 1 << 20


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32 and the link value (g, h) of every row; texts are read once."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return settled(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            (F.octet_length(whole).cast("long") + 16).alias("size"),
            F.crc32(whole.cast("binary")).alias("text_crc32"),
            F.xxhash64(whole).alias("g"),
            F.xxhash64(F.lit("second"), whole).alias("h"),
        ),
        "measured",
    )


def _chance(*columns: Column | str) -> Column:
    """A number from 0 to 1 that depends on the columns alone."""
    return F.pmod(F.xxhash64(*columns), F.lit(_PART)) / F.lit(float(_PART))


def numbered(df: DataFrame, part: str, order: list[str], spread: list[Column]) -> DataFrame:
    """Add ``number``, gapless from 0 in each value of ``part``. Rows of one bucket, by the hash of ``spread``, are neighbours."""
    df = df.withColumn("bucket", F.pmod(F.xxhash64(*spread), F.lit(BUCKETS)).cast("int"))
    counts = df.groupBy(part, "bucket").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy(part).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(part, "bucket", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    place = F.row_number().over(Window.partitionBy(part, "bucket").orderBy(*order)) - 1
    return df.join(F.broadcast(offsets), [part, "bucket"]).withColumn("number", F.col("offset") + place).drop("bucket", "offset")


def _room(labels: DataFrame, quota: int, shards: int) -> list[int]:
    """Rows that still fit into each shard."""
    held = dict(labels.groupBy("shard").agg(F.count(F.lit(1))).collect())
    return [max(0, quota - held.get(s, 0)) for s in range(shards)]


def _fitting(wanted: list[tuple[int, int, int]], room: list[int]) -> list[float]:
    """For each shard the part of the rows asking for it that fits, with the room that rows leave by the same rule."""
    fits = [1.0] * len(room)
    asking = [sum(n for _, target, n in wanted if target == s) for s in range(len(room))]
    for _ in range(100):
        leaving = [0.0] * len(room)
        for shard, target, n in wanted:
            leaving[shard] += n * fits[target]
        fits = [min(f, (r + out) / a) if a else 0.0 for f, r, out, a in zip(fits, room, leaving, asking, strict=True)]
    return fits


def propagate(labels: DataFrame, quota: int, shards: int, rounds: int = ROUNDS) -> DataFrame:
    """Move linked rows (g, h, rows of the group in ``n``, shard) towards their neighbours, within the quotas."""
    for turn in range(rounds):
        votes = labels.groupBy("g", "h", "shard").agg(F.count(F.lit(1)).alias("votes"))
        strongest = F.max_by("shard", F.struct("votes", F.xxhash64("g", "shard"))).alias("target")
        targets = settled(votes.groupBy("g", "h").agg(strongest), "targets")
        asked = settled(labels.join(targets, ["g", "h"]), "asked")
        wanted = asked.where("shard <> target").groupBy("shard", "target").agg(F.count(F.lit(1))).collect()
        if not wanted:
            break
        fits = F.array(*[F.lit(x) for x in _fitting([tuple(r) for r in wanted], _room(labels, quota, shards))])
        whole = _chance("g", "h", F.lit(turn))
        single = _chance("g", "doc_id", "size", F.lit(turn))
        chance = F.when(F.col("n") * 8 > quota, single).otherwise(whole)
        moves = (F.col("shard") != F.col("target")) & (chance < F.element_at(fits, F.col("target") + 1))
        labels = asked.withColumn("shard", F.when(moves, F.col("target")).otherwise(F.col("shard"))).drop("target")
        labels = settled(labels, "labels")
    return labels


def balanced_shards(rows: DataFrame, shards: int, rounds: int = ROUNDS) -> DataFrame:
    """Add ``shard`` and ``slot`` to rows with doc_id and the link value (g, h)."""
    sizes = settled(rows.groupBy("g", "h").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "groups")
    total = rows.count()
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    joined = settled(rows.join(sizes, ["g", "h"], "left"), "rows")
    start = F.pmod(F.xxhash64("doc_id", "g", "h"), F.lit(shards)).cast("int")
    linked = settled(joined.where("n is not null").withColumn("shard", start), "start")
    linked = propagate(linked, total // shards, shards, rounds)
    spread = [F.col("g"), F.when(F.col("n") > HEAVY, F.col("doc_id"))]
    order = ["g", "h", "doc_id", "size"]
    linked = settled(numbered(linked, "shard", order, spread), "linked")
    limit = F.element_at(F.array(*[F.lit(q) for q in quota]), F.col("shard") + 1)
    held = dict(linked.groupBy("shard").agg(F.count(F.lit(1))).collect())
    kept = [min(held.get(s, 0), quota[s]) for s in range(shards)]
    stays = linked.where(F.col("number") < limit).select(*rows.columns, "shard", F.col("number").cast("long").alias("slot"))
    loose = linked.where(F.col("number") >= limit).select(*rows.columns)
    pool = loose.unionByName(joined.where("n is null").select(*rows.columns)).withColumn("all", F.lit(0))
    pool = numbered(pool, "all", ["doc_id", "g", "h"], [F.col("doc_id"), F.col("g")])
    first = [0]
    for s in range(shards):
        first.append(first[-1] + quota[s] - kept[s])
    starts = F.array(*[F.lit(x) for x in first[:-1]])
    shard = F.size(F.filter(starts, lambda x: x <= F.col("number"))) - 1
    pool = pool.withColumn("shard", shard.cast("int"))
    at = F.col("number") - F.element_at(starts, F.col("shard") + 1) + F.element_at(F.array(*map(F.lit, kept)), F.col("shard") + 1)
    return stays.unionByName(pool.select(*rows.columns, "shard", at.cast("long").alias("slot")))


def cut_links(sharded: DataFrame) -> DataFrame:
    """How many rows are linked, and how many of them are outside the shard that holds most of their group."""
    votes = sharded.groupBy("g", "h", "shard").agg(F.count(F.lit(1)).alias("votes"))
    groups = votes.groupBy("g", "h").agg(F.sum("votes").alias("n"), F.max("votes").alias("most")).where("n > 1")
    return groups.agg(F.sum("n").alias("linked"), F.sum(F.col("n") - F.col("most")).alias("cut"))
