"""Append commits, compaction and retention."""

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverloom.commits import (
    COMMIT,
    WRITER,
    Entry,
    Part,
    adopted,
    create_once,
    file_system,
    fold,
    publish,
    read_log,
    read_parts,
    remove_path,
    visible,
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``: unknown columns go, missing ones become null, types are cast."""
    return df.select(*_conformed(df, schema))


def _conformed(df: DataFrame, schema: T.StructType) -> list[Column]:
    return [
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ]


def now_stamp() -> int:
    return int(time.time() * 1000)


def append_commit(
    df: DataFrame,
    target: str,
    schema: T.StructType,
    commit_id: int | None = None,
    evolve: bool = False,
    max_rows_per_file: int = 0,
    writer: str | None = None,
    keys: Sequence[str] = (),
    partition_by: Sequence[str] = (),
) -> int:
    """Add the rows of ``df`` to the Parquet table at path ``target`` as one commit; returns the commit id.

    The table is made when missing. Columns the table does not know are left out, or added with ``evolve``. The rows are
    seen when the commit log names them, all at once; what a killed write left behind is never read. A fresh commit (no
    ``commit_id``) comes after all commits that were finished before it, whatever other writers do meanwhile. Writing a
    ``commit_id`` again replaces what the same ``writer`` wrote there, and nothing else; once it has been compacted it is
    complete, and writing it again changes nothing.

    ``keys`` are columns that rows are looked up by: files get a Bloom filter for each, and a lookup opens few of them.
    ``partition_by`` divides each part into folders, which reads prune.
    """
    spark, target = df.sparkSession, target.rstrip("/")
    fresh = commit_id is None
    own = writer or (uuid.uuid4().hex if fresh else "caller")
    extra = [c for c in df.columns if c not in schema.fieldNames()] if evolve else []
    rows = df.select(*_conformed(df, schema), *extra)
    commit = now_stamp() if fresh else commit_id
    folder = f"{WRITER}={own}-{uuid.uuid4().hex[:12]}"
    before = adopted(spark, target) if read_log(spark, target) is None else []
    n_rows = _write(rows, f"{target}/{COMMIT}={commit}/{folder}", max_rows_per_file, keys, partition_by)
    placed, void = [commit], [False]

    def entry(entries: list[Entry]) -> tuple[str, list[Part], list[str]]:
        live = visible(entries)
        known = [] if entries else before
        last = max((p.commit_id for p in live + known), default=0)
        if fresh and last >= placed[0]:  # another commit was finished in between
            _move(spark, target, f"{COMMIT}={placed[0]}/{folder}", f"{COMMIT}={last + 1}/{folder}")
            placed[0] = last + 1
        merged = {name for e in entries if e.kind == "compact" for name in e.removed}
        void[0] = any(p.part in merged and (p.commit_id, p.writer) == (placed[0], own) for e in entries for p in e.added)
        if void[0]:
            return "append", [], []
        again = [p.part for p in live if p.commit_id == placed[0] and p.writer == own]
        return "append", [*known, Part(f"{COMMIT}={placed[0]}/{folder}", placed[0], own, n_rows)], again

    publish(spark, target, entry)
    if void[0]:
        remove_path(spark, f"{target}/{COMMIT}={commit}/{folder}")
    return placed[0]


def _write(
    rows: DataFrame, path: str, max_rows_per_file: int = 0, keys: Sequence[str] = (), partition_by: Sequence[str] = ()
) -> int:
    """Write a part; returns its rows, as the footers of its files tell them.

    (An observation would count on the way, but a session that has one cannot serialise fitted models any more.)
    """
    out = rows.write.option("compression", "snappy")
    for key in keys:
        out = out.option(f"parquet.bloom.filter.enabled#{key}", "true")
        out = out.option("parquet.bloom.filter.adaptive.enabled", "true")
    if max_rows_per_file:
        out = out.option("maxRecordsPerFile", max_rows_per_file)
    if partition_by:  # one file for each folder
        out = rows.repartition(*partition_by).write.option("compression", "snappy").partitionBy(*partition_by)
    out.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path).count()


def _move(spark: SparkSession, target: str, old: str, new: str) -> None:
    fs, source = file_system(spark, f"{target}/{old}")
    _, goal = file_system(spark, f"{target}/{new}")
    fs.mkdirs(goal.getParent())
    if not fs.rename(source, goal):
        raise OSError(f"{target}/{old} could not be renamed")


def compact(
    spark: SparkSession,
    target: str,
    small_rows: int = 1_000_000,
    at_least: int = 8,
    before: int | None = None,
    keys: Sequence[str] = (),
    partition_by: Sequence[str] = (),
) -> int:
    """Put parts of fewer than ``small_rows`` rows into one, when there are ``at_least`` so many; returns how many.

    With ``before`` only commits earlier than that one take part.

    Reads see either the old parts or the new one. The old ones stay for reads of earlier commits until ``expire``. A part
    that changes meanwhile (a commit that is written again) makes the compaction void.
    """
    target = target.rstrip("/")
    small = [p for p in visible(read_log(spark, target) or []) if 0 <= p.n_rows < small_rows and (before is None or p.commit_id < before)]
    if len(small) < at_least:
        return 0
    rows = read_parts(spark, target, small, spark.read.option("mergeSchema", "true")).drop(COMMIT)
    own = f"compacted-{uuid.uuid4().hex[:12]}"
    last = max(p.commit_id for p in small)
    part = f"{COMMIT}={last}/{WRITER}={own}"
    total = sum(p.n_rows for p in small)
    files = max(1, -(-total // small_rows))
    spread = rows if partition_by else rows.repartition(files)
    if keys:
        spread = rows.repartitionByRange(files, *keys).sortWithinPartitions(*keys)
    n_rows = _write(spread, f"{target}/{part}", 0, keys, partition_by)
    replaced = [p.part for p in small]
    done = []

    def entry(entries: list[Entry]) -> tuple[str, list[Part], list[str]]:
        whole = {p.part for p in visible(entries)}.issuperset(replaced)
        done[:] = [whole]
        return ("compact", [Part(part, last, own, n_rows)], replaced) if whole else ("compact", [], [])

    publish(spark, target, entry)
    if not done[0]:
        remove_path(spark, f"{target}/{part}")
    return len(small) if done[0] else 0


def expire(spark: SparkSession, target: str, before: int, orphans_before_ms: int | None = None) -> list[str]:
    """Remove the parts that no read as of commit ``before`` or later needs, and fold the log up to there; returns them.

    With ``orphans_before_ms`` (epoch milliseconds) parts that no entry names and that were last changed before then go
    too: what killed writes left. It must lie before the start of any write that still runs.
    """
    target = target.rstrip("/")
    entries = read_log(spark, target) or []
    needed = {p.part for p in visible(entries)} | {p.part for e in entries if e.commit_id > before for p in e.added}
    needed |= {name for e in entries if e.commit_id > before for name in e.removed} | {p.part for p in visible(entries, before)}
    gone = [n for e in entries for n in e.removed if n not in needed]
    if orphans_before_ms is not None:
        named = {p.part for e in entries for p in e.added}
        fs, at = file_system(spark, f"{target}/{COMMIT}=*/{WRITER}=*")
        for s in fs.globStatus(at) or []:
            name = f"{s.getPath().getParent().getName()}/{s.getPath().getName()}"
            if name not in named and s.getModificationTime() < orphans_before_ms:
                gone.append(name)
    fold(spark, target, before)
    for name in gone:
        remove_path(spark, f"{target}/{name}")
    return gone


def append_table(df: DataFrame, name: str, schema: T.StructType, commit_id: int | None = None) -> int:
    """The same for a catalog table, made when missing. A fresh commit comes after all that the table has.

    Its id is claimed first by a file that only one writer can create, so no two fresh commits share a partition.
    """
    rows = conform(df, schema)
    spark = df.sparkSession
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {COMMIT} BIGINT) USING parquet PARTITIONED BY ({COMMIT})")
    commit = _claim(spark, name) if commit_id is None else commit_id
    spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({COMMIT} = {int(commit)}) SELECT * FROM {{rows}}", rows=rows)
    return commit


def _claim(spark: SparkSession, name: str) -> int:
    """A commit id that is greater than those of the table and that nobody else gets."""
    where = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").first()["data_type"]
    commit = max(now_stamp(), (spark.table(name).agg(F.max(COMMIT)).first()[0] or 0) + 1)
    while not create_once(spark, f"{where}/_claims/{commit}", ""):
        commit += 1
    return commit
