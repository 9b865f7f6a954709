"""The keys that a layer holds already, kept so that an increment opens only those that may be its own.

The index is a table with a commit log and one folder per bucket in each part: the bucket comes from the first bytes of the hash
of the text, so keys spread evenly whatever the texts. An increment names the buckets of its own keys and reads only their
folders; an increment of a few rows opens a few files, however long the history is. Parts are narrow and are compacted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverloom.commits import Part, publish, read_log, read_parts, remove_path, visible
from silverloom.operators.dedup import KEY, TEXT_KEY, dedup_keys
from silverloom.sinks.tables import append_commit, compact

BUCKET = "bucket"
#: Buckets of an index unless it is made with another number; a long history takes more, 65,536 at most.
BUCKETS = 64
SCHEMA = T.StructType(
    [
        T.StructField(TEXT_KEY, T.BinaryType()),
        T.StructField("_label", T.IntegerType()),
        T.StructField("_split", T.StringType()),
        T.StructField(BUCKET, T.IntegerType()),
    ]
)
#: Commits between two compactions of an index.
COMPACT_EVERY = 20


class SeenKeys:
    """The index at ``path``. It is always opened with the number of buckets it was made with."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def bucket(self) -> Column:
        """By the first two bytes of a key."""
        first = F.conv(F.hex(F.substring(TEXT_KEY, 1, 2)), 16, 10).cast("int")
        return F.pmod(first, F.lit(self.buckets)).alias(BUCKET)

    def _parts(self, but: str | None = None) -> list[Part]:
        return [p for p in visible(read_log(self.spark, self.path) or []) if p.writer != but]

    def count(self, but: str | None = None) -> int:
        """Keys in the index, as its log tells them."""
        return sum(p.n_rows for p in self._parts(but))

    def keys(self, buckets: list[int] | None = None, but: str | None = None) -> DataFrame:
        """The keys in some buckets, all for None; without those that writer ``but`` has added."""
        parts = self._parts(but)
        if not parts:
            return self.spark.createDataFrame([], SCHEMA).select(*KEY)
        rows = read_parts(self.spark, self.path, parts, self.spark.read.schema(SCHEMA))
        return (rows if buckets is None else rows.where(F.col(BUCKET).isin(buckets))).select(*KEY)

    def near(self, keyed: DataFrame, but: str | None = None) -> DataFrame:
        """The keys of the index that may be among those of ``keyed``, a table of rows with their keys."""
        if not self._parts(but):
            return self.keys([], but)
        found = keyed.select(self.bucket()).distinct().collect()  # as many as there are buckets at most
        return self.keys(sorted(r[BUCKET] for r in found), but)

    def add(self, keyed: DataFrame, commit_id: int | None = None, writer: str | None = None) -> None:
        """Add the keys of some rows; adding again under one commit and writer replaces."""
        rows = dedup_keys(keyed).select(*KEY, self.bucket())
        append_commit(rows, self.path, SCHEMA, commit_id, writer=writer, partition_by=[BUCKET])
        parts = self._parts()
        if len(parts) > COMPACT_EVERY:
            last = max(p.commit_id for p in parts)
            compact(self.spark, self.path, small_rows=50_000_000, before=last, partition_by=[BUCKET])

    def cover(self, layer: DataFrame | None, but: str | None = None) -> None:
        """Build the index anew from the layer if it holds fewer keys than the layer has rows.

        That is the case for a layer older than its index, and after a run that died between the two. Rows are counted by
        the footers of the files.
        """
        if layer is None or self.count(but) >= layer.count():
            return
        rows = dedup_keys(layer).select(*KEY, self.bucket())
        old = [p.part for p in self._parts(but)]
        append_commit(rows, self.path, SCHEMA, partition_by=[BUCKET])
        publish(self.spark, self.path, lambda _: ("append", [], old))
        for part in old:
            remove_path(self.spark, f"{self.path}/{part}")
