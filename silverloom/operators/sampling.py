"""Seeded shuffle, first rows, exact samples and positions.

The shuffle key is a hash of seed and row key, so the order does not depend on how the data is partitioned, and a
prefix of the hash splits the rows into even buckets whatever the keys look like.
"""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import Window

from silverloom.constants import SEED

# Keys, not rows, that may be sorted by one task.
EDGE_KEYS = 65_536
# Values of a class column: one row each comes to the driver and goes to every task.
MOST_CLASSES = 10_000
# One level of buckets: characters of the hash; quantile ranges of a numeric order, and parts of each range.
_PREFIX = 4
_RANGES = 256
_LEVELS = 8


def shuffle_key(key: str | Sequence[str], seed: int = SEED) -> Column:
    keys = [key] if isinstance(key, str) else list(key)
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def first_rows(df: DataFrame, n: int, key: str, seed: int | None = None) -> DataFrame:
    """The first ``n`` rows by ``key`` (numeric), or of the seeded shuffle when ``seed`` is given."""
    if seed is not None:
        return _lowest_hashes(df, n, shuffle_key(key, seed))
    return _lowest(df, n, F.col(key), lambda rows, level: _range_bucket(rows, key))


def sample_exact(df: DataFrame, n: int | None, key: str | Sequence[str], seed: int = SEED) -> DataFrame:
    """Exactly ``n`` rows without replacement, or all rows when there are not more. None or <= 0 means all.

    ``key`` must identify a row.
    """
    if n is None or n <= 0:
        return df
    return _lowest_hashes(df, n, shuffle_key(key, seed))


def sample_balanced(df: DataFrame, n: int, key: str | Sequence[str], by: str, seed: int = SEED, refill: bool = True) -> DataFrame:
    """``n`` rows without replacement, split evenly between the values of ``by`` (null is one), at least one of each.

    A class that has fewer rows than its share gives all of them, and the others share what is left; without ``refill`` they
    keep to their shares, and there are fewer than ``n`` rows. Of classes with equal
    claims the first ones take the odd rows. Each class keeps the rows that come first in the seeded shuffle: one pass counts
    rows per class and bucket of the shuffle, which tells each class in which bucket it ends; only that bucket is ranked.
    There may be MOST_CLASSES classes.
    """
    columns = df.columns
    rows = df.select("*", F.col(by).alias("_class"), shuffle_key(key, seed).alias("_order"))
    rows = rows.withColumn("_bucket", F.substring("_order", 1, _PREFIX))
    counts = rows.groupBy("_class", "_bucket").agg(F.count("*").alias("n"))
    sizes = counts.groupBy("_class").agg(F.sum("n").alias("n")).limit(MOST_CLASSES + 1).collect()
    if len(sizes) > MOST_CLASSES:
        raise ValueError(f"{by} has more than {MOST_CLASSES} values: not a class")
    taken = _shares({r["_class"]: r["n"] for r in sizes}, n, refill)
    kind = next(f.dataType for f in df.schema.fields if f.name == by).simpleString()
    shares = df.sparkSession.createDataFrame(list(taken.items()), f"_of {kind}, _share long")
    running = F.sum("n").over(Window.partitionBy("_class").orderBy("_bucket"))
    steps = counts.select("_class", "_bucket", (running - F.col("n")).alias("_before"), running.alias("_upto"))
    steps = steps.join(F.broadcast(shares), F.col("_class").eqNullSafe(F.col("_of")))
    ends = steps.where("_before < _share and _upto >= _share").select(
        "_of", F.col("_bucket").alias("_end"), (F.col("_share") - F.col("_before")).alias("_rest")
    )
    placed = rows.join(F.broadcast(ends), F.col("_class").eqNullSafe(F.col("_of")))
    rank = F.row_number().over(Window.partitionBy("_class").orderBy("_order"))
    last = placed.where("_bucket = _end").withColumn("_rank", rank).where("_rank <= _rest")
    return placed.where("_bucket < _end").select(*columns).unionByName(last.select(*columns))


def _shares(sizes: dict, n: int, refill: bool = True) -> dict:
    """Rows that each class gives: the smallest classes first, so that what they lack goes to the others."""
    out, left = {}, n
    order = sorted(sizes, key=lambda c: (sizes[c], c is not None, str(c)))
    for i, c in enumerate(order):
        share = -(-left // (len(order) - i))
        out[c] = max(1, min(sizes[c], share))
        left = max(0, left - (out[c] if refill else share))
    return out


def _lowest_hashes(df: DataFrame, n: int, order: Column) -> DataFrame:
    return _lowest(df, n, order, lambda rows, level: F.substring(order, 1, _PREFIX * level))


def _lowest(df: DataFrame, n: int, order: Column, bucket_of: Callable[[DataFrame, int], Column]) -> DataFrame:
    """The ``n`` rows lowest in ``order``: all rows below the key of the row that comes after them.

    A plain top-n makes every task send its ``n`` lowest rows to one task: with many tasks that is the whole table. So
    only the key column is read to find that key: rows are counted per bucket of the order, the bucket in which the n-th
    row lies is divided again until it holds few keys, and one task sorts those. The rows themselves pass one filter.
    """
    inside, rest = F.lit(True), n
    for level in range(1, _LEVELS + 1):
        rows = df.where(inside)
        bucket = bucket_of(rows, level)
        cut = _cut(rows, bucket, rest)
        if cut is None:
            return df
        inside = inside & (bucket == cut["bucket"])
        rest -= cut["before"]
        if cut["n"] <= EDGE_KEYS:
            break
    keys = df.where(inside).select(order.alias("_key")).orderBy("_key").limit(rest + 1)
    return df.where(order < F.lit(keys.agg(F.max("_key")).first()[0]))


def _cut(rows: DataFrame, bucket: Column, n: int) -> Row | None:
    """The bucket that holds the row after the ``n`` first ones, and how many rows come before it."""
    counts = rows.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))
    running = counts.select("bucket", "n", (F.sum("n").over(Window.orderBy("bucket")) - F.col("n")).alias("before"))
    return running.where(F.col("before") + F.col("n") > n).orderBy("bucket").first()


def with_position(df: DataFrame, key: str, seed: int | None = None, out: str = "position") -> DataFrame:
    """Add the row's zero-based position in the order of ``key`` (numeric), or in the seeded shuffle.

    Rows are numbered inside buckets that follow the order; a table of bucket sizes, at most 65,536 rows, gives each
    bucket its offset. ``key`` must identify a row.
    """
    if seed is not None:
        order = shuffle_key(key, seed)
        bucket = F.substring(order, 1, _PREFIX)
    else:
        order = F.col(key)
        bucket = _range_bucket(df, key)
    rows = df.select("*", order.alias("_order"), bucket.alias("_bucket"))
    sizes = rows.groupBy("_bucket").agg(F.count("*").alias("_size"))
    before = F.sum("_size").over(Window.orderBy("_bucket")) - F.col("_size")
    offsets = sizes.select("_bucket", before.alias("_before"))
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("_order"))
    placed = rows.select("*", rank.alias("_rank")).join(F.broadcast(offsets), "_bucket")
    return placed.select(*df.columns, (F.col("_before") + F.col("_rank") - 1).alias(out))


def _range_bucket(df: DataFrame, key: str) -> Column:
    """Buckets in the order of a numeric key: quantile ranges, each divided evenly. About as even as the hash buckets."""
    steps = [i / _RANGES for i in range(1, _RANGES)]
    row = df.agg(F.min(key).alias("low"), F.max(key).alias("high"), F.percentile_approx(key, steps, F.lit(10_000)).alias("q")).first()
    if row["low"] is None:
        return F.lit(0)
    edges = [float(b) for b in sorted(set(row["q"]))]
    k = F.col(key).cast("double")
    i = F.size(F.filter(F.array(*map(F.lit, edges)), lambda b: b <= k))
    low = F.get(F.array(*map(F.lit, [float(row["low"]), *edges])), i)
    high = F.get(F.array(*map(F.lit, [*edges, float(row["high"])])), i)
    step = F.floor((k - low) / F.nullif(high - low, F.lit(0.0)) * _RANGES)
    return i * _RANGES + F.least(F.coalesce(step, F.lit(0)), F.lit(_RANGES - 1))


def tail(df: DataFrame, n: int, time: str = "created_at_ms", key: str = "request_id") -> DataFrame:
    """The ``n`` newest rows, for a preview: ``n`` is a handful."""
    return df.orderBy(F.col(time).desc(), F.col(key)).limit(n)


def latest_per_request(
    predictions: DataFrame, time: str | Sequence[str] = "created_at_ms", key: str = "request_id"
) -> DataFrame:
    """The newest row of every request; aggregated in each task before the shuffle."""
    times = [time] if isinstance(time, str) else list(time)
    order = F.col(times[0]) if len(times) == 1 else F.struct(*times)
    row = F.max_by(F.struct(*predictions.columns), order).alias("_row")
    return predictions.groupBy(key).agg(row).select("_row.*")
