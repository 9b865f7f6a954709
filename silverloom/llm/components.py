"""Connected components by alternating stars, as Spark joins."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverloom.llm.tables import settled


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component``, the smallest node that its links reach, for every node that has a link to another.

    Large star: each node ties its larger neighbours to the smallest node it knows. Small star: each node ties its smaller
    neighbours and itself to the smallest of them. Both keep the components and the number of links does not grow; when
    nothing changes each node is tied to the smallest of its component. The number of rounds grows with the logarithm of
    the longest path. Minima are aggregated before they are shuffled and are tables of their own in the joins, so that the
    many links of one node can be split among tasks. Nulls and links of a node to itself are ignored.
    """
    pairs = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct()
    pairs = settled(pairs, "links")
    state = _state(pairs)
    while state[0]:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = settled(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = settled(large, "large_star")
        least = settled(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        joined = large.join(least, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(
            least.select("a", F.col("m").alias("b"))
        )
        pairs = settled(small.distinct(), "small_star")
        before, state = state, _state(pairs)
        if before == state:
            break
    nodes = pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _state(pairs: DataFrame):
    row = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]
