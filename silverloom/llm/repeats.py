"""Shared seeds and their contexts as Spark tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverloom.llm.tables import settled


def shared_seeds(found: DataFrame) -> DataFrame:
    """The rows (seed, context, key) whose seed occurs more than once.

    The counts are aggregated before they are shuffled and are a table of their own when they meet the rows, so a seed that
    a large part of the rows has can be split among tasks.
    """
    twice = settled(found.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("seed"), "seeds")
    return settled(found.join(twice, "seed"), "shared_seeds")


def contexts(shared: DataFrame) -> DataFrame:
    """One row for each context: its smallest key, how often it occurs, and whether its seed has other contexts."""
    groups = shared.groupBy("seed", "context").agg(F.min("key").alias("owner"), F.count(F.lit(1)).alias("n"))
    groups = settled(groups, "contexts")
    several = groups.groupBy("seed").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("seed", F.lit(True).alias("open"))
    return settled(groups.join(several, "seed", "left").fillna(False, ["open"]), "contexts_open")
