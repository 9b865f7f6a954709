"""Which layers hold a request?"""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def request_trace(requests: DataFrame, layers: dict[str, DataFrame], key: str = "request_id") -> DataFrame:
    """One row per request with a boolean ``in_<layer>`` column per layer.

    All inputs meet in one aggregation on the request id, reduced in each task first, so a request with very many rows
    in a layer costs no more than one row per task. Each layer is first reduced to
    the requests by a semi join, for which Spark picks a broadcast or a shuffle by the sizes it knows.
    """
    wanted = requests.select(key).where(F.col(key).isNotNull()).distinct()

    def marked(ids: DataFrame, mark: str) -> DataFrame:
        flags = [F.lit(name == mark).alias(f"in_{name}") for name in layers]
        return ids.select(key, F.lit(mark == "").alias("_wanted"), *flags)

    inputs = [marked(wanted, "")]
    for name, layer in layers.items():
        inputs.append(marked(layer.select(key).join(wanted, key, "left_semi"), name))
    stacked = reduce(DataFrame.unionByName, inputs)
    found = [F.bool_or(f"in_{name}").alias(f"in_{name}") for name in layers]
    return stacked.groupBy(key).agg(F.bool_or("_wanted").alias("_wanted"), *found).where("_wanted").drop("_wanted")
