"""Damaged conversations and their cheapest repair."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverloom.llm.conversation_repair import repair
from silverloom.llm.tables import table


def _known(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and times: a twentieth of the rows each is dropped, emptied, cut off, doubled, given to the user."""
    h = F.crc32(F.concat(_known("conv_id"), F.lit(":"), _known("turn")).cast("binary")) % 20
    text = F.when(h == 1, "").when(h == 2, F.regexp_replace(_known("text"), "[.!?]", "")).otherwise(_known("text"))
    role = F.when(h == 4, "user").otherwise(_known("role"))
    times = F.when(h == 0, 0).when(h == 3, 2).otherwise(1)
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("times"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(table(spark, sf_dir, "conversations")), "times").conversations


QUERIES = {"op11_conversation_repair": op11_conversation_repair}
ORACLE: dict[str, str] = {}
