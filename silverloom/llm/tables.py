"""Reading the tables and cutting long plans."""

from pyspark.sql import DataFrame, SparkSession

from silverloom.commits import remove_path
from silverloom.llm.ship import ship
from silverloom.session import new_folder

#: Shuffle files of a finished write are of no more use; without this setting they wait for the driver's garbage collector.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settled(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: executors may be lost later, and its shuffle files go at once."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    before = spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEAN)
        else:
            spark.conf.set(_CLEAN, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.settled_at = path
    return out


def release(*tables: DataFrame) -> None:
    """Remove settled tables that no later step reads: what was made of them has been settled too."""
    for table_ in tables:
        remove_path(table_.sparkSession, table_.settled_at)
