"""Session settings and the shared working folder."""

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_own_folder: tempfile.TemporaryDirectory | None = None


def build_session(app_name: str = "silverloom", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators assume; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where the setting is missing a local session gets a temporary folder of its own; on a cluster that would be
    lost with the machine, so there the setting is required.
    """
    global _own_folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder")
    if _own_folder is None or not os.path.isdir(_own_folder.name):
        _own_folder = tempfile.TemporaryDirectory(prefix="silverloom-")
    return _own_folder.name


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other call returns."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df, name: str):
    """Write ``df`` to the shared folder and read it back: later steps survive the loss of executors."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_missing_path(error: Exception) -> bool:
    """Did a read fail because nothing has been written there yet?"""
    return "PATH_NOT_FOUND" in str(error)
