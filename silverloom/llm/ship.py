"""The package on the executors, whatever their search path is."""

import io
import os
import tempfile
import zipfile

from pyspark import SparkFiles
from pyspark.sql import SparkSession

import silverloom

BATCH = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand the package's sources (some hundred kB) to the executors, once for each application.

    Arrow batches of whole texts are kept to BATCH rows: a batch is held several times over by a task and its worker.
    """
    if not 0 < int(spark.conf.get(_BATCH)) <= BATCH:
        spark.conf.set(_BATCH, str(BATCH))
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(silverloom.__file__))
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as packed:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    packed.write(path, os.path.relpath(path, os.path.dirname(root)))
    own = tempfile.mkdtemp(dir=SparkFiles.getRootDirectory())  # Spark's file server hands it out and removes it at the end
    path = os.path.join(own, "silverloom_sources.zip")
    with open(path, "wb") as file:
        file.write(data.getvalue())
    context.addPyFile(path)
    _shipped.add(context.applicationId)
