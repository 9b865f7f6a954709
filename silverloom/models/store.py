"""Saving and loading models with their metrics."""

import json

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from silverloom.session import is_missing_path


def save_model(model: PipelineModel, path: str, metrics: dict, **columns: str) -> None:
    """The model below ``path/model`` and one row of metrics and column names below ``path/about``."""
    spark = SparkSession.active()
    model.write().overwrite().save(f"{path}/model")
    about = spark.range(1).select(F.lit(json.dumps({"metrics": metrics, **columns}, sort_keys=True)).alias("value"))
    about.coalesce(1).write.mode("overwrite").text(f"{path}/about")


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, dict]:
    """The model and what was saved with it; an error says which part is missing or malformed."""
    if not model_exists(spark, path):
        raise FileNotFoundError(f"no model at {path}: train the classifier first")
    about = json.loads(spark.read.text(f"{path}/about").first()["value"])
    if "metrics" not in about:
        raise ValueError(f"unexpected model format at {path}")
    return PipelineModel.load(f"{path}/model"), about


def model_exists(spark: SparkSession, path: str) -> bool:
    """Is there a complete model at ``path``? Its description is written last."""
    try:
        return not spark.read.text(f"{path}/about").isEmpty()
    except Exception as error:
        if is_missing_path(error):
            return False
        raise
