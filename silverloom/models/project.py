"""Projection of vectors to two dimensions."""

from typing import NamedTuple

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from silverloom.constants import SEED
from silverloom.functions.text import preview
from silverloom.operators.sampling import sample_exact
from silverloom.operators.splits import split_filter_or_all
from silverloom.sinks.files import write_csv


class Projection(NamedTuple):
    model: PipelineModel
    signs: tuple[float, float]
    explained: tuple[float, float]


def fit_projection(vectors: DataFrame, embedding: str = "embedding") -> Projection:
    """Two principal components of the centred vectors; each axis points along its largest loading."""
    rows = vectors.select(array_to_vector(F.col(embedding)).alias("_raw")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if rows.isEmpty():
            raise ValueError("no embeddings to project")
        stages = [
            StandardScaler(inputCol="_raw", outputCol="_centred", withMean=True, withStd=False),
            PCA(k=2, inputCol="_centred", outputCol="_pc"),
        ]
        model = Pipeline(stages=stages).fit(rows)
    finally:
        rows.unpersist()
    axes = model.stages[1].pc.toArray()
    largest = axes[np.abs(axes).argmax(axis=0), [0, 1]]
    signs = tuple(float(s) for s in np.where(largest < 0, -1.0, 1.0))
    return Projection(model, signs, tuple(float(v) for v in model.stages[1].explainedVariance.toArray()))


def apply_projection(df: DataFrame, projection: Projection, embedding: str = "embedding") -> DataFrame:
    """Add ``pc1`` and ``pc2``."""
    out = projection.model.transform(df.withColumn("_raw", array_to_vector(F.col(embedding))))
    pc = vector_to_array(F.col("_pc"))
    pc1, pc2 = ((pc.getItem(i) * s).alias(f"pc{i + 1}") for i, s in enumerate(projection.signs))
    return out.select(*df.columns, pc1, pc2)


def project_2d(
    gold: DataFrame,
    new_points: DataFrame | None = None,
    max_points: int | None = None,
    seed: int = SEED,
    key: str = "id",
) -> tuple[DataFrame, Projection]:
    """Fit on the training split (or on everything) and place all of its points and the new ones.

    With ``max_points`` the axes are fitted on an exact seeded sample of so many points; every point is still placed.
    """
    known = split_filter_or_all(gold, "train")
    projection = fit_projection(sample_exact(known, max_points, key, seed))
    points = known.withColumn("is_new", F.lit(False))
    if new_points is not None:
        points = points.unionByName(new_points.withColumn("is_new", F.lit(True)), allowMissingColumns=True)
    return apply_projection(points, projection), projection


def export_points(points: DataFrame, path: str) -> None:
    """Projected points as CSV for BI tools, with the start of the text."""
    write_csv(points.select("id", "pc1", "pc2", "label", preview(F.col("text"), 100).alias("text")), path)
