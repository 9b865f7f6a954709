"""Score arithmetic."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from silverloom.constants import SCORE_THRESHOLD


def positive_probability(logit0: Column, logit1: Column) -> Column:
    """Softmax of two logits, class 1; the difference form cannot overflow to NaN."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(logit0 - logit1))


def threshold_label(score: Column) -> Column:
    """1 from the threshold on, the threshold included."""
    return (score >= SCORE_THRESHOLD).cast("bigint")


def argmax(values: Column) -> Column:
    """Index of the largest element, the first on ties."""
    return F.array_position(values, F.array_max(values)) - 1


def linear_logit(vector: Column, weights: Sequence[float], intercept: float = 0.0) -> Column:
    """Dot product with known weights, summed in double precision."""
    w = F.array(*[F.lit(float(x)) for x in weights])
    products = F.zip_with(vector, w, lambda a, b: a.cast("double") * b)
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x) + F.lit(float(intercept))


def logistic(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def float_vector(c: Column) -> Column:
    return c.cast("array<float>")
