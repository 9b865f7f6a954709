"""Logistic regression on vectors, and on texts."""

from collections.abc import Callable
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from silverloom.constants import MAX_ITERATIONS, SEED
from silverloom.functions.scores import threshold_label
from silverloom.models.encode import VECTOR, text_stages
from silverloom.models.store import load_model, model_exists
from silverloom.operators.metrics import accuracy, require_two_classes
from silverloom.operators.sampling import sample_exact
from silverloom.operators.splits import split_filter, split_filter_or_all

FEATURES = "_features"
LABEL = "_label"


class Trained(NamedTuple):
    model: PipelineModel
    metrics: dict
    history: list[float]


def _regression(features: str, n_rows: int) -> LogisticRegression:
    # The penalty 1/2 |w|^2 against the summed loss; Spark minimises the mean loss, hence 1/n.
    return LogisticRegression(
        featuresCol=features,
        labelCol=LABEL,
        regParam=1.0 / n_rows,
        elasticNetParam=0.0,
        standardization=False,
        maxIter=MAX_ITERATIONS,
        tol=1e-8,
    )


def positive_score() -> Column:
    """Probability of class 1 in a transformed frame."""
    return vector_to_array(F.col("probability")).getItem(1)


def score(df: DataFrame, model, embedding: str = "embedding") -> DataFrame:
    """Add ``pred_label`` and ``pred_score``.

    A model with probabilities gives the probability of class 1 and compares it with the threshold; a model with hard
    labels only gives its label as the score.
    """
    vectors = df.withColumn(FEATURES, array_to_vector(F.col(embedding)))
    out = model.transform(vectors)
    if "probability" in out.columns:
        scored = out.withColumn("pred_score", positive_score()).withColumn("pred_label", threshold_label(F.col("pred_score")))
    else:
        scored = out.withColumn("pred_label", F.col("prediction").cast("bigint")).withColumn(
            "pred_score", F.col("prediction").cast("double")
        )
    return scored.select(*df.columns, "pred_label", "pred_score")


def _measure(df: DataFrame, model, embedding: str, label: str) -> float | None:
    return accuracy(score(df.select(embedding, label), model, embedding), "pred_label", label).first()["accuracy"]


def train_classifier(
    train: DataFrame,
    test: DataFrame | None = None,
    train_split: str | None = "train",
    test_split: str | None = "test",
    embedding: str = "embedding",
    label: str = "label",
    split: str = "split",
    key: str = "id",
    max_records: int | None = None,
    seed: int = SEED,
) -> Trained:
    """Fit on the training split and measure accuracy on it and on the test split.

    Without ``test`` the test rows come from ``train`` by split, and an empty split gives no test accuracy; a separate
    ``test`` table falls back to all of its rows. ``test_split=None`` skips the evaluation. Only the vector, the label
    and the sampling key are read. The fit takes all training rows, or an exact seeded sample of ``max_records`` of them where
    that is given; the test accuracy is that of every test row.
    """
    rows = sample_exact(split_filter_or_all(train, train_split, split), max_records, key, seed)
    rows = rows.select(embedding, F.col(label).cast("double").alias(LABEL)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = require_two_classes(rows, LABEL)
        vectors = rows.withColumn(FEATURES, array_to_vector(F.col(embedding)))
        fitted = _regression(FEATURES, n).fit(vectors.select(FEATURES, LABEL))
        model = PipelineModel([fitted])
        metrics = {"train_accuracy": _measure(rows, model, embedding, LABEL)}
        history = list(fitted.summary.objectiveHistory)
    finally:
        rows.unpersist()
    if test_split is not None:
        if test is None:
            held_out = split_filter(train, test_split, split)
        else:
            held_out = split_filter_or_all(test, test_split, split)
        measured = _measure(held_out, model, embedding, label)
        if measured is not None:
            metrics["test_accuracy"] = measured
    return Trained(model, metrics, history)


def optimality(df: DataFrame, model: PipelineModel, embedding: str = "embedding", label: str = "label") -> DataFrame:
    """How near a fitted regression is to the optimum on its own training rows, as one row that every engine can recompute.

    The penalised loss is convex, so its gradient vanishes at the optimum and nowhere else: ``gradient`` is the largest of
    its components for the mean loss, ``n_rows`` and ``n_features`` say over what, ``loss`` is the penalised mean loss and
    ``accuracy`` is counted anew from the weights. One aggregation over (row, component), summed in each task first.
    """
    fitted = model.stages[-1]
    weights, intercept = fitted.coefficients.toArray(), float(fitted.intercept)
    spark = df.sparkSession
    w = spark.createDataFrame([(i, float(x)) for i, x in enumerate(weights)], "i int, w double")
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(embedding).alias("x"), F.col(label).cast("double").alias("y"))
    linear = F.lit(intercept) + F.aggregate(
        F.zip_with("x", F.array(*[F.lit(float(x)) for x in weights]), lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, t: s + t
    )
    scored = rows.withColumn("z", linear).withColumn("p", 1 / (1 + F.exp(-F.col("z")))).withColumn("d", F.col("p") - F.col("y"))
    loss = F.greatest("z", F.lit(0.0)) - F.col("z") * F.col("y") + F.log1p(F.exp(-F.abs("z")))
    right = (F.col("p") >= 0.5).cast("double") == F.col("y")
    whole = scored.agg(
        F.count("*").alias("n_rows"), F.sum("d").alias("g0"), F.sum(loss).alias("sum_loss"), F.avg(right.cast("double")).alias("accuracy")
    )
    parts = scored.select("d", F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.sum(F.col("d") * F.col("v")).alias("g"))
    slopes = parts.join(w, "i").select(F.abs(F.col("g") + F.col("w")).alias("g"))  # the penalty is 1/2 |w|^2 to the summed loss
    most = slopes.agg(F.max("g").alias("g"), F.count("*").alias("n_features"))
    penalty = float(weights @ weights) / 2
    n = F.col("n_rows")
    return whole.select(
        "n_rows",
        most.select("n_features").scalar().alias("n_features"),
        (F.greatest(F.abs("g0"), most.select("g").scalar()) / n).alias("gradient"),
        ((F.col("sum_loss") + penalty) / n).alias("loss"),
        "accuracy",
    )


def train_text_model(
    train: DataFrame,
    test: DataFrame | None = None,
    size: int = 1 << 12,
    max_tokens: int | None = None,
) -> Trained:
    """One supervised model from cleaned text to label, evaluated on ``test`` when it has rows.

    The text stages of the result are also an encoder, so training and scoring share one encoding.
    """
    rows = train.select("text", F.col("label").cast("double").alias(LABEL))
    vectors = None
    try:
        n = require_two_classes(rows, LABEL)
        to_vectors = Pipeline(stages=text_stages(size, max_tokens)).fit(rows)
        vectors = to_vectors.transform(rows).select(VECTOR, LABEL).persist(StorageLevel.MEMORY_AND_DISK)
        fitted = _regression(VECTOR, n).fit(vectors)
        history = list(fitted.summary.objectiveHistory)
        model = PipelineModel([*to_vectors.stages, fitted])
        scored = fitted.transform(vectors).select(threshold_label(positive_score()).alias("pred_label"), LABEL)
        metrics = {"train_accuracy": accuracy(scored, "pred_label", LABEL).first()["accuracy"]}
    finally:
        if vectors is not None:
            vectors.unpersist()
    if test is not None:
        held_out = test.select("text", F.col("label").cast("double").alias(LABEL))
        measured = _text_accuracy(held_out, model)
        if measured is not None:
            metrics["test_accuracy"] = measured
    return Trained(model, metrics, history)


def _text_accuracy(df: DataFrame, model: PipelineModel) -> float | None:
    out = model.transform(df).select(threshold_label(positive_score()).alias("pred_label"), LABEL)
    return accuracy(out, "pred_label", LABEL).first()["accuracy"]


def score_text(df: DataFrame, model: PipelineModel, text_col: str = "cleaned_text") -> DataFrame:
    """Add ``pred_label`` and ``pred_score`` straight from a text model."""
    packed = df.select(F.struct(*[F.col(c) for c in df.columns]).alias("_row"), F.col(text_col).alias("text"))
    scored = model.transform(packed).select("_row.*", positive_score().alias("pred_score"))
    return scored.select(*df.columns, threshold_label(F.col("pred_score")).alias("pred_label"), "pred_score")


def encoder_of(model: PipelineModel) -> PipelineModel:
    """The text stages of a text model, for use as an encoder."""
    last = next(i for i, stage in enumerate(model.stages) if stage.hasParam("outputCol") and stage.getOutputCol() == VECTOR)
    return PipelineModel(model.stages[: last + 1])


def choose_encoder(spark: SparkSession, text_model_path: str | None, default: Callable[[], Transformer]) -> Transformer:
    """The encoder of the text model saved at a path, when there is one, else the default: the same for training and scoring."""
    if text_model_path is not None and model_exists(spark, text_model_path):
        return encoder_of(load_model(spark, text_model_path)[0])
    return default()
