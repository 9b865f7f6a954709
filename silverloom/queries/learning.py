"""Encoders, classifiers and the projection. SQL has no twin for these; the tests check them with numpy."""

from pyspark.sql import functions as F

from silverloom.models.classifier import encoder_of, optimality, score, score_text, train_classifier, train_text_model
from silverloom.models.encode import encode, fit_encoder, gold_from_silver, to_gold
from silverloom.models.project import export_points, project_2d
from silverloom.models.store import load_model, save_model
from silverloom.operators.metrics import accuracy
from silverloom.operators.predict import predict, to_predictions
from silverloom.plans.silver import silver_job
from silverloom.queries.data import GOLD_SQL, REVIEWS_ALL_SQL, clean_sql, gold, reviews, user_requests
from silverloom.session import new_folder, written
from silverloom.sinks.files import read_csv


def _silver(spark, sf):
    return written(silver_job(reviews(spark, sf, "left"), order="doc_id").silver, "silver")


def gold_job_rows(spark, sf):
    """Silver to gold with the default encoder: one unit-length vector of fixed size per record."""
    silver = _silver(spark, sf)
    out = gold_from_silver(silver, fit_encoder(silver, size=256))
    square = F.aggregate(F.col("embedding"), F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return out.select("text", "label", "split", F.size("embedding").cast("bigint").alias("dim"), (F.round(square, 3) <= 1.0).alias("within_unit"))


def python_encoder(spark, sf):
    """A Python encoder: length and word count of the text."""

    def load():
        import numpy as np

        return lambda texts: np.array([[len(t), len(t.split(" ")) if t else 0] for t in texts], dtype="float32")

    silver = silver_job(reviews(spark, sf, "left"), order="doc_id").silver
    out = to_gold(encode(silver, load))
    v = F.col("embedding")
    return out.select("text", "label", "split", v[0].cast("bigint").alias("n_chars"), v[1].cast("bigint").alias("n_words"))


def train_lr_accuracy(spark, sf):
    """Train on the vectors, save, load, score everything with the loaded model."""
    trained = train_classifier(gold(spark, sf), max_records=None)
    path = new_folder(spark, "model")
    save_model(trained.model, path, trained.metrics, embedding="embedding", label="label", split="split")
    model, about = load_model(spark, path)
    measured = accuracy(score(gold(spark, sf), model))
    return measured.select(
        "n_rows", "accuracy", *[F.lit(float(v)).alias(k) for k, v in sorted(about["metrics"].items())]
    )


def _certified(found, size):
    """The certificate of a fit: its rows, components, and whether the gradient vanishes there."""
    return found.select("n_rows", F.col("n_features").cast("long").alias("n_features"), (F.col("gradient") < 1e-6).alias("at_optimum"),
                        F.col("accuracy").between(0.5, 1).alias("better_than_chance"), F.lit(size).cast("long").alias("size"))


def train_lr_optimal(spark, sf):
    """The classifier of the vectors is at the optimum of its penalised loss, over all training rows."""
    rows = gold(spark, sf).where("split = 'train'")
    trained = train_classifier(rows, test_split=None, max_records=None)
    return _certified(optimality(rows, trained.model), 64)


def train_text_optimal(spark, sf):
    """So is the text model, over the vectors of its own encoder; its accuracy is the one counted anew."""
    rows = _silver(spark, sf).where("split = 'train'")
    trained = train_text_model(rows, size=256)
    vectors = written(gold_from_silver(rows, encoder_of(trained.model)), "gold")
    found = optimality(vectors, trained.model)
    return _certified(found.where(F.abs(F.col("accuracy") - trained.metrics["train_accuracy"]) < 1e-9), 256)


def train_text_accuracy(spark, sf):
    """Train on the cleaned train texts, evaluate on the test texts; the loss per pass."""
    silver = _silver(spark, sf)
    trained = train_text_model(silver.where("split = 'train'"), silver.where("split = 'test'"), size=1024)
    shown = [F.lit(float(v)).alias(k) for k, v in sorted(trained.metrics.items())]
    losses = F.array(*[F.lit(float(x)) for x in trained.history])
    counted = silver.agg(F.count("*").alias("n_rows"))
    return counted.select("n_rows", *shown, F.posexplode(losses).alias("iteration", "loss"))


def shared_encoder_scores(spark, sf):
    """The text model's own encoder feeds a vector classifier: training and scoring share one encoding."""
    silver = _silver(spark, sf)
    text_model = train_text_model(silver.where("split = 'train'"), size=256).model
    vectors = written(gold_from_silver(silver, encoder_of(text_model)), "gold")
    trained = train_classifier(vectors, max_records=None, key="id")
    return score(vectors, trained.model).groupBy("split", "label", "pred_label").agg(F.count("*").alias("n"))


def pca_2d(spark, sf):
    """Without a split column every vector is used."""
    points, _ = project_2d(gold(spark, sf).drop("split"), max_points=None)
    return points.select("id", "label", F.round("pc1", 6).alias("pc1"), F.round("pc2", 6).alias("pc2"))


def pca_sound(spark, sf):
    """All points placed: their axes are centred, uncorrelated, the first spreads most, and no axis spreads more than there is."""
    points, _ = project_2d(gold(spark, sf).drop("split"), max_points=None)
    one, two = F.var_pop("pc1"), F.var_pop("pc2")
    found = points.agg(
        F.count("*").alias("n_points"), F.avg("pc1").alias("m1"), F.avg("pc2").alias("m2"), F.corr("pc1", "pc2").alias("r"), one.alias("v1"), two.alias("v2")
    )
    sums = gold(spark, sf).select(F.posexplode("embedding").alias("i", "v")).groupBy("i").agg(F.var_pop("v").alias("v"))
    total = sums.agg(F.sum("v").alias("v")).scalar()
    return found.select(
        "n_points",
        (F.greatest(F.abs("m1"), F.abs("m2")) < 1e-6).alias("centred"),
        (F.abs("r") < 1e-6).alias("uncorrelated"),
        F.col("v1").between(F.col("v2"), total).alias("ordered"),
        F.round(total, 3).alias("total_variance"),
    )


def pca_new_points(spark, sf):
    """Fit on the training split, place the test split as new points."""
    everything = gold(spark, sf)
    points, _ = project_2d(everything.where("split = 'train'"), everything.where("split = 'test'"), max_points=None)
    return points.select("id", "split", "is_new", "pc1", "pc2")


def predict_with_model(spark, sf):
    """Requests to predictions with a trained text encoder and classifier."""
    silver = _silver(spark, sf)
    encoder = fit_encoder(silver, size=256)
    vectors = written(gold_from_silver(silver, encoder), "gold")
    model = train_classifier(vectors, max_records=None).model
    scored = predict(
        user_requests(spark, sf), lambda df: encode(df, encoder, text_col="cleaned_text"), lambda df: score(df, model), size=256
    )
    return to_predictions(scored).drop("created_at_ms")


def predict_with_text_model(spark, sf):
    """The same straight from a text model, which needs no vectors."""
    silver = _silver(spark, sf)
    model = train_text_model(silver.where("split = 'train'"), size=256).model
    scored = predict(user_requests(spark, sf), lambda df: df, lambda df: score_text(df, model))
    return to_predictions(scored, model_version="text").drop("created_at_ms")


def pca_export(spark, sf):
    """Projected points written as CSV and read back."""
    path = new_folder(spark, "points")
    points, _ = project_2d(gold(spark, sf).drop("split"), max_points=None)
    export_points(points, path)
    return read_csv(spark, path, "id string, pc1 double, pc2 double, label bigint, text string").select("id", "label", "text")


QUERIES = {
    f.__name__: f
    for f in (
        gold_job_rows,
        python_encoder,
        train_lr_accuracy,
        train_lr_optimal,
        train_text_optimal,
        train_text_accuracy,
        shared_encoder_scores,
        pca_2d,
        pca_sound,
        pca_new_points,
        predict_with_model,
        predict_with_text_model,
        pca_export,
    )
}

_SILVER = f"SELECT DISTINCT {clean_sql('text')} AS text, label, split FROM ({REVIEWS_ALL_SQL})"

ORACLE = {
    "gold_job_rows": f"SELECT text, label::BIGINT AS label, split, 256::BIGINT AS dim, true AS within_unit FROM ({_SILVER})",
    "train_lr_optimal": f"""SELECT count(*) AS n_rows, 64::BIGINT AS n_features, true AS at_optimum, true AS better_than_chance,
  64::BIGINT AS size FROM ({GOLD_SQL}) WHERE split = 'train'""",
    "train_text_optimal": f"""SELECT count(*) AS n_rows, 256::BIGINT AS n_features, true AS at_optimum, true AS better_than_chance,
  256::BIGINT AS size FROM ({_SILVER}) WHERE split = 'train'""",
    "pca_sound": """SELECT (SELECT count(*) FROM embeddings) AS n_points, true AS centred, true AS uncorrelated, true AS ordered,
  round(sum(v), 3) AS total_variance FROM (SELECT i, var_pop(x::DOUBLE) AS v FROM (
    SELECT unnest(embedding) AS x, unnest(range(len(embedding))) AS i FROM embeddings) GROUP BY i)""",
    "pca_export": f"SELECT id, label, text FROM ({GOLD_SQL})",
    "python_encoder": f"""SELECT text, label::BIGINT AS label, split, length(text)::BIGINT AS n_chars,
  CASE WHEN text = '' THEN 0 ELSE len(string_split(text, ' ')) END::BIGINT AS n_words FROM ({_SILVER})""",
}
