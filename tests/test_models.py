"""Encoders, classifiers and the projection against numpy."""

import numpy as np
import pytest
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from silverloom.models.classifier import choose_encoder, encoder_of, score, score_text, train_classifier, train_text_model
from silverloom.models.encode import encode, fit_encoder, gold_from_silver, to_gold, tokens
from silverloom.models.project import export_points, fit_projection, project_2d
from silverloom.models.store import load_model, model_exists, save_model
from silverloom.schemas import GOLD, REVIEW
from silverloom.sinks.files import read_csv

GOLD_ROWS = "id string, embedding array<float>, label long, split string"


def vectors(spark, n=200, d=5, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)).astype(np.float32) * np.arange(1, d + 1, dtype=np.float32)
    y = (x @ np.linspace(-1, 1, d) + rng.normal(size=n) > 0).astype(int)
    rows = [(str(i), [float(v) for v in x[i]], int(y[i]), "train" if i % 4 else "test") for i in range(n)]
    return spark.createDataFrame(rows, GOLD_ROWS), x.astype(float), y


def silver(spark, n=40):
    words = ("good fine great", "bad poor awful")
    rows = [(str(i), f"{words[i % 2]} film {i % 5}", 1 - i % 2, "train" if i % 4 < 2 else "test", None) for i in range(n)]
    return spark.createDataFrame(rows, REVIEW)


def test_regression_reaches_the_penalised_optimum(spark):
    gold, x, y = vectors(spark)
    trained = train_classifier(gold.drop("split"), test_split=None, max_records=None)
    fitted = trained.model.stages[0]
    w, b = fitted.coefficients.toArray(), fitted.intercept
    p = 1 / (1 + np.exp(-(x @ w + b)))
    assert np.abs(x.T @ (p - y) + w).max() < 1e-3 and abs((p - y).sum()) < 1e-3
    assert trained.metrics == {"train_accuracy": pytest.approx(((p >= 0.5) == y).mean())}
    assert len(trained.history) > 2 and trained.history[-1] < trained.history[0]


def test_split_sampling_and_evaluation(spark):
    gold, _, _ = vectors(spark)
    own = train_classifier(gold)
    assert set(own.metrics) == {"train_accuracy", "test_accuracy"}
    other = train_classifier(gold, gold.where("split = 'test'"), max_records=50)
    assert set(other.metrics) == {"train_accuracy", "test_accuracy"}
    assert set(train_classifier(gold, test_split="absent").metrics) == {"train_accuracy"}
    assert set(train_classifier(gold, gold, test_split="absent").metrics) == {"train_accuracy", "test_accuracy"}
    assert set(train_classifier(gold, train_split="absent", test_split=None).metrics) == {"train_accuracy"}
    with pytest.raises(ValueError, match="nothing to tell apart"):
        train_classifier(gold.where("label = 1"))
    with pytest.raises(ValueError, match="no training rows"):
        train_classifier(gold.where("false"))


def test_evaluation_takes_all_rows(spark):
    """One wrong row far behind the size of the training sample counts."""
    rows = [(str(i), [1.0 - 2 * (i % 2), 0.0], 1 - i % 2, "train" if i < 40 else "test") for i in range(160)]
    rows[-1] = (rows[-1][0], rows[-1][1], 1, "test")
    found = train_classifier(spark.createDataFrame(rows, GOLD_ROWS), max_records=20)
    assert found.metrics["test_accuracy"] == pytest.approx(119 / 120)


def test_the_fit_takes_all_rows(spark):
    """The regression is at the optimum over all rows, and so is no fit on some of them."""
    gold, x, y = vectors(spark, n=6000)
    fitted = train_classifier(gold.drop("split"), test_split=None).model.stages[0]
    w, b = fitted.coefficients.toArray(), fitted.intercept
    p = 1 / (1 + np.exp(-(x @ w + b)))
    assert np.abs(x.T @ (p - y) + w).max() < 1e-1 and abs((p - y).sum()) < 1e-1


def test_wide_rows(spark):
    rows = [(f"w{i}", [0.5 * i - 1.2, *[0.3] * 699], int(i > 2), "train") for i in range(6)]
    assert train_classifier(spark.createDataFrame(rows, GOLD_ROWS), test_split=None).metrics == {"train_accuracy": 1.0}


def test_save_and_load(spark, tmp_path):
    gold, _, _ = vectors(spark)
    trained = train_classifier(gold)
    path = str(tmp_path / "model")
    assert not model_exists(spark, path)
    with pytest.raises(FileNotFoundError, match="train the classifier first"):
        load_model(spark, path)
    save_model(trained.model, path, trained.metrics, embedding="embedding")
    model, about = load_model(spark, path)
    assert about == {"metrics": trained.metrics, "embedding": "embedding"}
    assert sorted(score(gold, model).collect()) == sorted(score(gold, trained.model).collect())
    spark.range(1).select(F.lit("{}").alias("value")).write.mode("overwrite").text(f"{path}/about")
    with pytest.raises(ValueError, match="unexpected model format"):
        load_model(spark, path)


def test_threshold_includes_one_half_and_hard_labels(spark):
    gold, _, _ = vectors(spark)
    model = train_classifier(gold, test_split=None).model
    out = score(gold, model)
    assert out.where((F.col("pred_score") >= 0.5) != (F.col("pred_label") == 1)).isEmpty()
    assert out.columns == [*gold.columns, "pred_label", "pred_score"]
    svm = LinearSVC(featuresCol="v", labelCol="label", maxIter=5).fit(gold.withColumn("v", array_to_vector("embedding")))
    svm.setFeaturesCol("_features")
    assert score(gold, svm).where("pred_score <> pred_label").isEmpty()


def test_projection_matches_svd(spark):
    gold, x, _ = vectors(spark)
    points, projection = project_2d(gold.drop("split"), max_points=None)
    rows = sorted(points.collect(), key=lambda r: int(r["id"]))
    centred = x - x.mean(axis=0)
    u, s, vt = np.linalg.svd(centred, full_matrices=False)
    axes = vt[:2].T
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), [0, 1]])
    assert np.allclose([[r["pc1"], r["pc2"]] for r in rows], centred @ axes, atol=1e-4)
    assert np.allclose(projection.explained, s[:2] ** 2 / (s**2).sum())


def test_projection_sample_and_new_points(spark):
    gold, _, _ = vectors(spark)
    new = gold.where("split = 'test'")
    points, _ = project_2d(gold, new.select("id", "embedding"), max_points=30)
    known = gold.where("split = 'train'").count()
    assert points.where("not is_new").count() == known and points.where("is_new").count() == new.count()
    assert points.where("not is_new and split <> 'train'").isEmpty()
    with pytest.raises(ValueError, match="no embeddings"):
        fit_projection(gold.where("false"))


def test_tokens(spark):
    df = spark.createDataFrame([("a b  c",), ("",), (" ".join(["w"] * 600),)], "text string")
    assert [len(r[0]) for r in df.select(tokens(F.col("text"))).collect()] == [3, 0, 600]
    assert [len(r[0]) for r in df.select(tokens(F.col("text"), 512)).collect()] == [3, 0, 512]


def test_default_encoder(spark, plan):
    df = silver(spark)
    encoder = fit_encoder(df, size=64)
    out = gold_from_silver(df, encoder)
    assert out.schema.fieldNames() == GOLD.fieldNames() and [f.dataType for f in out.schema] == [f.dataType for f in GOLD]
    found = np.array([r["embedding"] for r in out.collect()])
    assert found.shape == (40, 64) and np.all(np.linalg.norm(found, axis=1) <= 1.0001)
    assert gold_from_silver(df.where("false"), encoder).count() == 0
    long = spark.createDataFrame([("w " * 600 + "x " * 9,), ("w " * 600,)], "text string")
    a, b = (r["embedding"] for r in encode(long, encoder).collect())
    assert a != b
    a, b = (r["embedding"] for r in encode(long, fit_encoder(df, size=64, max_tokens=512)).collect())
    assert a == b
    assert "Python" not in plan(encode(df, encoder)) and "Exchange" not in plan(encode(df, encoder))


def test_python_encoder_sees_small_batches(spark):
    sizes = spark.sparkContext.accumulator(0)

    def load():
        def run(texts):
            assert len(texts) <= 7
            sizes.add(len(texts))
            return [None if t == "fail" else np.array([len(t), 1.0]) for t in texts]

        return run

    df = spark.createDataFrame([(f"t{i}" if i else "fail", i) for i in range(50)], "text string, n int")
    rows = sorted(encode(df, load, batch_size=7).collect(), key=lambda r: r["n"])
    assert rows[0]["embedding"] is None and rows[10]["embedding"] == [3.0, 1.0]
    assert sizes.value == 50


def test_gold_defaults(spark):
    df = spark.createDataFrame([(None, None, [1.0])], "id string, label int, embedding array<double>")
    assert tuple(to_gold(df).first()) == ("", "", 0, [1.0], "unknown", None)


def test_text_model_and_its_encoder(spark):
    df = silver(spark)
    trained = train_text_model(df.where("split = 'train'"), df.where("split = 'test'"), size=256)
    assert trained.metrics == {"train_accuracy": 1.0, "test_accuracy": 1.0}
    gold = gold_from_silver(df, encoder_of(trained.model))
    assert train_classifier(gold).metrics["test_accuracy"] == 1.0
    direct = score_text(df.withColumnRenamed("text", "cleaned_text"), trained.model)
    assert direct.where("pred_label <> label").isEmpty() and direct.columns[-2:] == ["pred_label", "pred_score"]
    assert train_text_model(df, df.where("false"), size=64).metrics == {"train_accuracy": 1.0}


def test_saved_text_model_is_the_encoder(spark, tmp_path):
    df, path = silver(spark), str(tmp_path / "text_model")
    other = choose_encoder(spark, path, lambda: fit_encoder(df, size=32))
    assert len(gold_from_silver(df, other).first()["embedding"]) == 32
    assert choose_encoder(spark, None, lambda: other) is other
    trained = train_text_model(df, size=64)
    save_model(trained.model, path, trained.metrics)
    chosen = choose_encoder(spark, path, lambda: other)
    assert sorted(gold_from_silver(df, chosen).collect()) == sorted(gold_from_silver(df, encoder_of(trained.model)).collect())


def test_export(spark, tmp_path):
    gold, _, _ = vectors(spark, n=20)
    points, _ = project_2d(gold.withColumn("text", F.repeat(F.lit("ab"), 80)), max_points=None)
    export_points(points, str(tmp_path / "csv"))
    row = read_csv(spark, str(tmp_path / "csv"), "id string, pc1 double, pc2 double, label bigint, text string").first()
    assert len(row["text"]) == 100 and row["pc1"] is not None
