"""End-to-end jobs: dataset to classifier."""

import time
from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverloom.constants import SEED
from silverloom.models.classifier import Trained, choose_encoder, train_classifier, train_text_model
from silverloom.models.encode import fit_encoder, gold_from_silver
from silverloom.models.store import model_exists, save_model
from silverloom.operators.dedup import KEY as DEDUP_KEY
from silverloom.operators.dedup import dedup_keys, with_key as with_dedup_key
from silverloom.operators.messages import bronze_from_messages
from silverloom.operators.sampling import first_rows, sample_balanced
from silverloom.operators.seen import SeenKeys
from silverloom.plans.silver import silver_job
from silverloom.schemas import GOLD, REVIEW
from silverloom.session import written
from silverloom.sinks.files import publish, write_layer, write_silver
from silverloom.sinks.tables import append_table
from silverloom.sources.jsonl import read_lines
from silverloom.sources.reviews import load_reviews
from silverloom.sources.tables import load_table, read_silver
from silverloom.sources.topic import topic_snapshot


class Places(NamedTuple):
    """Where a run keeps its layers: folders below ``root``, and catalog tables ``<database>.gold_<split>``."""

    root: str
    database: str = "default"

    def gold(self, split: str) -> str:
        return f"{self.database}.gold_{split}"

    @property
    def model(self) -> str:
        return f"{self.root}/model"

    @property
    def text_model(self) -> str:
        return f"{self.root}/text_model"


def is_ready(spark: SparkSession, tables: list[str], models: list[str]) -> bool:
    """Is one of the models there, and does every table hold rows? One row per table is read."""
    if not any(model_exists(spark, m) for m in models):
        return False
    return all(spark.catalog.tableExists(t) and not spark.table(t).isEmpty() for t in tables)


def rejected_path(path: str) -> str:
    """Where what a layer could not take is kept."""
    return f"{path.rstrip('/')}_rejected"


def reject(rows: DataFrame, path: str, run: str) -> None:
    """Keep what a layer could not take, as one part for each ``run``: a run that is taken up again replaces its own part."""
    marked = rows.withColumn("run", F.lit(run))
    out = marked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run")
    out.json(rejected_path(path))


def ingest_bronze(
    spark: SparkSession,
    topic: str,
    path: str,
    default_split: str,
    limit: int | None = None,
    servers: str | None = None,
    mode: str = "append",
) -> None:
    """Read a topic from its beginning and write its valid messages to bronze: the first ``limit`` ones, if given.

    The topic is read once: messages that arrive meanwhile are left for the next run. Messages that are not valid go to
    ``rejected_path(path)`` with the reason.
    """
    arrived = topic_snapshot(spark, topic, servers, ordered=limit is not None)
    good, bad = bronze_from_messages(arrived, default_split, settle=lambda rows: written(rows, "checked"))
    reject(bad, path, default_split)
    if limit is not None:
        good = first_rows(good, limit, "arrival")
    write_layer(good, path, mode=mode)


def build_silver(spark: SparkSession, bronze_path: str, silver_path: str, split: str) -> DataFrame:
    """One split of bronze to silver, without what silver holds already; returns the written silver of the split.

    The lines are parsed and cleaned once, whatever is made of them. The keys of silver are indexed beside it, so a small
    increment reads little of what is known. Lines that do not become silver go to ``rejected_path(silver_path)``.
    """
    bronze = read_lines(spark, f"{bronze_path}/split={split}")
    stored = read_silver(spark, silver_path)
    seen = SeenKeys(spark, f"{silver_path.rstrip('/')}_keys")
    seen.cover(stored)
    result = silver_job(bronze, existing=seen, settle=lambda rows: written(rows, "checked"))
    reject(result.quarantine, silver_path, split)
    new = written(result.silver, "new_silver")
    write_silver(new, silver_path)
    seen.add(new)
    return read_silver(spark, silver_path, split).select(*REVIEW.fieldNames())


def _is_there(spark: SparkSession, path: str) -> bool:
    file = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(file)


def build_gold(silver: DataFrame, encoder: PipelineModel, table: str, commit_id: int | None = None) -> None:
    """One commit of gold: the silver rows that the table does not hold yet."""
    spark = silver.sparkSession
    if spark.catalog.tableExists(table):
        known = dedup_keys(spark.table(table).select("text", "label", "split"))
        silver = written(with_dedup_key(silver).join(known, DEDUP_KEY, "left_anti").select(*silver.columns), "new_silver")
    append_table(gold_from_silver(silver, encoder), table, GOLD, commit_id)


def backfill(
    spark: SparkSession,
    places: Places,
    datasets: dict[str, DataFrame],
    key: str,
    test_split: str | None = "test",
    limit: int | None = None,
    size: int = 1 << 12,
    max_records: int | None = None,
    seed: int = SEED,
    balanced: bool = False,
) -> Trained | None:
    """Everything from raw rows to a saved classifier; None when a former run has saved it.

    A run that failed is taken up again: layers that are whole stay, and silver and gold take only what they lack.

    ``datasets`` maps a split to raw rows with ``text``, ``label`` and ``key``; it must hold ``train``. Each layer is
    written before the next one reads it. With ``balanced``, ``limit`` rows of each split are split evenly between the labels. With ``test_split=None`` only the training split is built and nothing is
    evaluated.
    """
    splits = ["train"] + ([test_split] if test_split else [])
    if is_ready(spark, [places.gold(s) for s in splits], [places.model]):
        return None
    topic, bronze, silver_path = (f"{places.root}/{layer}" for layer in ("topic", "bronze", "silver"))
    if not _is_there(spark, f"{bronze}/_SUCCESS"):  # the topic and bronze are built anew until bronze is whole
        if balanced and limit:
            datasets = {s: sample_balanced(datasets[s], limit, key, "label", seed) for s in splits}
        for i, split in enumerate(splits):
            publish(load_reviews(datasets[split], split, key, limit, seed=seed), topic, mode="append" if i else "overwrite")
        ingest_bronze(spark, topic, bronze, default_split="train")
    silver = {split: build_silver(spark, bronze, silver_path, split) for split in splits}

    text_model = train_text_model(silver["train"], silver.get(test_split), size=size)
    save_model(text_model.model, places.text_model, text_model.metrics)
    encoder = choose_encoder(spark, places.text_model, lambda: fit_encoder(silver["train"], size))
    commit = int(time.time() * 1000)
    for split in splits:
        build_gold(silver[split], encoder, places.gold(split), commit)

    train = load_table(spark, places.gold("train"), f"{places.database}.gold")
    test = load_table(spark, places.gold(test_split), f"{places.database}.gold") if test_split else None
    trained = train_classifier(train, test, test_split=test_split, max_records=max_records, seed=seed)
    save_model(trained.model, places.model, trained.metrics, embedding="embedding", label="label", split="split")
    return trained
