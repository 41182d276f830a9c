"""Tables the registered queries start from, all derived from the driver's ``events`` table."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from steprisk.operators.history import behavioral_features
from steprisk.plans.training import (
    Trained,
    load_model,
    save_model,
    train_behavioral,
    train_challenger,
    train_leakage_safe,
    train_leaky_benchmark,
)
from steprisk.schema import CHALLENGER_CUTOFF_STEP, TRANSACTIONS
from steprisk.session import shared_folder
from steprisk.sources.events import read_events_as_transactions
from steprisk.sources.features import write_features

# Threshold at which the proxy scores flag a useful share of rows.
PROXY_THRESHOLD = 0.5

RAW_COLUMNS = tuple(TRANSACTIONS.fieldNames())

_written: dict[tuple[str, str, str], str] = {}


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    return read_events_as_transactions(spark, folder)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_folder(spark)}/steprisk-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:8]}"


def _once(spark: SparkSession, folder: str, name: str, write: Callable[[str], None]) -> str:
    """Path of a derived table or model, written by the first query of this application that needs it."""
    key = (spark.sparkContext.applicationId, hashlib.sha1(folder.encode()).hexdigest(), name)
    if key not in _written:
        path = scratch(spark, name)
        write(path)
        _written[key] = path
    return _written[key]


def feature_table_path(spark: SparkSession, folder: str) -> str:
    return _once(
        spark, folder, "features", lambda path: write_features(behavioral_features(transactions(spark, folder)), path)
    )


def feature_table(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(feature_table_path(spark, folder))


TRAINERS = {
    "train_leaky_benchmark": (train_leaky_benchmark, transactions),
    "train_leakage_safe": (train_leakage_safe, transactions),
    "train_behavioral": (train_behavioral, feature_table),
}

_trained: dict[tuple[str, str, str], Trained] = {}


def trained(spark: SparkSession, folder: str, name: str) -> Trained:
    """A trainer's result with the default boosting, fitted by the first query of this application that needs it."""
    key = (spark.sparkContext.applicationId, hashlib.sha1(folder.encode()).hexdigest(), name)
    if key not in _trained:
        train, table = TRAINERS[name]
        _trained[key] = train(table(spark, folder))
    return _trained[key]


def champion_path(spark: SparkSession, folder: str) -> str:
    def write(path: str) -> None:
        save_model(trained(spark, folder, "train_behavioral").model, path)

    return _once(spark, folder, "champion", write)


def champion(spark: SparkSession, folder: str) -> PipelineModel:
    return load_model(spark, champion_path(spark, folder))


def challenger_path(spark: SparkSession, folder: str) -> str:
    def write(path: str) -> None:
        table = feature_table(spark, folder)
        save_model(train_challenger(table, CHALLENGER_CUTOFF_STEP), path)

    return _once(spark, folder, "challenger", write)


def challenger(spark: SparkSession, folder: str) -> PipelineModel:
    return load_model(spark, challenger_path(spark, folder))


def champion_score() -> Column:
    """Deterministic stand-in for a model score."""
    return F.least(F.lit(1.0), F.col("amount") / 300)


def challenger_score() -> Column:
    return F.least(
        F.lit(1.0), F.when(F.col("type") == "TRANSFER", F.col("amount") / 250).otherwise(F.col("amount") / 1000)
    )


def scored_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return transactions(spark, folder).withColumn("score", champion_score())


def scored_features(spark: SparkSession, folder: str) -> DataFrame:
    return feature_table(spark, folder).withColumn("score", champion_score())
