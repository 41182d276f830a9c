"""Fitting, persisting and applying the boosted-tree classifier."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from steprisk.functions.decisions import classify, risk_level
from steprisk.functions.rowfeatures import (
    LEAKY_FEATURES,
    MODEL_FEATURES,
    SAFE_NUMERIC,
    leaky_benchmark_features,
    learned_types,
    model_columns,
    model_features,
    safe_features,
)
from steprisk.operators.metrics import model_evaluation, with_false_positive_rate
from steprisk.operators.quality import validate_schema, validate_scoring_rows, validate_target
from steprisk.operators.split import positional_split, strict_time_split
from steprisk.plans.boosting import POSITIVE, as_model, fit_trees
from steprisk.schema import DECISION_THRESHOLD
from steprisk.session import shared_folder
from steprisk.sources.runlog import log_run


@dataclass(frozen=True)
class Boosting:
    """The boosting parameters of every model."""

    rounds: int = 300
    depth: int = 6
    rate: float = 0.05
    row_fraction: float = 0.8
    column_fraction: float = 0.8
    seed: int = 42
    # Most distinct split candidates of a feature; a feature of fewer values is split between any two of them.
    bins: int = 32


def class_weight(train: DataFrame, label: str = "isFraud") -> DataFrame:
    """positives, negatives and the weight of a positive row: negatives / max(positives, 1)."""
    return train.agg(
        F.count_if(F.col(label) == 1).alias("positives"), F.count_if(F.col(label) != 1).alias("negatives")
    ).withColumn("scale_pos_weight", F.col("negatives") / F.greatest("positives", F.lit(1)))


def fit_classifier(
    train: DataFrame,
    features: Sequence[str],
    label: str = "isFraud",
    boosting: Boosting = Boosting(),
    positive_weight: float | None = None,
) -> PipelineModel:
    """Weighted gradient-boosted trees over the named columns; ``class_weight`` is the default weight.

    The rows are binned once and stay in memory, then on disk, as blocks of small integers; each level of a tree is one job
    (``boosting``). A label other than 0 and 1 is an error.
    """
    spark = train.sparkSession
    shared_folder(spark)
    known = F.coalesce(F.col(label).cast("double").isin(0.0, 1.0), F.lit(False))
    wrong, *_ = train.agg(F.count_if(~known)).first()
    if wrong:
        raise ValueError(f"{label} is neither 0 nor 1 in {wrong} rows")
    if positive_weight is None:
        positive_weight = class_weight(train, label).first()["scale_pos_weight"]
    rows = train.select(*features, (F.col(label) == 1).alias(POSITIVE))
    fitted = fit_trees(rows, features, float(positive_weight), boosting)
    classifier = GBTClassifier(
        labelCol=label,
        maxIter=boosting.rounds,
        maxDepth=boosting.depth,
        maxBins=boosting.bins,
        stepSize=boosting.rate,
        subsamplingRate=boosting.row_fraction,
        featureSubsetStrategy=str(boosting.column_fraction),
        seed=boosting.seed,
    )
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    return PipelineModel([assembler, as_model(spark, fitted, len(features), classifier)])


def score(
    model: PipelineModel, features: DataFrame, name: str = "score", inputs: Mapping[str, Column] | None = None
) -> DataFrame:
    """Input columns plus the fraud probability as a double column.

    ``inputs`` computes the model's inputs by name where the table does not hold them as they are. They get
    names of their own, so the table's columns stay untouched and unread ones are pruned from the scan.
    """
    assembler = model.stages[0]
    names = list(assembler.getInputCols())
    table, params = features, {}
    if inputs is not None:
        table = features.withColumns({f"_input_{column}": inputs[column] for column in names})
        params = {assembler.inputCols: [f"_input_{column}" for column in names]}
    return model.transform(table, params).select(*features.columns, vector_to_array("probability")[1].alias(name))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str) -> PipelineModel:
    """A stored model, or ``FileNotFoundError`` when the folder holds none."""
    try:
        spark.read.text(f"{path}/metadata").limit(1).count()
    except AnalysisException as error:
        raise FileNotFoundError(f"no model at {path}") from error
    return PipelineModel.load(path)


def score_feature_table(model: PipelineModel, table: DataFrame, name: str = "score", dtype: str = "double") -> DataFrame:
    """Stored feature rows with the score of a model on the production inputs."""
    return score(model, table, name, model_columns(dtype))


def score_transactions(
    model: PipelineModel, requests: DataFrame, threshold: float = DECISION_THRESHOLD
) -> DataFrame:
    """Decision rows for scoring requests, which carry their own history columns.

    Valid rows get probability (6 digits), threshold, prediction and risk level, decided on the unrounded
    probability; rejected rows keep NULLs there and list the violated rules. Works on streams as well.
    """
    checked = validate_scoring_rows(requests)
    scored = score_feature_table(model, checked, "_probability")
    valid = F.col("valid")
    return scored.select(
        *requests.columns,
        "violations",
        "valid",
        F.when(valid, F.round("_probability", 6)).alias("fraud_probability"),
        F.when(valid, F.lit(float(threshold))).alias("threshold"),
        F.when(valid, classify("_probability", threshold)).alias("prediction"),
        F.when(valid, risk_level("_probability", threshold)).alias("risk_level"),
    )


# --- training jobs -----------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Trained:
    """A fitted model with its held-out scores, one-row metrics and the parameters worth logging."""

    model: PipelineModel
    scored: DataFrame
    metrics: DataFrame
    params: dict = field(default_factory=dict)


def _finish(
    train: DataFrame, test: DataFrame, features: Sequence[str], boosting: Boosting, params: dict
) -> Trained:
    weight = class_weight(train).first()["scale_pos_weight"]
    model = fit_classifier(train, features, boosting=boosting, positive_weight=weight)
    scored = score(model, test)
    metrics = with_false_positive_rate(model_evaluation(scored, threshold=0.5))
    logged = {
        "model": "GBTClassifier",
        "n_estimators": boosting.rounds,
        "max_depth": boosting.depth,
        "max_bins": boosting.bins,
        "learning_rate": boosting.rate,
        "subsample": boosting.row_fraction,
        "colsample": boosting.column_fraction,
        "scale_pos_weight": weight,
        "threshold": 0.5,
        "isFlaggedFraud_used": False,
        **params,
    }
    return Trained(model, scored, metrics, logged)


def train_leaky_benchmark(
    transactions: DataFrame, row_key: str = "event_id", boosting: Boosting = Boosting(), train_fraction: float = 0.8
) -> Trained:
    """Positional split, features that include post-transaction balances. A reference point, not a claim."""
    validate_target(validate_schema(transactions))
    first, rest = positional_split(transactions, train_fraction, row_key)
    keep = [row_key, "isFraud"]
    return _finish(
        leaky_benchmark_features(first, keep),
        leaky_benchmark_features(rest, keep),
        LEAKY_FEATURES,
        boosting,
        {"split_strategy": "chronological_80_20", "post_transaction_balances": True},
    )


def train_leakage_safe(
    transactions: DataFrame, row_key: str = "event_id", boosting: Boosting = Boosting(), train_fraction: float = 0.8
) -> Trained:
    """Strict split, decision-time features, type indicators learned on the train side."""
    validate_target(validate_schema(transactions))
    before, after, cutoff = strict_time_split(transactions, train_fraction)
    types = learned_types(before)
    keep = [row_key, "isFraud"]
    return _finish(
        safe_features(before, types, keep),
        safe_features(after, types, keep),
        [*SAFE_NUMERIC, *[f"type_{name}" for name in types]],
        boosting,
        {"split_strategy": "chronological", "post_transaction_balances": False, "cutoff_step": cutoff},
    )


def train_behavioral(
    table: DataFrame, row_key: str = "event_id", boosting: Boosting = Boosting(), train_fraction: float = 0.8
) -> Trained:
    """Strict split of the stored feature table, the 19 production columns."""
    before, after, cutoff = strict_time_split(table, train_fraction)
    keep = [row_key, "isFraud"]
    return _finish(
        model_features(before, keep=keep),
        model_features(after, keep=keep),
        MODEL_FEATURES,
        boosting,
        {
            "split_strategy": "strict_chronological",
            "behavioral_features": True,
            "point_in_time_safe": True,
            "same_step_history_used": False,
            "post_transaction_balances": False,
            "cutoff_step": cutoff,
        },
    )


def train_challenger(
    table: DataFrame, cutoff: int, row_key: str = "event_id", boosting: Boosting = Boosting()
) -> PipelineModel:
    """The production columns over the longer history before ``cutoff``."""
    history = table.where(F.col("step") < cutoff)
    return fit_classifier(model_features(history, keep=[row_key, "isFraud"]), MODEL_FEATURES, boosting=boosting)


def log_training(trained: Trained, path: str, experiment: str, run_name: str, run_id: str | None = None) -> str:
    """Append the parameters and metrics of a training job to the run log."""
    return log_run(
        trained.scored.sparkSession, path, experiment, run_name, trained.params,
        trained.metrics.first().asDict(), run_id,
    )

