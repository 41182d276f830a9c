"""One registered query per operator: ``name -> (spark, folder) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from steprisk.catalog.inputs import (
    PROXY_THRESHOLD,
    RAW_COLUMNS,
    TRAINERS,
    challenger,
    challenger_path,
    challenger_score,
    champion,
    champion_path,
    champion_score,
    feature_table,
    feature_table_path,
    scored_features,
    scored_transactions,
    scratch,
    trained,
    transactions,
)
from steprisk.functions import rowfeatures
from steprisk.functions.decisions import classify, risk_level, severity
from steprisk.operators import drift, history, metrics, quality, split
from steprisk.operators.policy import promotion_gate, retraining_policy
from steprisk.operators.row_history import row_history
from steprisk.plans import lifecycle, training, trees
from steprisk.plans.monitoring import drift_report
from steprisk.schema import (
    CHALLENGER_CUTOFF_STEP,
    DRIFT_FEATURES,
    DRIFT_REPORT,
    REFERENCE_END_STEP,
    STORED_DRIFT_FEATURES,
)
from steprisk.sources import features as feature_source
from steprisk.sources import reports, runlog
from steprisk.sources.transactions import read_transactions, typed_projection
from steprisk.streaming.scoring import score_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def register_as(name: str, query: Query) -> None:
    QUERIES[name] = query


def _pick(columns: DataFrame, names: tuple[str, ...]) -> DataFrame:
    return columns.select("event_id", *names)


# --- sources and sinks -------------------------------------------------------------------------------------------


def _csv_copy(spark: SparkSession, folder: str) -> str:
    path = scratch(spark, "transactions")
    transactions(spark, folder).write.csv(path, header=True)
    return path


def _read_transactions(spark: SparkSession, folder: str) -> DataFrame:
    table = read_transactions(spark, _csv_copy(spark, folder))
    return table.withColumn("event_id", F.col("event_id").cast("bigint"))


register_as("read_transactions", _read_transactions)


def _typed_projection(spark: SparkSession, folder: str) -> DataFrame:
    text = spark.read.csv(_csv_copy(spark, folder), header=True)
    return typed_projection(text.withColumn("event_id", F.col("event_id").cast("bigint")), ("event_id",))


register_as("typed_projection", _typed_projection)


def _write_features(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "written-features")
    feature_source.write_features(history.behavioral_features(transactions(spark, folder)), path)
    return spark.read.parquet(path)


register_as("write_features", _write_features)


def _read_window(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["event_id", "step", "type", "isFraud", *STORED_DRIFT_FEATURES]
    return feature_source.read_window(
        spark, feature_table_path(spark, folder), F.col("step") < REFERENCE_END_STEP, columns
    )


register_as("read_window", _read_window)


def _flat_quality(report: DataFrame) -> DataFrame:
    return report.select(
        "rows",
        "columns",
        "fraud_transactions",
        "legitimate_transactions",
        F.round("fraud_rate", 9).alias("fraud_rate"),
        "duplicate_rows",
        *[F.col("transaction_types")[name].alias(f"rows_{name}") for name in quality.TRANSACTION_TYPES],
    )


def _write_report(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "quality-report")
    reports.write_report(quality.quality_report(transactions(spark, folder), RAW_COLUMNS), path)
    return _flat_quality(reports.read_report(spark, path, quality.QUALITY_REPORT))


register_as("write_report", _write_report)


def _read_report(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "drift-report")
    reports.write_report(drift_report(scored_features(spark, folder), threshold=PROXY_THRESHOLD), path)
    found = reports.read_report(spark, path, DRIFT_REPORT)
    return found.select(
        "reference_rows", "current_rows", "overall_severity", "label_monitoring.*", "heldout_performance.*",
        "reference_window", "current_window", "reference_step_max", "current_step_min",
    )


register_as("read_report", _read_report)


def _write_threshold_table(spark: SparkSession, folder: str) -> DataFrame:
    sweep = metrics.threshold_sweep(scored_transactions(spark, folder))
    path = scratch(spark, "thresholds")
    reports.write_threshold_table(sweep, path)
    return _rounded_sweep(reports.read_threshold_table(spark, path, sweep.schema))


register_as("write_threshold_table", _write_threshold_table)


@register
def save_load_model(spark: SparkSession, folder: str) -> DataFrame:
    """Rows, and rows whose score the stored and reloaded champion gives otherwise than the champion itself."""
    path, model = scratch(spark, "model"), champion(spark, folder)
    training.save_model(model, path)
    both = training.score_feature_table(
        training.load_model(spark, path), training.score_feature_table(model, feature_table(spark, folder)), "reloaded"
    )
    return both.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("score").eqNullSafe(F.col("reloaded"))).alias("differing")
    )


@register
def log_run(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "runs")
    scored = scored_transactions(spark, folder)
    found = metrics.confusion_counts(scored, PROXY_THRESHOLD).first().asDict()
    runlog.log_run(spark, path, "transaction-risk", "proxy", {"threshold": PROXY_THRESHOLD}, found, "run-1")
    return runlog.read_runs(spark, path)


@register
def output_summary(spark: SparkSession, folder: str) -> DataFrame:
    return feature_source.output_summary(feature_table(spark, folder))


# --- data quality ------------------------------------------------------------------------------------------------


@register
def missing_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Schema guard in front of a scan: the rows that pass, and what a table without two columns would lack."""
    table = transactions(spark, folder)
    lacking = quality.missing_columns(table.drop("amount", "type"))
    return quality.validate_schema(table).agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "missing", F.lit(",".join(lacking))
    )


def _three_level_label(table: DataFrame) -> DataFrame:
    return table.withColumn("isFraud", F.col("isFraud") + F.col("isFlaggedFraud"))


@register
def invalid_targets(spark: SparkSession, folder: str) -> DataFrame:
    return quality.invalid_targets(_three_level_label(transactions(spark, folder)))


@register
def duplicate_row_count(spark: SparkSession, folder: str) -> DataFrame:
    table = transactions(spark, folder)
    whole = quality.duplicate_row_count(table, RAW_COLUMNS).withColumn("over", F.lit("all columns"))
    keys = quality.duplicate_row_count(table, ["step", "type", "nameOrig"]).withColumn("over", F.lit("keys"))
    return whole.unionByName(keys)


@register
def null_counts(spark: SparkSession, folder: str) -> DataFrame:
    table = transactions(spark, folder).select(*RAW_COLUMNS)
    return quality.null_counts(
        table.withColumns(
            {
                "type": F.nullif(F.col("type"), F.lit("DEBIT")),
                "amount": F.when(F.col("amount") < 250, F.col("amount")),
                "oldbalanceOrg": F.when(F.col("isFraud") == 1, F.lit(float("nan"))).otherwise(F.col("oldbalanceOrg")),
            }
        )
    )


@register
def type_counts(spark: SparkSession, folder: str) -> DataFrame:
    return quality.type_counts(transactions(spark, folder))


@register
def class_balance(spark: SparkSession, folder: str) -> DataFrame:
    balance = quality.class_balance(transactions(spark, folder), RAW_COLUMNS)
    return balance.withColumn("fraud_rate", F.round("fraud_rate", 9))


@register
def quality_report(spark: SparkSession, folder: str) -> DataFrame:
    return _flat_quality(quality.quality_report(transactions(spark, folder), RAW_COLUMNS))


def _requests(spark: SparkSession, folder: str) -> DataFrame:
    """Feature rows as scoring requests; some are made invalid, by rules on their own values."""
    return feature_table(spark, folder).withColumns(
        {
            "amount": F.when(F.col("amount") >= 250, -F.col("amount")).otherwise(F.col("amount")),
            "dest_seen_before": F.when(F.col("orig_dest_prior_txn_count") >= 2, 2).otherwise(
                F.col("dest_seen_before")
            ),
            "type": F.when(F.col("oldbalanceDest") == 0, "UNKNOWN").otherwise(F.col("type")),
        }
    )


@register
def validate_scoring_rows(spark: SparkSession, folder: str) -> DataFrame:
    checked = quality.validate_scoring_rows(_requests(spark, folder))
    return checked.select("event_id", "valid", F.concat_ws(",", "violations").alias("violations"))


@register
def invalid_types(spark: SparkSession, folder: str) -> DataFrame:
    return _pick(quality.invalid_types(_requests(spark, folder)), ("type",))


# --- per-row features --------------------------------------------------------------------------------------------


def _row_feature(name: str, digits: int | None = None) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        value = F.col(name) if digits is None else F.round(name, digits)
        table = rowfeatures.transaction_features(transactions(spark, folder))
        return table.select("event_id", value.alias(name))

    return query


for _name in (
    "orig_balance_delta", "dest_balance_delta", "orig_balance_error", "dest_balance_error",
    "amount_to_orig_balance", "hour", "day",
):
    register_as(_name, _row_feature(_name))
# The logarithm may differ in the last bit between math libraries.
register_as("amount_log", _row_feature("amount_log", 9))


@register
def type_one_hot(spark: SparkSession, folder: str) -> DataFrame:
    return transactions(spark, folder).select("event_id", *rowfeatures.type_one_hot())


@register
def type_one_hot_learned(spark: SparkSession, folder: str) -> DataFrame:
    """Indicators learned before the cutoff, applied from it on; an early type is renamed so that it is unseen."""
    early_debit = (F.col("type") == "DEBIT") & (F.col("step") < REFERENCE_END_STEP)
    table = transactions(spark, folder).withColumn("type", F.when(early_debit, "PAYMENT").otherwise(F.col("type")))
    types = rowfeatures.learned_types(table.where(F.col("step") < REFERENCE_END_STEP))
    later = table.where(F.col("step") >= REFERENCE_END_STEP)
    return later.select("event_id", *rowfeatures.type_one_hot(types))


@register
def leaky_benchmark_features(spark: SparkSession, folder: str) -> DataFrame:
    table = rowfeatures.leaky_benchmark_features(transactions(spark, folder), ["event_id"])
    return table.withColumn("amount_log", F.round("amount_log", 9))


@register
def safe_features(spark: SparkSession, folder: str) -> DataFrame:
    return rowfeatures.safe_features(transactions(spark, folder), keep=["event_id"])


@register
def model_features(spark: SparkSession, folder: str) -> DataFrame:
    return rowfeatures.model_features(feature_table(spark, folder), keep=["event_id"])


@register
def model_features_f64(spark: SparkSession, folder: str) -> DataFrame:
    return rowfeatures.model_features(feature_table(spark, folder), "double", ["event_id"])


# --- history of earlier steps ------------------------------------------------------------------------------------


@register
def origin_step_agg(spark: SparkSession, folder: str) -> DataFrame:
    return history.origin_step_agg(transactions(spark, folder))


@register
def pair_step_agg(spark: SparkSession, folder: str) -> DataFrame:
    return history.pair_step_agg(transactions(spark, folder))


def _history_column(name: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return _pick(history.step_history(transactions(spark, folder)), (name,))

    return query


def _feature_column(name: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return _pick(history.behavioral_features(transactions(spark, folder)), (name,))

    return query


HISTORY_COLUMNS = (
    "orig_prior_txn_count", "orig_prior_amount_sum", "orig_previous_step", "orig_first_step",
    "orig_dest_prior_txn_count",
)
DERIVED_COLUMNS = (
    "orig_prior_amount_mean", "orig_steps_since_prev_txn", "orig_account_age_steps", "amount_vs_prior_mean",
    "dest_seen_before",
)
for _name in HISTORY_COLUMNS:
    register_as(_name, _history_column(_name))
for _name in DERIVED_COLUMNS:
    register_as(_name, _feature_column(_name))


@register
def attach_origin_history(spark: SparkSession, folder: str) -> DataFrame:
    table = transactions(spark, folder)
    joined = history.attach_origin_history(table, history.origin_history(table))
    return _pick(joined, HISTORY_COLUMNS[:4])


@register
def attach_pair_history(spark: SparkSession, folder: str) -> DataFrame:
    table = transactions(spark, folder)
    return _pick(history.attach_pair_history(table, history.pair_history(table)), HISTORY_COLUMNS[4:])


@register
def behavioral_features(spark: SparkSession, folder: str) -> DataFrame:
    return history.behavioral_features(transactions(spark, folder))


@register
def behavioral_features_grouped(spark: SparkSession, folder: str) -> DataFrame:
    """Same rows through per-step aggregates and joins."""
    return history.behavioral_features(transactions(spark, folder), plan="grouped")


# --- history of earlier rows -------------------------------------------------------------------------------------

ROW_COLUMNS = {
    "row_prior_txn_count": "orig_prior_txn_count",
    "row_prior_amount_sum": "orig_prior_amount_sum",
    "row_prior_amount_mean": "orig_prior_amount_mean",
    "row_steps_since_prev": "orig_steps_since_prev_txn",
    "row_account_age": "orig_account_age_steps",
    "row_amount_vs_prior_mean": "amount_vs_prior_mean",
    "row_pair_prior_count": "orig_dest_prior_txn_count",
    "row_dest_seen_before": "dest_seen_before",
}


def _row_column(name: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return _pick(row_history(transactions(spark, folder)), (ROW_COLUMNS[name],))

    return query


for _name in ROW_COLUMNS:
    register_as(_name, _row_column(_name))


@register
def row_behavioral_features(spark: SparkSession, folder: str) -> DataFrame:
    return row_history(transactions(spark, folder))


# A limit this low sends most accounts down the plan for hot ones.
LOW_HOT_ROWS = 12


@register
def row_behavioral_features_hot(spark: SparkSession, folder: str) -> DataFrame:
    return row_history(transactions(spark, folder), hot_rows=LOW_HOT_ROWS)


@register
def behavioral_features_hot(spark: SparkSession, folder: str) -> DataFrame:
    return history.behavioral_features(transactions(spark, folder), hot_rows=LOW_HOT_ROWS)


# --- splits ------------------------------------------------------------------------------------------------------


@register
def cutoff_step(spark: SparkSession, folder: str) -> DataFrame:
    return spark.createDataFrame([(split.cutoff_step(transactions(spark, folder), 0.8),)], "cutoff_step int")


@register
def strict_time_split(spark: SparkSession, folder: str) -> DataFrame:
    table = transactions(spark, folder)
    return _pick(split.label_split(table, split.cutoff_step(table)), ("step", "split"))


@register
def split_guards(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and step range of both sides of a split that passed the guards."""
    before, after, cutoff = split.strict_time_split(transactions(spark, folder), 0.9)
    sides = before.withColumn("split", F.lit("train")).unionByName(after.withColumn("split", F.lit("test")))
    return (
        sides.groupBy("split")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("step").alias("first"), F.max("step").alias("last"))
        .withColumn("cutoff_step", F.lit(cutoff))
    )


@register
def positional_split(spark: SparkSession, folder: str) -> DataFrame:
    first, rest = split.positional_split(transactions(spark, folder))
    return _pick(
        first.withColumn("split", F.lit("train")).unionByName(rest.withColumn("split", F.lit("test"))), ("split",)
    )


@register
def fixed_windows(spark: SparkSession, folder: str) -> DataFrame:
    return _pick(split.fixed_windows(transactions(spark, folder)), ("step", "window"))


# --- models ------------------------------------------------------------------------------------------------------


@register
def class_weight(spark: SparkSession, folder: str) -> DataFrame:
    before, _, _ = split.strict_time_split(transactions(spark, folder))
    return training.class_weight(before)


def _is_probability(name: str = "score") -> Column:
    return F.coalesce(F.col(name).between(0.0, 1.0), F.lit(False)).alias("is_probability")


def _checked(spark: SparkSession, path: str, scored: DataFrame, dtype: str) -> DataFrame:
    inputs, depth = rowfeatures.model_columns(dtype), training.Boosting().depth
    both = trees.walked_score(spark, path, scored, list(inputs), depth, "walked", inputs)
    agrees = F.coalesce(F.abs(F.col("score") - F.col("walked")) <= 1e-9, F.lit(False))
    return both.select("event_id", _is_probability(), agrees.alias("walk_agrees"))


# Few enough values that every split between two of them is a candidate, so SQL can repeat the whole fit.
COARSE = training.Boosting(rounds=3, depth=2, rate=0.3, row_fraction=1.0, column_fraction=1.0)


def _coarse(table: DataFrame) -> DataFrame:
    return table.select(
        "event_id",
        "isFraud",
        rowfeatures.hour().alias("hour"),
        F.least(F.floor(F.col("amount") / 20), F.lit(30)).alias("amount_band"),
        F.least("orig_prior_txn_count", F.lit(20)).alias("prior_count"),
    )


@register
def fit_classifier_coarse(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of the held-out rows by weighted boosted trees over three coarse features, all rows and features sampled."""
    before, after, _ = split.strict_time_split(feature_table(spark, folder))
    model = training.fit_classifier(_coarse(before), ["hour", "amount_band", "prior_count"], boosting=COARSE)
    return _rounded(training.score(model, _coarse(after)).select("event_id", "score"), ("score",))


@register
def fit_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Held-out rows of a freshly fitted model."""
    return trained(spark, folder, "train_behavioral").scored.select(
        "event_id", "isFraud", _is_probability()
    )


@register
def score(spark: SparkSession, folder: str) -> DataFrame:
    """Every row's score is a probability and the one that a walk down the stored trees gives."""
    scored = training.score_feature_table(champion(spark, folder), feature_table(spark, folder))
    return _checked(spark, champion_path(spark, folder), scored, "double")


def _classify(spark: SparkSession, folder: str) -> DataFrame:
    return scored_transactions(spark, folder).select("event_id", classify("score").alias("prediction"))


register_as("classify", _classify)


def _risk_level(spark: SparkSession, folder: str) -> DataFrame:
    return scored_transactions(spark, folder).select("event_id", risk_level("score").alias("risk_level"))


register_as("risk_level", _risk_level)


def _decisions(decided: DataFrame) -> DataFrame:
    """What a decision row must say whatever the model: its checks, and a decision that follows from its probability."""
    probability, threshold = F.col("fraud_probability"), F.col("threshold")
    # The probability is shown with six digits; next to the threshold it does not tell the side.
    near = F.abs(probability - threshold) <= 1e-6
    follows = near | ((F.col("prediction") == "fraud") == (probability >= threshold))
    empty = probability.isNull() & threshold.isNull() & F.col("prediction").isNull() & F.col("risk_level").isNull()
    return decided.select(
        "event_id",
        "valid",
        F.concat_ws(",", "violations").alias("violations"),
        "threshold",
        F.when(F.col("valid"), probability.between(0.0, 1.0) & follows).otherwise(empty).alias("consistent"),
    )


@register
def score_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return _decisions(training.score_transactions(champion(spark, folder), _requests(spark, folder), PROXY_THRESHOLD))


def _score_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same requests, read as a stream of files and drained once."""
    source, output = scratch(spark, "requests"), scratch(spark, "decisions")
    requests = _requests(spark, folder)
    requests.write.parquet(source)
    stream = spark.readStream.schema(requests.schema).parquet(source)
    query = score_stream(
        champion(spark, folder), stream, output, scratch(spark, "stream-state"), PROXY_THRESHOLD, available_now=True
    )
    query.awaitTermination()
    return _decisions(spark.read.parquet(output))


register_as("score_stream", _score_stream)


def _trainer(name: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        """Held-out labels as the metrics count them, and the first held-out step where there is one."""
        fitted = trained(spark, folder, name)
        return fitted.metrics.select(
            (F.col("tn") + F.col("fp")).alias("negatives"),
            (F.col("fn") + F.col("tp")).alias("positives"),
            F.lit(fitted.params.get("cutoff_step")).cast("int").alias("cutoff_step"),
        )

    return query


for _name in TRAINERS:
    register_as(_name, _trainer(_name))


# --- evaluation --------------------------------------------------------------------------------------------------

_RATES = ("precision", "recall", "f1")


def _rounded(table: DataFrame, names: tuple[str, ...], digits: int = 9) -> DataFrame:
    return table.withColumns({name: F.round(name, digits) for name in names})


def _rounded_sweep(sweep: DataFrame) -> DataFrame:
    return _rounded(sweep, ("threshold", *_RATES))


@register
def confusion_counts(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.confusion_counts(scored_transactions(spark, folder), PROXY_THRESHOLD)


@register
def precision_recall_f1(spark: SparkSession, folder: str) -> DataFrame:
    counts = metrics.confusion_counts(scored_transactions(spark, folder), PROXY_THRESHOLD)
    return _rounded(metrics.with_precision_recall_f1(counts).select(*_RATES), _RATES)


@register
def false_positive_rate(spark: SparkSession, folder: str) -> DataFrame:
    counts = metrics.confusion_counts(scored_transactions(spark, folder), PROXY_THRESHOLD)
    rate = metrics.with_false_positive_rate(counts).select("false_positive_rate")
    return _rounded(rate, ("false_positive_rate",))


@register
def business_cost(spark: SparkSession, folder: str) -> DataFrame:
    counts = metrics.confusion_counts(scored_transactions(spark, folder), PROXY_THRESHOLD)
    return metrics.with_business_cost(counts).select(
        "false_positive_cost", "false_negative_cost", "estimated_business_cost"
    )


@register
def roc_auc(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(metrics.roc_auc(scored_transactions(spark, folder)), ("roc_auc",))


@register
def average_precision(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(metrics.average_precision(scored_transactions(spark, folder)), ("pr_auc",))


@register
def classification_report(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(metrics.classification_report(scored_transactions(spark, folder), PROXY_THRESHOLD), _RATES)


@register
def evaluate_threshold(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded_sweep(metrics.evaluate_threshold(scored_transactions(spark, folder), PROXY_THRESHOLD))


def _sweep(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.threshold_sweep(scored_transactions(spark, folder))


register_as("threshold_sweep", lambda spark, folder: _rounded_sweep(_sweep(spark, folder)))
register_as("best_f1_threshold", lambda spark, folder: _rounded_sweep(metrics.best_f1_threshold(_sweep(spark, folder))))
register_as(
    "lowest_cost_threshold", lambda spark, folder: _rounded_sweep(metrics.lowest_cost_threshold(_sweep(spark, folder)))
)
register_as("nearest_threshold", lambda spark, folder: _rounded_sweep(metrics.nearest_threshold(_sweep(spark, folder))))


@register
def heldout_performance(spark: SparkSession, folder: str) -> DataFrame:
    current = scored_transactions(spark, folder).where(F.col("step") >= REFERENCE_END_STEP)
    return metrics.heldout_performance(current, PROXY_THRESHOLD)


@register
def model_evaluation(spark: SparkSession, folder: str) -> DataFrame:
    later = scored_transactions(spark, folder).where(F.col("step") >= CHALLENGER_CUTOFF_STEP)
    return _rounded(metrics.model_evaluation(later, PROXY_THRESHOLD), ("roc_auc", "pr_auc", *_RATES))


# --- drift -------------------------------------------------------------------------------------------------------


def _windowed(spark: SparkSession, folder: str) -> DataFrame:
    table = rowfeatures.drift_features(scored_features(spark, folder))
    return split.fixed_windows(table).withColumnRenamed("score", drift.SCORE_FEATURE)


WATCHED = (*DRIFT_FEATURES, drift.SCORE_FEATURE)
# Columns with too few distinct values for three quantile edges.
FLAT_FEATURES = ("dest_seen_before", "orig_dest_prior_txn_count")


@register
def psi_edges(spark: SparkSession, folder: str) -> DataFrame:
    return drift.edges_table(spark, drift.psi_edges(_windowed(spark, folder), WATCHED))


@register
def psi_fallback_edges(spark: SparkSession, folder: str) -> DataFrame:
    return drift.edges_table(spark, drift.psi_edges(_windowed(spark, folder), FLAT_FEATURES))


@register
def psi_bin_counts(spark: SparkSession, folder: str) -> DataFrame:
    table = _windowed(spark, folder)
    return drift.psi_bin_counts(table, drift.psi_edges(table, WATCHED))


@register
def psi(spark: SparkSession, folder: str) -> DataFrame:
    table = _windowed(spark, folder)
    return _rounded(drift.psi(drift.psi_bin_counts(table, drift.psi_edges(table, WATCHED))), ("psi",))


@register
def numeric_drift(spark: SparkSession, folder: str) -> DataFrame:
    return drift.numeric_drift(_windowed(spark, folder), DRIFT_FEATURES)


@register
def categorical_total_variation(spark: SparkSession, folder: str) -> DataFrame:
    return drift.categorical_total_variation(_windowed(spark, folder))


def _severity(spark: SparkSession, folder: str) -> DataFrame:
    """Severity of each row's score, taken as a drift value."""
    return scored_transactions(spark, folder).select("event_id", severity("score").alias("severity"))


register_as("severity", _severity)


@register
def overall_severity(spark: SparkSession, folder: str) -> DataFrame:
    """Worst severity per transaction type, over the rows' own severities."""
    rows = scored_transactions(spark, folder).select("type", severity("score").alias("severity"))
    return rows.groupBy("type").agg(drift.worst_severity("severity").alias("overall_severity"))


@register
def score_drift(spark: SparkSession, folder: str) -> DataFrame:
    return drift.score_drift(_windowed(spark, folder), drift.SCORE_FEATURE)


@register
def label_shift(spark: SparkSession, folder: str) -> DataFrame:
    return drift.label_shift(_windowed(spark, folder))


@register
def window_profile(spark: SparkSession, folder: str) -> DataFrame:
    return drift.window_profile(_windowed(spark, folder))


def _drift_report(spark: SparkSession, folder: str) -> DataFrame:
    """Metric rows of the composite report."""
    report = drift_report(scored_features(spark, folder), threshold=PROXY_THRESHOLD)
    return report.select("overall_severity", F.inline("metrics"))


register_as("drift_report", _drift_report)


# --- lifecycle rules ---------------------------------------------------------------------------------------------

def _decision(table: DataFrame, *names: str) -> DataFrame:
    return table.select(*names, F.concat_ws(" ", "reasons").alias("reasons"))


def _retraining_policy(spark: SparkSession, folder: str) -> DataFrame:
    """One decision per hour of the day, each hour being a segment of its own."""
    table = split.fixed_windows(rowfeatures.drift_features(scored_features(spark, folder)))
    by_segment = drift.score_drift(table, by=["hour"]).select("hour", F.col("severity").alias("score_severity"))
    rate = {name: F.avg(F.when(F.col("window") == name, F.col("isFraud"))) for name in ("reference", "current")}
    shift = table.groupBy("hour").agg(
        F.round(rate["current"] / F.greatest(rate["reference"], F.lit(1e-12)), 4).alias("fraud_rate_ratio")
    )
    held_out = metrics.average_precision(table.where("window = 'current'"), by=["hour"])
    segments = by_segment.join(shift, "hour").join(_rounded(held_out, ("pr_auc",)), "hour")
    return _decision(
        retraining_policy(segments), "hour", "score_severity", "fraud_rate_ratio", "pr_auc",
        "retraining_recommended", "auto_promotion_allowed", "severity",
    )


register_as("retraining_policy", _retraining_policy)


def _both_scores(spark: SparkSession, folder: str) -> DataFrame:
    later = feature_table(spark, folder).where(F.col("step") >= CHALLENGER_CUTOFF_STEP)
    return later.withColumns({"champion_score": champion_score(), "challenger_score": challenger_score()})


def _promotion_gate(spark: SparkSession, folder: str) -> DataFrame:
    """One decision per hour of the day for the two proxy scores."""
    long = _both_scores(spark, folder).select(
        rowfeatures.hour().alias("hour"),
        "isFraud",
        F.stack(F.lit(2), F.lit("champion"), "champion_score", F.lit("candidate"), "challenger_score").alias(
            "model", "score"
        ),
    )
    found = metrics.model_evaluation(long, PROXY_THRESHOLD, by=["hour", "model"])
    found = _rounded(found, ("pr_auc", "recall", "precision"))
    pairs = found.groupBy("hour").agg(
        *[
            F.max(F.when(F.col("model") == side, F.col(name))).alias(f"{side}_{name}")
            for side in ("champion", "candidate")
            for name in ("pr_auc", "recall", "precision", "fp")
        ]
    )
    return _decision(promotion_gate(pairs), *pairs.columns, "promotion_recommended", "decision")


register_as("promotion_gate", _promotion_gate)


def _train_challenger(spark: SparkSession, folder: str) -> DataFrame:
    later = feature_table(spark, folder).where(F.col("step") >= CHALLENGER_CUTOFF_STEP)
    scored = training.score_feature_table(challenger(spark, folder), later, dtype="float")
    return _checked(spark, challenger_path(spark, folder), scored, "float")


register_as("train_challenger", _train_challenger)


@register
def champion_vs_challenger(spark: SparkSession, folder: str) -> DataFrame:
    found = lifecycle.champion_vs_challenger(_both_scores(spark, folder), threshold=PROXY_THRESHOLD)
    return _rounded(found, ("roc_auc", "pr_auc", *_RATES))


def _lifecycle_report(spark: SparkSession, folder: str) -> DataFrame:
    """Drift report of the proxy score, then trigger, challenger, comparison with the champion and gate.

    The champion is fitted meanwhile: a fit is a long row of short jobs, which leave most of a cluster idle."""
    table = feature_table(spark, folder)
    with ThreadPoolExecutor(1) as beside:
        fitted = beside.submit(inheritable_thread_target(spark)(lambda: champion(spark, folder)))
        report = lifecycle.lifecycle_report(
            drift_report(scored_features(spark, folder), threshold=PROXY_THRESHOLD),
            table,
            fitted.result,
            scratch(spark, "candidate"),
            threshold=PROXY_THRESHOLD,
        )
        fitted.result()
    pair = report.select(
        "*",
        *[
            F.col(f"{side}_metrics.{name}").alias(f"{side}_{name}")
            for side in ("champion", "candidate")
            for name in ("pr_auc", "recall", "precision", "fp")
        ],
    )
    again = promotion_gate(pair)
    return again.select(
        "trigger.retraining_recommended",
        "candidate_cutoff_step",
        "training_window",
        "evaluation_window",
        "decision_threshold",
        *[
            (F.col(f"{side}_metrics.{one}") + F.col(f"{side}_metrics.{two}")).alias(f"{side}_{name}")
            for side in ("champion", "candidate")
            for name, one, two in (("negatives", "tn", "fp"), ("positives", "fn", "tp"))
        ],
        (F.col("promotion.decision") == F.col("decision")).alias("gate_agrees"),
    )


register_as("lifecycle_report", _lifecycle_report)
