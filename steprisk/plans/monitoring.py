"""Drift report over two windows of the stored feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from steprisk.functions.decisions import SEVERITIES
from steprisk.functions.rowfeatures import drift_features
from steprisk.operators.drift import (
    SCORE_FEATURE,
    categorical_total_variation,
    counted_label_shift,
    counted_total_variation,
    numeric_drift,
    window_counts,
)
from steprisk.operators.metrics import heldout_performance
from steprisk.operators.split import fixed_windows
from steprisk.schema import DECISION_THRESHOLD, DRIFT_FEATURES, DRIFT_REPORT, REFERENCE_END_STEP


def drift_metrics(
    windowed: DataFrame,
    numeric: Sequence[str],
    categorical: str | None = "type",
    score: str | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Metric rows of all numeric features, the score, if there is one, and the categorical feature.

    The score is one more numeric column, so it shares the scans of the others. ``by``: segments, of numeric features only.
    """
    numeric = list(numeric)
    if score is not None:
        windowed = windowed.withColumnRenamed(score, SCORE_FEATURE)
        numeric.append(SCORE_FEATURE)
    metrics = numeric_drift(windowed, numeric, by=by)
    if categorical is not None and not by:
        metrics = metrics.unionByName(categorical_total_variation(windowed, categorical))
    return metrics


def store_scores(scored: DataFrame, path: str) -> DataFrame:
    """Write a scored table once and read it back: later passes scan columns instead of running the model."""
    scored.sortWithinPartitions("step").write.mode("overwrite").option("compression", "zstd").parquet(path)
    return scored.sparkSession.read.parquet(path)


def drift_report(
    scored: DataFrame,
    cutoff: int = REFERENCE_END_STEP,
    threshold: float = DECISION_THRESHOLD,
    numeric: Sequence[str] = DRIFT_FEATURES,
    score: str = "score",
) -> DataFrame:
    """One nested report row for a scored feature table.

    What is gathered are a few dozen numbers: a metric row per feature and one row each for labels, held-out
    performance and windows. Passes: one that counts by window and type, two for all numeric features and the score, and the narrow
    ones of the ranking metrics over the current window. ``scored`` should be a stored table (see ``store_scores``), not
    a plan that runs the model again each time.
    """
    spark = scored.sparkSession
    windowed = fixed_windows(drift_features(scored), cutoff)
    counts = window_counts(windowed).persist()
    windows = {
        row["window"]: row
        for row in counts.groupBy("window")
        .agg(F.sum("rows").alias("rows"), F.min("min_step").alias("min_step"), F.max("max_step").alias("max_step"))
        .collect()
    }
    if len(windows) < 2:
        raise ValueError(f"step {cutoff} leaves an empty window")
    reference, current = windows["reference"], windows["current"]
    totals = {name: row["rows"] for name, row in windows.items()}
    order = {name: place for place, name in enumerate([*numeric, "type", SCORE_FEATURE])}
    measured = drift_metrics(windowed, numeric, None, score).unionByName(counted_total_variation(counts, "type", totals))
    rows = [row.asDict() for row in measured.collect()]
    metrics = sorted(rows, key=lambda row: order[row["feature"]])
    labels = counted_label_shift(counts).first().asDict()
    counts.unpersist()
    report = {
        "reference_rows": reference["rows"],
        "current_rows": current["rows"],
        "overall_severity": max((row["severity"] for row in metrics), key=SEVERITIES.index, default=SEVERITIES[0]),
        "metrics": metrics,
        "label_monitoring": labels,
        "heldout_performance": heldout_performance(
            windowed.where(F.col("window") == "current"), threshold, score
        ).first().asDict(),
        "model_score_reference_rows": reference["rows"],
        "model_score_current_rows": current["rows"],
        "reference_window": f"step < {cutoff}",
        "current_window": f"step >= {cutoff}",
        "reference_step_max": reference["max_step"],
        "current_step_min": current["min_step"],
    }
    return spark.createDataFrame([report], DRIFT_REPORT)
