"""Decisions on a score or a drift value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from steprisk.schema import DECISION_THRESHOLD, REVIEW_THRESHOLD

# Drift severity bounds, and the ranking of the names.
HIGH_DRIFT = 0.25
MEDIUM_DRIFT = 0.10
SEVERITIES = ("LOW", "MEDIUM", "HIGH")


def flagged(score: str | Column, threshold: float) -> Column:
    """``score >= threshold``; a missing score (NULL or NaN) is not flagged."""
    score = F.col(score) if isinstance(score, str) else score
    return F.coalesce((score >= threshold) & ~F.isnan(score), F.lit(False))


def classify(score: str | Column, threshold: float = DECISION_THRESHOLD) -> Column:
    return F.when(flagged(score, threshold), F.lit("fraud")).otherwise(F.lit("legitimate"))


def risk_level(score: str | Column, high: float = DECISION_THRESHOLD, medium: float = REVIEW_THRESHOLD) -> Column:
    return (
        F.when(flagged(score, high), F.lit("HIGH"))
        .when(flagged(score, medium), F.lit("MEDIUM"))
        .otherwise(F.lit("LOW"))
    )


def severity(value: str | Column) -> Column:
    """Decided on the unrounded value."""
    return (
        F.when(flagged(value, HIGH_DRIFT), F.lit("HIGH"))
        .when(flagged(value, MEDIUM_DRIFT), F.lit("MEDIUM"))
        .otherwise(F.lit("LOW"))
    )


def severity_rank(name: str | Column) -> Column:
    """0, 1, 2 for LOW, MEDIUM, HIGH."""
    name = F.col(name) if isinstance(name, str) else name
    return F.array_position(F.lit(list(SEVERITIES)), name) - 1


def worst_severity(name: str | Column) -> Column:
    """Aggregate: the highest severity, LOW when there is none."""
    rank = F.coalesce(F.max(severity_rank(name)), F.lit(0))
    return F.element_at(F.lit(list(SEVERITIES)), (rank + 1).cast("int"))
