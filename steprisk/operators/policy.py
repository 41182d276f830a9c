"""Retraining and promotion rules as column expressions: one decision per input row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rule limits.
FRAUD_RATE_RATIO_LIMIT = 2.0
MIN_PR_AUC = 0.90
MIN_PR_AUC_GAIN = 0.0
MAX_RECALL_DROP = 0.02
MAX_PRECISION_DROP = 0.05
MAX_FALSE_POSITIVE_MULTIPLIER = 2.0

# Reason and decision texts.
SCORE_DRIFT_REASON = "High model-score distribution drift detected."
PREVALENCE_REASON = "Fraud prevalence shifted beyond the configured threshold."
PR_AUC_REASON = "Held-out PR-AUC fell below the configured minimum."
GAIN_REASON = "Candidate PR-AUC does not meet the required improvement."
RECALL_REASON = "Candidate recall degradation exceeds the allowed limit."
PRECISION_REASON = "Candidate precision degradation exceeds the allowed limit."
FALSE_POSITIVE_REASON = "Candidate false-positive increase exceeds the allowed limit."
APPROVED = "CANDIDATE_APPROVED_FOR_REVIEW"
KEPT = "KEEP_PRODUCTION"


def _reasons(*rules: tuple[Column, str]) -> Column:
    return F.array_compact(F.array(*[F.when(rule, F.lit(text)) for rule, text in rules]))


def retraining_policy(
    metrics: DataFrame,
    fraud_rate_ratio_limit: float = FRAUD_RATE_RATIO_LIMIT,
    min_pr_auc: float = MIN_PR_AUC,
) -> DataFrame:
    """Rows of (``score_severity``, ``fraud_rate_ratio``, ``pr_auc``) with the retraining decision added.

    A missing severity counts as LOW, a missing ratio as 1.0, a missing PR-AUC as 0.0 (which fires its rule).
    Promotion is never automatic.
    """
    reasons = _reasons(
        (F.coalesce("score_severity", F.lit("LOW")) == "HIGH", SCORE_DRIFT_REASON),
        (F.coalesce("fraud_rate_ratio", F.lit(1.0)) >= fraud_rate_ratio_limit, PREVALENCE_REASON),
        (F.coalesce("pr_auc", F.lit(0.0)) < min_pr_auc, PR_AUC_REASON),
    )
    return (
        metrics.withColumn("reasons", reasons)
        .withColumn("retraining_recommended", F.size("reasons") > 0)
        .withColumn("auto_promotion_allowed", F.lit(False))
        .withColumn("severity", F.when(F.col("retraining_recommended"), "HIGH").otherwise("LOW"))
    )


def promotion_gate(
    pairs: DataFrame,
    min_pr_auc_gain: float = MIN_PR_AUC_GAIN,
    max_recall_drop: float = MAX_RECALL_DROP,
    max_precision_drop: float = MAX_PRECISION_DROP,
    max_false_positive_multiplier: float = MAX_FALSE_POSITIVE_MULTIPLIER,
) -> DataFrame:
    """Rows of ``champion_*`` and ``candidate_*`` metrics (pr_auc, recall, precision, fp) with the decision added.

    Missing metrics, or missing metric columns, count as 0. Reaching a limit exactly passes.
    """

    def metric(side: str, name: str) -> Column:
        column = f"{side}_{name}"
        return F.coalesce(F.col(column), F.lit(0)) if column in pairs.columns else F.lit(0)

    def drop(name: str) -> Column:
        return metric("champion", name) - metric("candidate", name)

    multiplier = metric("candidate", "fp") / F.greatest(metric("champion", "fp"), F.lit(1))
    reasons = _reasons(
        (metric("candidate", "pr_auc") - metric("champion", "pr_auc") < min_pr_auc_gain, GAIN_REASON),
        (drop("recall") > max_recall_drop, RECALL_REASON),
        (drop("precision") > max_precision_drop, PRECISION_REASON),
        (multiplier > max_false_positive_multiplier, FALSE_POSITIVE_REASON),
    )
    return (
        pairs.withColumn("reasons", reasons)
        .withColumn("promotion_recommended", F.size("reasons") == 0)
        .withColumn("decision", F.when(F.col("promotion_recommended"), APPROVED).otherwise(KEPT))
    )
