"""From a drift report to a retraining decision and a promotion recommendation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from steprisk.operators.drift import SCORE_FEATURE
from steprisk.operators.metrics import model_evaluation
from steprisk.operators.policy import promotion_gate, retraining_policy
from steprisk.plans.training import Boosting, save_model, score_feature_table, train_challenger
from steprisk.schema import CHALLENGER_CUTOFF_STEP, DECISION_THRESHOLD, LIFECYCLE_REPORT


def retraining_trigger(report: DataFrame) -> DataFrame:
    """The retraining decision for each drift report row."""
    score_metric = F.element_at(F.filter("metrics", lambda metric: metric["feature"] == SCORE_FEATURE), 1)
    return retraining_policy(
        report.select(
            F.when(F.exists("metrics", lambda metric: metric["feature"] == SCORE_FEATURE), score_metric["severity"])
            .alias("score_severity"),
            F.col("label_monitoring.fraud_rate_ratio").alias("fraud_rate_ratio"),
            F.col("heldout_performance.pr_auc").alias("pr_auc"),
        )
    ).select("retraining_recommended", "auto_promotion_allowed", "severity", "reasons")


def champion_vs_challenger(
    scored: DataFrame,
    champion_score: str = "champion_score",
    challenger_score: str = "challenger_score",
    threshold: float = DECISION_THRESHOLD,
    label: str = "isFraud",
) -> DataFrame:
    """One metric row per model, both from one pass over rows that carry both scores."""
    long = scored.select(
        F.col(label).alias("label"),
        F.stack(F.lit(2), F.lit("champion"), champion_score, F.lit("candidate"), challenger_score).alias(
            "model", "score"
        ),
    )
    return model_evaluation(long, threshold, "score", "label", by=["model"])


def as_pair(metrics: DataFrame) -> DataFrame:
    """The two metric rows side by side, as the promotion gate reads them (one row out)."""
    names = [name for name in metrics.columns if name != "model"]
    return metrics.agg(
        *[
            F.max(F.when(F.col("model") == side, F.col(name))).alias(f"{side}_{name}")
            for side in ("champion", "candidate")
            for name in names
        ]
    )


def lifecycle_report(
    report: DataFrame,
    table: DataFrame,
    champion: PipelineModel | Callable[[], PipelineModel],
    candidate_path: str,
    champion_path: str = "",
    cutoff: int = CHALLENGER_CUTOFF_STEP,
    threshold: float = DECISION_THRESHOLD,
    row_key: str = "event_id",
    boosting: Boosting = Boosting(),
) -> DataFrame:
    """Lifecycle report row; no row when the drift report does not call for retraining.

    The challenger is fitted on the history before ``cutoff``, saved beside the champion and never promoted. A ``champion`` that
    is a function is called after that fit, so that it can wait for a fit that runs at the same time.
    """
    spark = table.sparkSession
    trigger = retraining_trigger(report).first()
    if not trigger["retraining_recommended"]:
        return spark.createDataFrame([], LIFECYCLE_REPORT)
    candidate = train_challenger(table, cutoff, row_key, boosting)
    save_model(candidate, candidate_path)
    champion = champion if isinstance(champion, PipelineModel) else champion()
    later = table.where(F.col("step") >= cutoff)
    scored = score_feature_table(
        candidate, score_feature_table(champion, later, "champion_score", "float"), "challenger_score", "float"
    ).select("isFraud", "champion_score", "challenger_score")
    both = {row["model"]: row.asDict() for row in champion_vs_challenger(scored, threshold=threshold).collect()}
    metrics = spark.createDataFrame(list(both.values()), EVALUATION)
    promotion = promotion_gate(as_pair(metrics)).first()
    return spark.createDataFrame(
        [
            {
                "trigger": trigger.asDict(),
                "candidate_cutoff_step": cutoff,
                "training_window": f"step < {cutoff}",
                "evaluation_window": f"step >= {cutoff}",
                "decision_threshold": threshold,
                "champion_metrics": both["champion"],
                "candidate_metrics": both["candidate"],
                "promotion": {
                    name: promotion[name] for name in ("promotion_recommended", "decision", "reasons")
                },
                "production_model": champion_path,
                "candidate_model": candidate_path,
            }
        ],
        LIFECYCLE_REPORT,
    )


EVALUATION = (
    "model string, roc_auc double, pr_auc double, precision double, recall double, f1 double, "
    "tn bigint, fp bigint, fn bigint, tp bigint"
)
