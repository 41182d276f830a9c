"""Exact evaluation of scores against 0/1 labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from steprisk.functions.decisions import flagged
from steprisk.operators.buckets import running_totals
from steprisk.schema import DECISION_THRESHOLD

# Relative cost units of the two kinds of error.
FALSE_POSITIVE_COST = 1.0
FALSE_NEGATIVE_COST = 100.0

# 99 thresholds 0.01 ... 0.99, as start + i * step in double arithmetic.
THRESHOLDS = tuple(0.01 + i * 0.01 for i in range(99))

COUNTS = ("tn", "fp", "fn", "tp")
SWEEP_COLUMNS = (
    "threshold", "precision", "recall", "f1", "tp", "fp", "fn", "tn",
    "false_positive_cost", "false_negative_cost", "estimated_business_cost",
)


# --- counts and rates --------------------------------------------------------------------------------------------


def _counts(hit: Column, label: str) -> list[Column]:
    fraud = F.col(label) == 1
    return [
        F.count_if(~hit & ~fraud).alias("tn"),
        F.count_if(hit & ~fraud).alias("fp"),
        F.count_if(~hit & fraud).alias("fn"),
        F.count_if(hit & fraud).alias("tp"),
    ]


def confusion_counts(
    df: DataFrame, threshold: float, score: str = "score", label: str = "isFraud", by: Sequence[str] = ()
) -> DataFrame:
    """tn, fp, fn, tp at a threshold, optionally per group: one aggregate."""
    return df.groupBy(*by).agg(*_counts(flagged(score, threshold), label))


def precision() -> Column:
    return F.col("tp") / F.greatest(F.col("tp") + F.col("fp"), F.lit(1))


def recall() -> Column:
    return F.col("tp") / F.greatest(F.col("tp") + F.col("fn"), F.lit(1))


def f1() -> Column:
    return 2 * F.col("precision") * F.col("recall") / F.greatest(F.col("precision") + F.col("recall"), F.lit(1e-12))


def with_precision_recall_f1(counts: DataFrame) -> DataFrame:
    return counts.withColumns({"precision": precision(), "recall": recall()}).withColumn("f1", f1())


def with_false_positive_rate(counts: DataFrame) -> DataFrame:
    return counts.withColumn(
        "false_positive_rate", F.col("fp") / F.greatest(F.col("fp") + F.col("tn"), F.lit(1))
    )


def with_business_cost(
    counts: DataFrame,
    false_positive_cost: float = FALSE_POSITIVE_COST,
    false_negative_cost: float = FALSE_NEGATIVE_COST,
) -> DataFrame:
    return counts.withColumns(
        {
            "false_positive_cost": F.col("fp") * F.lit(float(false_positive_cost)),
            "false_negative_cost": F.col("fn") * F.lit(float(false_negative_cost)),
        }
    ).withColumn("estimated_business_cost", F.col("false_positive_cost") + F.col("false_negative_cost"))


def classification_report(
    df: DataFrame, threshold: float = 0.5, score: str = "score", label: str = "isFraud"
) -> DataFrame:
    """Rows ``0``, ``1``, ``accuracy``, ``macro avg``, ``weighted avg`` with precision, recall, f1 and support.

    The accuracy row carries the accuracy in all three rate columns.
    """
    counts = confusion_counts(df, threshold, score, label)

    def rates(hits: str, wrong: str, missed: str) -> tuple[Column, Column, Column]:
        found = F.col(hits) / F.greatest(F.col(hits) + F.col(wrong), F.lit(1))
        covered = F.col(hits) / F.greatest(F.col(hits) + F.col(missed), F.lit(1))
        return found, covered, 2 * found * covered / F.greatest(found + covered, F.lit(1e-12))

    legitimate, fraud = rates("tn", "fn", "fp"), rates("tp", "fp", "fn")
    n0, n1 = F.col("tn") + F.col("fp"), F.col("fn") + F.col("tp")
    rows = F.greatest(n0 + n1, F.lit(1))
    accuracy = (F.col("tn") + F.col("tp")) / rows
    macro = [(a + b) / 2 for a, b in zip(legitimate, fraud)]
    weighted = [(a * n0 + b * n1) / rows for a, b in zip(legitimate, fraud)]
    lines = [
        ("0", legitimate, n0),
        ("1", fraud, n1),
        ("accuracy", (accuracy, accuracy, accuracy), n0 + n1),
        ("macro avg", macro, n0 + n1),
        ("weighted avg", weighted, n0 + n1),
    ]
    cells = [cell for name, values, support in lines for cell in (F.lit(name), *values, support)]
    return counts.select(
        F.stack(F.lit(len(lines)), *cells).alias("class", "precision", "recall", "f1", "support")
    )


# --- ranking metrics ---------------------------------------------------------------------------------------------


def score_curve(
    df: DataFrame, score: str = "score", label: str = "isFraud", by: Sequence[str] = ()
) -> DataFrame:
    """Per distinct score: positives and negatives at it (``pos``, ``neg``) and above it."""
    labelled = df.select(
        *by,
        F.col(score).cast("double").alias("score"),
        F.coalesce((F.col(label) == 1).cast("bigint"), F.lit(0)).alias("pos"),
        F.coalesce((F.col(label) != 1).cast("bigint"), F.lit(0)).alias("neg"),
    )
    return running_totals(labelled, "score", {"pos": "pos_above", "neg": "neg_above"}, by, descending=True)


def _roc_auc() -> Column:
    """Share of (positive, negative) pairs ranked rightly, ties counting half. NULL without both classes."""
    won = F.sum(F.col("neg") * (F.col("pos_above") + F.col("pos") / 2))
    return F.try_divide(won, F.sum("pos").cast("double") * F.sum("neg")).alias("roc_auc")


def _average_precision() -> Column:
    """Sum of precision at each distinct score, weighted by the recall gained there; 0.0 without positives."""
    found = F.col("pos_above") + F.col("pos")
    kept = found + F.col("neg_above") + F.col("neg")
    return F.coalesce(F.try_divide(F.sum(F.try_divide(F.col("pos") * found, kept)), F.sum("pos")), F.lit(0.0)).alias("pr_auc")


def roc_auc(df: DataFrame, score: str = "score", label: str = "isFraud", by: Sequence[str] = ()) -> DataFrame:
    return score_curve(df, score, label, by).groupBy(*by).agg(_roc_auc())


def average_precision(
    df: DataFrame, score: str = "score", label: str = "isFraud", by: Sequence[str] = ()
) -> DataFrame:
    """Step-wise average precision. The trapezoid area Spark's evaluator reports is a different number."""
    return score_curve(df, score, label, by).groupBy(*by).agg(_average_precision())


def model_evaluation(
    df: DataFrame,
    threshold: float = DECISION_THRESHOLD,
    score: str = "score",
    label: str = "isFraud",
    by: Sequence[str] = (),
) -> DataFrame:
    """Ranking metrics, rates and counts of one scored table (or one row per group), unrounded.

    The counts come from the same per-score table as the ranking metrics, so the scores are read once.
    """
    hit = flagged("score", threshold)
    curve = score_curve(df, score, label, by)

    def total(column: str, side: Column) -> Column:
        return F.coalesce(F.sum(F.when(side, F.col(column))), F.lit(0))

    counted = curve.groupBy(*by).agg(
        _roc_auc(),
        _average_precision(),
        total("neg", ~hit).alias("tn"),
        total("neg", hit).alias("fp"),
        total("pos", ~hit).alias("fn"),
        total("pos", hit).alias("tp"),
    )
    return with_precision_recall_f1(counted).select(
        *by, "roc_auc", "pr_auc", "precision", "recall", "f1", *COUNTS
    )


def heldout_performance(
    df: DataFrame, threshold: float = DECISION_THRESHOLD, score: str = "score", label: str = "isFraud"
) -> DataFrame:
    """``model_evaluation`` as a monitoring record: rates rounded to 6 digits, long names, row counts."""
    metrics = model_evaluation(df, threshold, score, label)
    return metrics.select(
        F.lit("held_out_current_window").alias("evaluation_window"),
        F.lit(float(threshold)).alias("threshold"),
        (F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).alias("rows"),
        (F.col("fn") + F.col("tp")).alias("fraud_cases"),
        *[F.round(name, 6).alias(name) for name in ("roc_auc", "pr_auc", "precision", "recall", "f1")],
        F.col("tn").alias("true_negatives"),
        F.col("fp").alias("false_positives"),
        F.col("fn").alias("false_negatives"),
        F.col("tp").alias("true_positives"),
    )


# --- thresholds --------------------------------------------------------------------------------------------------


def evaluate_threshold(
    df: DataFrame,
    threshold: float,
    score: str = "score",
    label: str = "isFraud",
    false_positive_cost: float = FALSE_POSITIVE_COST,
    false_negative_cost: float = FALSE_NEGATIVE_COST,
) -> DataFrame:
    counts = confusion_counts(df, threshold, score, label).withColumn("threshold", F.lit(float(threshold)))
    return with_business_cost(
        with_precision_recall_f1(counts), false_positive_cost, false_negative_cost
    ).select(*SWEEP_COLUMNS)


def threshold_sweep(
    df: DataFrame,
    thresholds: Sequence[float] = THRESHOLDS,
    score: str = "score",
    label: str = "isFraud",
    false_positive_cost: float = FALSE_POSITIVE_COST,
    false_negative_cost: float = FALSE_NEGATIVE_COST,
) -> DataFrame:
    """``evaluate_threshold`` for every threshold in one pass.

    Each score is binned by how many thresholds it reaches; per-threshold counts are then sums over a table
    with at most one row per threshold and one more. A missing score reaches no threshold, and -0.0 counts
    as 0.0.
    """
    limits = sorted(thresholds)
    known = df.select((F.col(score).cast("double") + 0.0).alias("score"), F.col(label).alias("label")).fillna(
        float("-inf"), ["score"]
    )
    bins = Bucketizer(
        splits=[float("-inf"), *[limit + 0.0 for limit in limits], float("inf")], inputCol="score", outputCol="reached"
    ).transform(known)
    counted = bins.groupBy(F.col("reached").cast("int").alias("reached")).agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") != 1).alias("neg")
    )
    # Every threshold appears although no score may fall just above it.
    grid = df.sparkSession.range(1, len(limits) + 1).select(
        F.col("id").cast("int").alias("reached"), F.lit(0).alias("pos"), F.lit(0).alias("neg")
    )
    cells = counted.unionByName(grid).groupBy("reached").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    ascending = Window.orderBy("reached")
    below = ascending.rowsBetween(Window.unboundedPreceding, -1)
    above = ascending.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    counts = cells.select(
        F.get(F.lit(limits), F.col("reached") - 1).alias("threshold"),
        F.coalesce(F.sum("neg").over(below), F.lit(0)).alias("tn"),
        F.sum("neg").over(above).alias("fp"),
        F.coalesce(F.sum("pos").over(below), F.lit(0)).alias("fn"),
        F.sum("pos").over(above).alias("tp"),
    ).where(F.col("threshold").isNotNull())
    return with_business_cost(
        with_precision_recall_f1(counts), false_positive_cost, false_negative_cost
    ).select(*SWEEP_COLUMNS)


def best_f1_threshold(sweep: DataFrame) -> DataFrame:
    """Highest F1, the lowest threshold on ties."""
    return sweep.orderBy(F.desc("f1"), "threshold").limit(1)


def lowest_cost_threshold(sweep: DataFrame) -> DataFrame:
    """Lowest estimated cost, the lowest threshold on ties."""
    return sweep.orderBy("estimated_business_cost", "threshold").limit(1)


def nearest_threshold(sweep: DataFrame, target: float = 0.50) -> DataFrame:
    return sweep.orderBy(F.abs(F.col("threshold") - target), "threshold").limit(1)
