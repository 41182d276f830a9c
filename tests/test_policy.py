import pytest

from steprisk.operators import policy
from steprisk.plans.lifecycle import retraining_trigger
from steprisk.schema import DRIFT_REPORT


def decide(spark, severity, ratio, pr_auc):
    df = spark.createDataFrame([(severity, ratio, pr_auc)], "score_severity string, fraud_rate_ratio double, pr_auc double")
    return policy.retraining_policy(df).first()


@pytest.mark.parametrize(
    "severity, ratio, pr_auc, reasons",
    [
        ("HIGH", 0.8, 0.99, [policy.SCORE_DRIFT_REASON]),
        (None, 7.5, 0.99, [policy.PREVALENCE_REASON]),
        ("LOW", 1.3, 0.99, []),
        # The published limits themselves.
        ("LOW", 2.0, 0.99, [policy.PREVALENCE_REASON]),
        ("LOW", 1.3, 0.90, []),
        ("MEDIUM", None, None, [policy.PR_AUC_REASON]),
        ("HIGH", 9.0, 0.1, [policy.SCORE_DRIFT_REASON, policy.PREVALENCE_REASON, policy.PR_AUC_REASON]),
    ],
)
def test_retraining_rules(spark, severity, ratio, pr_auc, reasons):
    row = decide(spark, severity, ratio, pr_auc)
    assert row.reasons == reasons
    assert row.retraining_recommended is bool(reasons)
    assert row.severity == ("HIGH" if reasons else "LOW")
    assert row.auto_promotion_allowed is False


def judge(spark, champion, candidate):
    names = ["pr_auc", "recall", "precision", "fp"][: len(champion)]
    schema = ", ".join(
        f"{side}_{name} {'bigint' if name == 'fp' else 'double'}" for side in ("champion", "candidate") for name in names
    )
    return policy.promotion_gate(spark.createDataFrame([(*champion, *candidate)], schema)).first()


@pytest.mark.parametrize(
    "champion, candidate, reasons",
    [
        ((0.61, 0.70), (0.66, 0.74), []),
        ((0.66, 0.70), (0.61, 0.74), [policy.GAIN_REASON]),
        ((0.70, 0.80), (0.75, 0.60), [policy.RECALL_REASON]),
        ((0.70, 0.80, 0.90, 40), (0.75, 0.85, 0.60, 44), [policy.PRECISION_REASON]),
        ((0.70, 0.80, 0.90, 40), (0.75, 0.85, 0.89, 400), [policy.FALSE_POSITIVE_REASON]),
        ((0.97, 0.88, 0.95, 75), (0.97, 0.88, 0.95, 150), []),
        ((0.97, 0.88, 0.95, 0), (0.97, 0.88, 0.95, 3), [policy.FALSE_POSITIVE_REASON]),
        ((None, None, None, None), (None, None, None, None), []),
    ],
)
def test_promotion_rules(spark, champion, candidate, reasons):
    row = judge(spark, champion, candidate)
    assert row.reasons == reasons
    assert row.promotion_recommended is (not reasons)
    assert row.decision == ("KEEP_PRODUCTION" if reasons else "CANDIDATE_APPROVED_FOR_REVIEW")


def test_reason_wording():
    assert "precision degradation" in policy.PRECISION_REASON
    assert "false-positive increase" in policy.FALSE_POSITIVE_REASON


# The published monitoring figures.
def test_published_trigger(spark):
    """Score drift HIGH, fraud ratio 4.2191 and PR-AUC 0.974028 call for retraining, with two reasons."""
    report = spark.createDataFrame(
        [
            {
                "metrics": [
                    {"feature": "step", "metric": "PSI", "value": 12.365809, "severity": "HIGH"},
                    {"feature": "model_fraud_probability", "metric": "PSI", "value": 0.755221, "severity": "HIGH"},
                ],
                "label_monitoring": {"fraud_rate_ratio": 4.2191},
                "heldout_performance": {"pr_auc": 0.974028},
            }
        ],
        DRIFT_REPORT,
    )
    row = retraining_trigger(report).first()
    assert row.retraining_recommended and row.reasons == [policy.SCORE_DRIFT_REASON, policy.PREVALENCE_REASON]


def test_trigger_without_score_metric(spark):
    report = spark.createDataFrame(
        [{"metrics": [], "label_monitoring": {"fraud_rate_ratio": 1.0}, "heldout_performance": {"pr_auc": 0.95}}],
        DRIFT_REPORT,
    )
    assert retraining_trigger(report).first().retraining_recommended is False


def test_published_gate(spark):
    row = judge(
        spark,
        (0.9867968501532285, 0.8713080168776371, 0.9640522875816994, 77),
        (0.9901345330975938, 0.9966244725738397, 0.8829906542056075, 313),
    )
    assert row.decision == "KEEP_PRODUCTION"
    assert row.reasons == [policy.PRECISION_REASON, policy.FALSE_POSITIVE_REASON]
