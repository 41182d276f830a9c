import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from steprisk.operators import metrics


def scored(spark, labels, scores):
    return spark.createDataFrame(list(zip(labels, scores)), "isFraud int, score double")


@pytest.fixture(scope="module")
def four(spark):
    return scored(spark, [0, 0, 1, 1], [0.1, 0.8, 0.9, 0.4])


def test_threshold_row(four):
    row = metrics.evaluate_threshold(four, 0.5).first()
    assert (row.tp, row.fp, row.fn, row.tn) == (1, 1, 1, 1)
    assert (row.precision, row.recall, row.f1) == (0.5, 0.5, 0.5)
    assert (row.false_positive_cost, row.false_negative_cost, row.estimated_business_cost) == (1.0, 100.0, 101.0)
    assert tuple(row.__fields__) == metrics.SWEEP_COLUMNS


def brute_auc(labels, scores):
    pos = [s for y, s in zip(labels, scores) if y]
    neg = [s for y, s in zip(labels, scores) if not y]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def brute_ap(labels, scores):
    total, before = 0.0, 0.0
    for limit in sorted(set(scores), reverse=True):
        kept = [y for y, s in zip(labels, scores) if s >= limit]
        reached = sum(kept) / sum(labels)
        total += (reached - before) * sum(kept) / len(kept)
        before = reached
    return total


@pytest.mark.parametrize("seed", range(3))
def test_ranking_metrics_match_definitions(spark, seed):
    chance = random.Random(seed)
    labels = [int(chance.random() < 0.2) for _ in range(300)]
    scores = [chance.randint(0, 40) / 40 for _ in labels]
    row = metrics.model_evaluation(scored(spark, labels, scores), 0.5).first()
    assert row.roc_auc == pytest.approx(brute_auc(labels, scores), abs=1e-12)
    assert row.pr_auc == pytest.approx(brute_ap(labels, scores), abs=1e-12)
    assert row.tp == sum(y and s >= 0.5 for y, s in zip(labels, scores))
    assert row.tn + row.fp + row.fn + row.tp == 300


def test_average_precision_is_not_the_trapezoid(spark):
    df = scored(spark, [1, 0, 1, 1, 0, 1], [0.9, 0.8, 0.7, 0.6, 0.5, 0.4])
    trapezoid = BinaryClassificationEvaluator(
        rawPredictionCol="score", labelCol="isFraud", metricName="areaUnderPR", numBins=0
    ).evaluate(df)
    exact = metrics.average_precision(df).first().pr_auc
    assert exact == pytest.approx(brute_ap([1, 0, 1, 1, 0, 1], [0.9, 0.8, 0.7, 0.6, 0.5, 0.4]))
    assert abs(trapezoid - exact) > 1e-3


def test_one_sided_labels(spark):
    only_legitimate = metrics.model_evaluation(scored(spark, [0, 0], [0.1, 0.9]), 0.5).first()
    assert (only_legitimate.roc_auc, only_legitimate.pr_auc, only_legitimate.precision) == (None, 0.0, 0.0)
    only_fraud = metrics.model_evaluation(scored(spark, [1, 1], [0.1, 0.9]), 0.5).first()
    assert (only_fraud.roc_auc, only_fraud.pr_auc, only_fraud.recall) == (None, 1.0, 0.5)


def test_all_scores_equal(spark):
    row = metrics.model_evaluation(scored(spark, [0, 1, 0, 1], [0.5] * 4), 0.5).first()
    assert (row.roc_auc, row.pr_auc, row.tp, row.fp) == (0.5, 0.5, 2, 2)


def test_per_group(spark):
    df = scored(spark, [0, 1, 1, 0], [0.1, 0.9, 0.2, 0.8]).withColumn("g", F.when(F.col("score").isin(0.1, 0.9), "a").otherwise("b"))
    assert {r.g: r.roc_auc for r in metrics.roc_auc(df, by=["g"]).collect()} == {"a": 1.0, "b": 0.0}


def test_sweep_equals_one_threshold_at_a_time(spark):
    chance = random.Random(5)
    labels = [int(chance.random() < 0.3) for _ in range(400)]
    scores = [chance.choice([*metrics.THRESHOLDS, chance.random(), 0.0, 1.0]) for _ in labels]
    df = scored(spark, [*labels, 1, 0], [*scores, float("nan"), None])
    sweep = {row.threshold: row for row in metrics.threshold_sweep(df).collect()}
    assert sorted(sweep) == sorted(metrics.THRESHOLDS) and len(sweep) == 99
    for limit in (metrics.THRESHOLDS[0], metrics.THRESHOLDS[6], metrics.THRESHOLDS[49], metrics.THRESHOLDS[98]):
        assert sweep[limit] == metrics.evaluate_threshold(df, limit).first()


def test_negative_zero_reaches_a_zero_threshold(spark):
    df = scored(spark, [1, 0, 1], [-0.0, 0.0, -1.0])
    for row in metrics.threshold_sweep(df, [0.0, 0.5]).collect():
        assert row == metrics.evaluate_threshold(df, row.threshold).first()


def test_threshold_choice_prefers_the_lowest_on_ties(spark):
    sweep = spark.createDataFrame(
        [(0.1, 0.5, 9.0), (0.2, 0.7, 3.0), (0.3, 0.7, 3.0), (0.49, 0.1, 8.0), (0.6, 0.2, 8.0)],
        "threshold double, f1 double, estimated_business_cost double",
    )
    assert metrics.best_f1_threshold(sweep).first().threshold == 0.2
    assert metrics.lowest_cost_threshold(sweep).first().threshold == 0.2
    assert metrics.nearest_threshold(sweep).first().threshold == 0.49


def test_classification_report(four):
    rows = {r["class"]: (r.precision, r.recall, r.f1, r.support) for r in metrics.classification_report(four).collect()}
    assert rows["0"] == rows["1"] == (0.5, 0.5, 0.5, 2)
    assert rows["accuracy"] == rows["macro avg"] == rows["weighted avg"] == (0.5, 0.5, 0.5, 4)


def test_heldout_record(four):
    row = metrics.heldout_performance(four, 0.5).first()
    assert (row.evaluation_window, row["rows"], row.fraud_cases) == ("held_out_current_window", 4, 2)
    assert (row.true_positives, row.false_positives, row.roc_auc) == (1, 1, 0.75)


def test_curve_with_frequent_missing_and_odd_scores(spark):
    """Frequent values have buckets of their own; missing scores come last, NaN first, groups may be NULL."""
    chance = random.Random(4)
    nan, inf = float("nan"), float("inf")
    rows = []
    for _ in range(3000):
        score = chance.choice([0.0, -0.0, 0.25, 0.25, chance.random(), round(chance.random(), 2), None, nan, inf, -inf])
        rows.append((chance.choice(["a", "b", None]), int(chance.random() < 0.3), score))
    df = spark.createDataFrame(rows, "g string, isFraud int, score double")
    got = {}
    for row in metrics.score_curve(df, by=["g"]).collect():
        key = (row.g, "nan" if row.score != row.score else row.score) if row.score is not None else (row.g, None)
        assert key not in got
        got[key] = (row.pos, row.neg, row.pos_above, row.neg_above)

    def rank(score):
        return (0, 0) if score is None else (2, 0) if score == "nan" else (1, score + 0.0)

    want = {}
    for group in ("a", "b", None):
        counts = {}
        for g, label, score in rows:
            if g == group:
                score = "nan" if score is not None and score != score else score
                found = counts.setdefault(rank(score), [score if score in (None, "nan") else score + 0.0, 0, 0])
                found[2 - label] += 1
        pos = neg = 0
        for key in sorted(counts, reverse=True):
            score, here, wrong = counts[key]
            want[group, score] = (here, wrong, pos, neg)
            pos, neg = pos + here, neg + wrong
    assert got == want


def test_curve_exchanges_detail_rows_once(spark, tmp_path):
    """One hash exchange by bucket serves counting, running totals and the join with offsets; no range shuffle, no checkpoint."""
    path = str(tmp_path / "scores")
    spark.range(50_000).selectExpr("CAST(rand(3) AS DOUBLE) AS score", "CAST(rand(4) < 0.1 AS INT) AS isFraud").write.parquet(path)
    plan = metrics.score_curve(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Scan ExistingRDD" not in plan
    assert plan.count("REPARTITION_BY_COL") == 1
    detail = plan[: plan.index("REPARTITION_BY_COL")]
    detail = detail[detail.rindex("Window") :]
    assert "Exchange" in detail and detail.count("Exchange") == 1  # between the running totals and the scan


def test_curve_of_nothing(spark):
    empty = scored(spark, [], [])
    assert metrics.score_curve(empty).collect() == []
    assert metrics.roc_auc(empty).first()[0] is None
    nothing = scored(spark, [1, 0], [None, None])
    assert [tuple(row) for row in metrics.score_curve(nothing).collect()] == [(None, 1, 1, 0, 0)]
