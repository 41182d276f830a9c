import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from steprisk.functions.decisions import classify, risk_level, severity
from steprisk.operators import drift, ranks


def windows(spark, reference, current, kind="double"):
    rows = [("reference", v) for v in reference] + [("current", v) for v in current]
    return spark.createDataFrame(rows, f"window string, x {kind}")


def measured(spark, reference, current):
    return drift.numeric_drift(windows(spark, reference, current), ["x"]).first()


def by_hand(reference, current, bins=10):
    """The index from pandas quantiles and explicit counting."""
    reference, current = (pd.Series(v, dtype=float).dropna() for v in (reference, current))
    if reference.empty or current.empty:
        return 0.0
    edges = sorted(set(reference.quantile(np.linspace(0, 1, bins + 1))))
    if len(edges) < 3:
        low, high = min(reference.min(), current.min()), max(reference.max(), current.max())
        if low == high:
            return 0.0
        edges = list(np.linspace(low, high, bins + 1))
    inner = edges[1:-1]

    def shares(values):
        counts = [0] * (len(inner) + 1)
        for value in values:
            counts[sum(value >= edge for edge in inner)] += 1
        return [max(count / len(values), 1e-6) for count in counts]

    return sum((c - r) * math.log(c / r) for r, c in zip(shares(reference), shares(current)))


def test_severity_bounds(spark):
    df = spark.createDataFrame([(0.0,), (0.099,), (0.10,), (0.249,), (0.25,), (0.0999999,)], "v double")
    assert [r[0] for r in df.select(severity("v")).collect()] == ["LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH", "LOW"]


def test_decisions_at_the_limits(spark):
    df = spark.createDataFrame([(0.98,), (0.97999,), (0.5,), (0.49,), (None,), (float("nan"),)], "s double")
    rows = df.select(classify("s").alias("c"), risk_level("s").alias("r")).collect()
    assert [r.c for r in rows] == ["fraud"] + ["legitimate"] * 5
    assert [r.r for r in rows] == ["HIGH", "MEDIUM", "MEDIUM", "LOW", "LOW", "LOW"]


def test_identical_windows(spark):
    values = [float(i) for i in range(1, 101)]
    assert measured(spark, values, values).value == 0.0


def test_shifted_window(spark):
    row = measured(spark, [float(i) for i in range(1000)], [float(i) for i in range(5000, 6000)])
    assert row.value >= 0.25 and row.severity == "HIGH"


@pytest.mark.parametrize("cell_rows", [5, 10**6])
@pytest.mark.parametrize("seed", range(3))
def test_index_matches_pandas(spark, monkeypatch, seed, cell_rows):
    monkeypatch.setattr(ranks, "CELL_ROWS", cell_rows)
    chance = random.Random(seed)
    reference = [chance.choice([chance.gauss(0, 1), round(chance.gauss(0, 1), 1), 0.0]) for _ in range(777)]
    current = [chance.gauss(0.3, 1.2) for _ in range(500)]
    reference[5], current[7] = None, float("nan")
    df = windows(spark, reference, current)
    edges = drift.psi_edges(df, ["x"])["x"]
    assert edges == sorted(set(pd.Series(reference, dtype=float).quantile(np.linspace(0, 1, 11))))
    value = drift.psi(drift.psi_bin_counts(df, {"x": edges})).first().psi
    assert value == pytest.approx(by_hand(reference, current), abs=1e-12)
    found = drift.BinEdges(df, ["x"])
    in_one_pass = {(r.bin, r.reference, r.current) for r in found.bin_counts().collect()}
    assert in_one_pass == {(r.bin, r.reference, r.current) for r in drift.psi_bin_counts(df, {"x": edges}).collect()}
    found.release()


@pytest.mark.parametrize(
    "reference, current",
    [
        ([3.0] * 10, [3.0] * 7),
        ([3.0] * 10, [1.0, 2.0, 9.0]),
        ([0.0, 1.0] * 20, [0.0] * 5 + [1.0] * 30),
        ([None, float("nan")], [1.0, 2.0]),
        ([1.0, 2.0], [None]),
        ([1.0, 2.0, 3.0, 4.0], [2.0, 2.0, 3.0]),
        ([5.0], [5.0, 6.0]),
    ],
)
def test_degenerate_columns(spark, reference, current):
    assert measured(spark, reference, current).value == round(by_hand(reference, current), 6)


def test_empty_bins_are_counted(spark):
    df = windows(spark, [float(i) for i in range(100)], [99.0] * 10)
    counts = drift.psi_bin_counts(df, drift.psi_edges(df, ["x"])).orderBy("bin").collect()
    assert [r.bin for r in counts] == list(range(10))
    assert [r.current for r in counts] == [0] * 9 + [10]


def test_total_variation(spark):
    df = windows(spark, ["PAYMENT"] * 100, ["TRANSFER"] * 100, "string")
    row = drift.categorical_total_variation(df, "x").first()
    assert (row.value, row.severity, row.metric) == (1.0, "HIGH", "total_variation")
    same = windows(spark, ["a", None], ["a", None, "a", None], "string")
    assert drift.categorical_total_variation(same, "x").first().value == 0.0
    holes = windows(spark, ["a", "a"], ["a", None], "string")
    assert drift.categorical_total_variation(holes, "x").first().value == 0.5


def test_score_drift(spark):
    reference, current = np.linspace(0.0, 0.2, 1000).tolist(), np.linspace(0.8, 1.0, 1000).tolist()
    row = drift.score_drift(windows(spark, reference, current).withColumnRenamed("x", "score")).first()
    assert row.feature == "model_fraud_probability" and row.value >= 0.25 and row.severity == "HIGH"


def test_overall_severity(spark):
    df = spark.createDataFrame([("LOW",), ("MEDIUM",)], "severity string")
    assert drift.overall_severity(df).first()[0] == "MEDIUM"
    assert drift.overall_severity(df.limit(0)).first()[0] == "LOW"


def test_label_shift_and_profile(spark):
    df = spark.createDataFrame(
        [("reference", 1, 0), ("reference", 2, 1), ("current", 3, 1), ("current", 4, 1)],
        "window string, step int, isFraud int",
    )
    assert tuple(drift.label_shift(df).first()) == (0.5, 1.0, 2.0)
    none_before = df.withColumn("isFraud", F.when(F.col("window") == "reference", 0).otherwise(F.col("isFraud")))
    assert drift.label_shift(none_before).first().fraud_rate_ratio == 1e12
    assert {tuple(r) for r in drift.window_profile(df).collect()} == {("reference", 2, 1, 2), ("current", 2, 3, 4)}


def test_several_features_at_once(spark):
    df = spark.createDataFrame(
        [("reference", float(i), i % 2) for i in range(50)] + [("current", float(i + 20), 1) for i in range(50)],
        "window string, a double, b int",
    )
    rows = {r.feature: r for r in drift.numeric_drift(df, ["a", "b"]).collect()}
    assert set(rows) == {"a", "b"}
    assert rows["b"].value == round(by_hand([i % 2 for i in range(50)], [1] * 50), 6)


def test_segments_have_edges_of_their_own(spark):
    """One call for all segments equals one call per segment, a NULL segment and degenerate ones included."""
    chance = random.Random(9)
    rows = []
    for segment in ("a", "b", None, "flat", "alone", "hole"):
        for window, count, shift in (("reference", 400, 0.0), ("current", 300, 0.4)):
            if segment == "alone" and window == "current":
                continue
            for _ in range(count):
                value = {"flat": 2.0, "b": float(chance.random() < 0.4 + shift / 4), "hole": None}.get(segment, chance.gauss(shift, 1))
                rows.append((segment, window, value, chance.gauss(0, 1)))
    df = spark.createDataFrame(rows, "segment string, window string, x double, y double")
    found = {(r.segment, r.feature): (r.value, r.severity) for r in drift.numeric_drift(df, ["x", "y"], by=["segment"]).collect()}
    assert len(found) == 12
    for segment in ("a", "b", None, "flat", "alone", "hole"):
        part = df.where(F.col("segment").eqNullSafe(F.lit(segment)))
        for row in drift.numeric_drift(part, ["x", "y"]).collect():
            assert found[segment, row.feature] == (row.value, row.severity)
    assert drift.numeric_drift(df.limit(0), ["x"], by=["segment"]).collect() == []


def test_quantiles_between_two_values(spark):
    """Reference of two values, current between them: the edge that is interpolated separates what lies between."""
    reference, current = [0.0] * 95 + [1.0] * 5, [0.1, 0.2, 0.5, 0.9, 0.97, 1.0, 0.0, 2.0, -1.0]
    for shift in range(6):
        ref = reference[shift:]
        assert measured(spark, ref, current).value == round(by_hand(ref, current), 6)


def test_counts_by_window_give_the_single_operators(spark):
    rows = [("reference", "a", 1, 0), ("reference", None, 2, 1), ("current", "b", 3, None), ("current", "a", 4, 1), ("current", "a", 9, 0)]
    df = spark.createDataFrame(rows, "window string, type string, step int, isFraud int")
    counts = drift.window_counts(df)
    totals = {"reference": 2, "current": 3}
    assert drift.counted_total_variation(counts, "type", totals).collect() == drift.categorical_total_variation(df).collect()
    assert drift.counted_label_shift(counts).collect() == drift.label_shift(df).collect()


def test_drift_reads_the_table_twice(spark, tmp_path):
    """One scan for sketches, one for counts; no window without a partition and nothing sorted globally."""
    path = str(tmp_path / "t")
    spark.range(20_000).selectExpr("IF(id < 12000, 'reference', 'current') AS window", "rand(1) AS x", "id % 7 AS y").write.parquet(path)
    found = drift.BinEdges(spark.read.parquet(path), ["x", "y"])
    plan = found.selector.reduced._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Window" not in plan
    assert found.selector.reduced.count() < 3_000 and not found.later
    found.release()
