import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from steprisk.functions import rowfeatures
from steprisk.operators import quality
from steprisk.schema import TRANSACTIONS

VALID = (1, "TRANSFER", 100.0, "C1", 1000.0, 900.0, "C2", 500.0, 600.0, 0, 0)


def valid(spark, *more):
    return spark.createDataFrame([VALID, *more], TRANSACTIONS)


def test_schema_check(spark):
    df = valid(spark)
    assert quality.validate_schema(df) is df
    assert quality.missing_columns(df.drop("amount", "type")) == ["amount", "type"]
    assert quality.missing_columns(df.withColumnRenamed("step", "x")) == ["step"]
    with pytest.raises(ValueError, match="amount"):
        quality.validate_schema(df.drop("amount"))


def test_label_domain(spark):
    good = spark.createDataFrame([(0,), (1,), (0,), (None,)], "isFraud int")
    bad = spark.createDataFrame([(0,), (1,), (2,), (2,), (None,)], "isFraud int")
    assert quality.validate_target(good) is good
    assert quality.invalid_targets(bad).collect() == [Row(isFraud=2)]
    with pytest.raises(ValueError, match="2"):
        quality.validate_target(bad)


def test_duplicates(spark):
    assert quality.duplicate_row_count(valid(spark)).first()[0] == 0
    assert quality.duplicate_row_count(valid(spark, VALID)).first()[0] == 1
    assert quality.duplicate_row_count(valid(spark, VALID, VALID)).first()[0] == 2
    holes = spark.createDataFrame([(None, float("nan"))] * 3 + [(1, 1.0)], "a int, b double")
    assert quality.duplicate_row_count(holes).first()[0] == 2
    assert quality.duplicate_row_count(holes.limit(0)).first()[0] == 0


def test_null_counts(spark):
    df = spark.createDataFrame([(None, 1.0), ("x", float("nan")), ("y", None)], "a string, b double")
    assert {r["column"]: r["missing"] for r in quality.null_counts(df).collect()} == {"a": 1, "b": 2}


def test_quality_report(spark):
    fraud = (*VALID[:1], "PAYMENT", *VALID[2:9], 1, 0)
    report = quality.quality_report(valid(spark, VALID, fraud)).first()
    assert (report["rows"], report["columns"], report.fraud_transactions, report.legitimate_transactions) == (3, 11, 1, 2)
    assert report.duplicate_rows == 1 and abs(report.fraud_rate - 1 / 3) < 1e-12
    assert report.transaction_types == {"TRANSFER": 2, "PAYMENT": 1}
    assert set(report.missing_values.values()) == {0} and len(report.missing_values) == 11


REQUEST = (
    "step int, type string, amount double, oldbalanceOrg double, oldbalanceDest double, orig_prior_txn_count double, "
    "orig_prior_amount_mean double, orig_steps_since_prev_txn double, orig_account_age_steps double, "
    "amount_vs_prior_mean double, orig_dest_prior_txn_count double, dest_seen_before int"
)
GOOD = [100, "PAYMENT", 1000.0, 2000.0, 500.0, 2.0, 400.0, 3.0, 50.0, 2.5, 0.0, 0]


@pytest.mark.parametrize(
    "place, value, rule",
    [
        (0, 0, "step"), (1, "INVALID", "type"), (1, None, "type"), (2, -0.01, "amount"), (3, -1.0, "oldbalanceOrg"),
        (2, None, "amount"), (2, float("nan"), "amount"), (5, -1.0, "orig_prior_txn_count"),
        (8, -1.0, "orig_account_age_steps"), (11, 2, "dest_seen_before"), (11, -1, "dest_seen_before"),
    ],
)
def test_request_rules(spark, place, value, rule):
    row = list(GOOD)
    row[place] = value
    checked = quality.validate_scoring_rows(spark.createDataFrame([row], REQUEST)).first()
    assert checked.violations == [rule] and checked.valid is False


def test_valid_request_and_unconstrained_gap(spark):
    row = list(GOOD)
    row[7] = -1.0
    checked = quality.validate_scoring_rows(spark.createDataFrame([GOOD, row], REQUEST)).collect()
    assert [r.valid for r in checked] == [True, True]


def test_row_features(spark):
    df = spark.createDataFrame(
        [(25, 100.0, 1000.0, 900.0, 500.0, 600.0), (48, 10.0, -1.0, 0.0, 0.0, 0.0)],
        "step int, amount double, oldbalanceOrg double, newbalanceOrig double, oldbalanceDest double, newbalanceDest double",
    )
    first, second = rowfeatures.transaction_features(df).collect()
    assert (first.hour, first.day) == (1, 1) and (second.hour, second.day) == (0, 2)
    assert (first.orig_balance_delta, first.dest_balance_delta) == (100.0, 100.0)
    assert (first.orig_balance_error, first.dest_balance_error) == (0.0, 0.0)
    assert first.amount_to_orig_balance == 100.0 / 1001.0
    assert second.amount_to_orig_balance is None


def test_one_hot_of_unknown_and_missing_types(spark):
    df = spark.createDataFrame([("DEBIT",), ("OTHER",), (None,)], "type string")
    rows = df.select(*rowfeatures.type_one_hot()).collect()
    assert [sum(row) for row in rows] == [1, 0, 0] and rows[0].type_DEBIT == 1
    assert rowfeatures.learned_types(df) == ["DEBIT", "OTHER"]


def test_model_feature_types(features):
    single, double = rowfeatures.model_features(features), rowfeatures.model_features(features, "double")
    assert single.columns == double.columns == list(rowfeatures.MODEL_FEATURES)
    assert [kind for _, kind in single.dtypes] == ["float"] * 14 + ["int"] * 5
    assert [kind for _, kind in double.dtypes] == ["double"] * 14 + ["int"] * 5
    with pytest.raises(ValueError):
        rowfeatures.model_features(features, "int")


def test_many_bad_values_are_named_in_part(spark, monkeypatch):
    df = spark.range(5_000).select((F.col("id") / 7).alias("isFraud"))
    with pytest.raises(ValueError, match="and more") as error:
        quality.validate_target(df)
    assert len(str(error.value)) < 5_000
    monkeypatch.setattr(rowfeatures, "MOST_TYPES", 3)
    with pytest.raises(ValueError, match="more than 3 types"):
        rowfeatures.learned_types(spark.range(4).select(F.col("id").cast("string").alias("type")))


def test_duplicates_among_nulls_and_equal_zeros(spark):
    """Rows that hash alike (a null is skipped by the hash) are told apart; 0.0 and -0.0 are one value, NaN another."""
    nan = float("nan")
    rows = [(None, 1, 0.0), (1, None, 0.0), (None, 1, -0.0), (1, 1, nan), (1, 1, nan), (1, 1, nan), (None, None, None), (None, None, None), (2, 2, 2.0)]
    table = spark.createDataFrame(rows, "a int, b int, c double")
    assert quality.duplicate_row_count(table).first()[0] == 4
    assert quality.duplicate_row_count(table.limit(0)).first()[0] == 0
