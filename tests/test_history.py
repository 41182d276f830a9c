"""Prior-step and prior-row history against brute force, across plans, with NULL keys and hot accounts."""

import itertools
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from steprisk.operators import history
from steprisk.operators.history import FEATURE_COLUMNS, behavioral_features
from steprisk.operators.row_history import row_history

COLUMNS = "event_id bigint, step int, type string, amount double, nameOrig string, oldbalanceOrg double, " \
    "nameDest string, oldbalanceDest double, isFraud int"


def table(spark, rows):
    return spark.createDataFrame(
        [(i, step, "PAYMENT", amount, orig, 10.0, dest, 20.0, 0) for i, (step, orig, dest, amount) in enumerate(rows)],
        COLUMNS,
    )


def random_rows(seed, n, nulls):
    chance = random.Random(seed)

    def maybe(value):
        return None if nulls and chance.random() < 0.08 else value

    return [
        (
            maybe(chance.randint(1, 12)),
            maybe("hot" if chance.random() < 0.4 else f"C{chance.randint(0, 6)}"),
            maybe(f"M{chance.randint(0, 3)}"),
            maybe(chance.choice([0.0, 0.1, 0.2, 12.34, 99.99])),
        )
        for _ in range(n)
    ]


def expected(rows, prior_rows):
    """Definition of every history column, pair by pair."""
    out = {}
    for i, (step, orig, dest, amount) in enumerate(rows):
        keyed = step is not None and orig is not None
        past = [
            (s, d, a)
            for j, (s, o, d, a) in enumerate(rows)
            if keyed and o == orig and s is not None and (s < step or (prior_rows and s == step and j < i))
        ]
        same_or_past = [s for s, _, _ in past] + ([step] if keyed else [])
        n = len(past) if keyed else None
        total = float(sum((Decimal(str(a)) for _, _, a in past if a is not None), Decimal(0))) if keyed else None
        pair = sum(d == dest for _, d, _ in past) if keyed and dest is not None else None
        mean = total / n if n else 0.0
        has_base = (mean > 0) if prior_rows else bool(n and total > 0)
        out[i] = (
            n,
            total,
            mean,
            step - max(s for s, _, _ in past) if past else -1,
            step - min(same_or_past) if keyed else None,
            (None if amount is None else amount / mean) if has_base else 0.0,
            pair,
            int(bool(pair)),
        )
    return out


NAMES = FEATURE_COLUMNS[6:]


def collected(df):
    return {row["event_id"]: tuple(row[name] for name in NAMES) for row in df.select("event_id", *NAMES).collect()}


@pytest.mark.parametrize("nulls", [False, True])
@pytest.mark.parametrize(
    "options",
    [{"plan": "direct"}, {"plan": "grouped"}, {"plan": "grouped", "hot_rows": 5}, {"plan": "auto", "hot_rows": 30}],
    ids=str,
)
def test_step_history_matches_definition(spark, nulls, options):
    rows = random_rows(7, 220, nulls)
    assert collected(behavioral_features(table(spark, rows), **options)) == expected(rows, prior_rows=False)


@pytest.mark.parametrize("nulls", [False, True])
@pytest.mark.parametrize("hot_rows", [30, 10_000])
def test_row_history_matches_definition(spark, nulls, hot_rows):
    rows = random_rows(11, 220, nulls)
    assert collected(row_history(table(spark, rows), hot_rows=hot_rows)) == expected(rows, prior_rows=True)


def test_row_history_hand_made(spark):
    df = table(spark, [(1, "A", "X", 100.0), (2, "A", "Y", 200.0), (3, "A", "X", 300.0)])
    rows = row_history(df).orderBy("event_id").collect()
    assert [r.orig_prior_txn_count for r in rows] == [0, 1, 2]
    assert [r.orig_prior_amount_sum for r in rows] == [0.0, 100.0, 300.0]
    assert [r.orig_prior_amount_mean for r in rows] == [0.0, 100.0, 150.0]
    assert [r.orig_steps_since_prev_txn for r in rows] == [-1, 1, 1]
    assert [r.orig_dest_prior_txn_count for r in rows] == [0, 0, 1]
    assert [r.dest_seen_before for r in rows] == [0, 0, 1]
    assert set(df.columns) <= set(row_history(df).columns)


def test_account_age(spark):
    df = table(spark, [(5, "A", "X", 10.0), (7, "A", "Y", 20.0), (10, "A", "Z", 30.0)])
    for result in (row_history(df), behavioral_features(df)):
        assert [r.orig_account_age_steps for r in result.orderBy("event_id").collect()] == [0, 2, 5]


def test_ties_are_where_the_two_forms_differ(spark):
    tied = table(spark, [(1, "A", "X", 1.0), (1, "A", "X", 2.0), (2, "A", "X", 3.0)])
    by_step = behavioral_features(tied).orderBy("event_id").collect()
    by_row = row_history(tied).orderBy("event_id").collect()
    assert [r.orig_prior_txn_count for r in by_step] == [0, 0, 2]
    assert [r.orig_prior_txn_count for r in by_row] == [0, 1, 2]
    assert [r.orig_steps_since_prev_txn for r in by_row] == [-1, 0, 1]


def test_zero_prior_amounts_give_zero_mean_and_ratio(spark):
    df = table(spark, [(1, "A", "X", 0.0), (2, "A", "X", 5.0)])
    last = behavioral_features(df).orderBy("event_id").collect()[1]
    assert (last.orig_prior_txn_count, last.orig_prior_amount_mean, last.amount_vs_prior_mean) == (1, 0.0, 0.0)


def test_later_rows_never_leak(spark, tx):
    """Dropping everything from a step on leaves the features of earlier rows, and of that step, unchanged."""
    cut = 300
    whole = behavioral_features(tx).where(F.col("step") <= cut)
    changed = tx.where(F.col("step") <= cut).withColumn(
        "amount", F.when(F.col("step") == cut, F.col("amount") * 7).otherwise(F.col("amount"))
    )
    part = behavioral_features(changed)
    own = ["amount", "amount_vs_prior_mean"]
    assert whole.drop(*own).exceptAll(part.drop(*own)).isEmpty()
    assert part.drop(*own).exceptAll(whole.drop(*own)).isEmpty()
    before = F.col("step") < cut
    assert whole.where(before).exceptAll(part.where(before)).isEmpty()


def test_plain_double_sums(spark, tx):
    scaled = behavioral_features(tx).select("event_id", F.col("orig_prior_amount_sum").alias("a"))
    plain = behavioral_features(tx, amount_scale=None).select("event_id", F.col("orig_prior_amount_sum").alias("b"))
    assert scaled.join(plain, "event_id").where(F.abs(F.col("a") - F.col("b")) > 1e-6).isEmpty()


@pytest.mark.parametrize("plan", ["direct", "grouped", "rows", "hot rows"])
def test_no_amount_is_rounded(spark, plan):
    """Fine, huge and non-finite amounts are summed as they are, beside exact sums of whole cents."""
    nan = float("nan")
    amounts = {"F": [0.004] * 4, "H": [1e18, 1.0, 2.0], "N": [nan, 1.0, 1.0], "C": [0.1, 0.2, 0.3, 0.4]}
    df = table(spark, [(n + 1, orig, "M", a) for orig, values in amounts.items() for n, a in enumerate(values)])
    if plan in ("direct", "grouped"):
        found = history.step_history(df, plan=plan)
    else:
        found = row_history(df, hot_rows=2 if plan == "hot rows" else 100)
    got = {}
    for row in found.orderBy("step").collect():
        got.setdefault(row["nameOrig"], []).append(row["orig_prior_amount_sum"])
    assert got["F"] == pytest.approx([0.0, 0.004, 0.008, 0.012])
    assert got["H"] == [0.0, 1e18, 1e18] and got["N"][0] == 0.0 and got["N"][1] != got["N"][1]
    assert got["C"] == [0.0, 0.1, 0.3, 0.6]


def test_step_aggregates(spark):
    rows = [(1, "A", "X", 1.5), (1, "A", "Y", None), (2, "A", "X", None), (1, "B", "X", 2.0)]
    df = table(spark, rows)
    got = {(r.step, r.nameOrig): (r.step_txn_count, r.step_amount_sum) for r in history.origin_step_agg(df).collect()}
    assert got == {(1, "A"): (2, 1.5), (2, "A"): (1, None), (1, "B"): (1, 2.0)}
    pairs = {(r.step, r.nameOrig, r.nameDest): r.pair_step_txn_count for r in history.pair_step_agg(df).collect()}
    assert pairs == {key: 1 for key in [(1, "A", "X"), (1, "A", "Y"), (2, "A", "X"), (1, "B", "X")]}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_direct_plan_has_one_exchange(tx):
    plan = plan_of(history.direct_history(tx.select(*tx.columns)))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "SinglePartition" not in plan


def test_no_single_partition_windows(spark, tx):
    for df in itertools.chain(
        [history.grouped_history(tx, hot_rows=20), row_history(tx, hot_rows=20), behavioral_features(tx, hot_rows=20)]
    ):
        assert "SinglePartition" not in plan_of(df)


def test_unknown_plan(tx):
    with pytest.raises(ValueError):
        behavioral_features(tx, plan="other")
