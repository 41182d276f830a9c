"""Behavioural history from strictly earlier steps (rows of one step never see each other)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from steprisk.operators.skew import HOT, HOT_ROWS, complete, heavy_keys, skew_left_join, with_hot

ORIGIN = ["nameOrig"]
PAIR = ["nameOrig", "nameDest"]

FEATURE_COLUMNS = (
    "step", "type", "amount", "oldbalanceOrg", "oldbalanceDest", "isFraud",
    "orig_prior_txn_count", "orig_prior_amount_sum", "orig_prior_amount_mean",
    "orig_steps_since_prev_txn", "orig_account_age_steps", "amount_vs_prior_mean",
    "orig_dest_prior_txn_count", "dest_seen_before",
)

# Rows without a usable key are dealt over this many groups instead of forming one huge NULL group.
SPREAD = "_spread"
_SPREAD_GROUPS = 65_536
UNITS = "_units"


# --- amounts ---------------------------------------------------------------------------------------------------


# Column names of an amount made ready for sums.
ROUGH, PLAIN = "_rough", "_plain"
_EXACT_UNITS = float(2**33)


def summable(amount: str, scale: int | None) -> dict[str, Column]:
    """Columns whose sums ``as_amount`` turns back into a sum of amounts.

    An amount that is a whole number of units of ``10**-scale`` is counted in units, as a whole number; any other (finer,
    huge, not finite) is marked as rough. The plain double is there for both. No amount is rounded. ``None``: all rough.
    """
    plain = F.col(amount).cast("double")
    if scale is None:
        exact = plain.isNull()
        units = F.lit(None).cast("bigint")
    else:
        near = F.rint(plain * 10**scale)
        exact = plain.isNull() | ((F.abs(near) <= _EXACT_UNITS) & (near / F.lit(float(10**scale)) == plain))
        units = F.when(exact, near).cast("bigint")
    return {UNITS: units, ROUGH: F.when(exact, 0).otherwise(1), PLAIN: plain}


def as_amount(units: Column, rough: Column, plain: Column, scale: int | None) -> Column:
    """Sum of amounts; 0.0 where there is nothing to sum.

    Sums of whole units do not depend on the order in which tasks finish; with a rough amount among them, the doubles are summed.
    """
    exact = F.lit(0.0) if scale is None else units / F.lit(float(10**scale))
    return F.coalesce(F.when(rough > 0, plain).otherwise(exact), F.lit(0.0))


def spread_incomplete(keys: list[str], row_key: str) -> Column:
    return F.when(complete(keys), F.lit(0)).otherwise(
        (F.pmod(F.xxhash64(row_key), F.lit(_SPREAD_GROUPS)) + 1).cast("int")
    )


# --- grouped form: one row per key and step ---------------------------------------------------------------------


def _step_sums(df: DataFrame, amount_scale: int | None) -> DataFrame:
    ready = summable("amount", amount_scale)
    return df.groupBy("step", "nameOrig").agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(column).alias(name) for name, column in ready.items()]
    )


def origin_step_agg(df: DataFrame, amount_scale: int | None = 2) -> DataFrame:
    """Transactions and amount per (step, origin)."""
    total = as_amount(F.col(UNITS), F.col(ROUGH), F.col(PLAIN), amount_scale)
    return _step_sums(df, amount_scale).select(
        "step",
        "nameOrig",
        F.col("_n").alias("step_txn_count"),
        # an all-NULL step keeps a NULL sum
        F.when(F.col(PLAIN).isNotNull(), total).alias("step_amount_sum"),
    )


def pair_step_agg(df: DataFrame) -> DataFrame:
    """Transactions per (step, origin, destination)."""
    return df.groupBy("step", "nameOrig", "nameDest").agg(F.count(F.lit(1)).alias("pair_step_txn_count"))


def _total_over(window, amount_scale: int | None) -> Column:
    return as_amount(*[F.sum(name).over(window) for name in (UNITS, ROUGH, PLAIN)], amount_scale)


def origin_history(df: DataFrame, amount_scale: int | None = 2) -> DataFrame:
    """One row per (step, origin): totals of earlier steps, previous step, first step.

    A window group holds at most one row per step, however many rows the account has.
    """
    per_step = _step_sums(df, amount_scale)
    by_step = Window.partitionBy(*ORIGIN).orderBy(F.col("step").asc_nulls_last())
    before = by_step.rowsBetween(Window.unboundedPreceding, -1)
    return per_step.select(
        "step",
        "nameOrig",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("orig_prior_txn_count"),
        _total_over(before, amount_scale).alias("orig_prior_amount_sum"),
        F.max("step").over(before).alias("orig_previous_step"),
        F.min("step").over(by_step.rowsBetween(Window.unboundedPreceding, 0)).alias("orig_first_step"),
    )


def pair_history(df: DataFrame) -> DataFrame:
    """One row per (step, origin, destination): transactions of the pair in earlier steps."""
    before = (
        Window.partitionBy(*PAIR)
        .orderBy(F.col("step").asc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return pair_step_agg(df).select(
        "step",
        *PAIR,
        F.coalesce(F.sum("pair_step_txn_count").over(before), F.lit(0)).alias("orig_dest_prior_txn_count"),
    )


def attach_origin_history(
    df: DataFrame, history: DataFrame, row_key: str = "event_id", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """LEFT join of per-(step, origin) history; NULL keys match nothing, heavy keys are salted."""
    keys = ["step", *ORIGIN]
    (heavy,) = heavy_keys(df, [keys], hot_rows)
    return skew_left_join(df, history, keys, row_key, heavy, hot_rows)


def attach_pair_history(
    df: DataFrame, history: DataFrame, row_key: str = "event_id", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """LEFT join of per-(step, origin, destination) history; NULL keys match nothing, heavy keys are salted."""
    keys = ["step", *PAIR]
    (heavy,) = heavy_keys(df, [keys], hot_rows)
    return skew_left_join(df, history, keys, row_key, heavy, hot_rows)


# --- direct form: range windows over the detail rows --------------------------------------------------------------


def _origin_windows(df: DataFrame, row_key: str, amount_scale: int | None) -> DataFrame:
    by_step = Window.partitionBy(*ORIGIN, SPREAD).orderBy(F.col("step").asc_nulls_last())
    before = by_step.rangeBetween(Window.unboundedPreceding, -1)
    keyed = complete(["step", *ORIGIN])
    return (
        df.withColumn(SPREAD, spread_incomplete(["step", *ORIGIN], row_key))
        .withColumns(summable("amount", amount_scale))
        .withColumns(
            {
                "orig_prior_txn_count": F.when(keyed, F.count(F.lit(1)).over(before)),
                "orig_prior_amount_sum": F.when(keyed, _total_over(before, amount_scale)),
                "orig_previous_step": F.when(keyed, F.max("step").over(before)),
                "orig_first_step": F.when(
                    keyed, F.min("step").over(by_step.rangeBetween(Window.unboundedPreceding, 0))
                ),
            }
        )
        .drop(UNITS, ROUGH, PLAIN)
    )


def _pair_windows(df: DataFrame) -> DataFrame:
    before = (
        Window.partitionBy(*ORIGIN, SPREAD, "nameDest")
        .orderBy(F.col("step").asc_nulls_last())
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    return df.withColumn(
        "orig_dest_prior_txn_count",
        F.when(complete(["step", *PAIR]), F.count(F.lit(1)).over(before)),
    )


def direct_history(df: DataFrame, row_key: str = "event_id", amount_scale: int | None = 2) -> DataFrame:
    """All history columns from one exchange on the origin: both windows are satisfied by it."""
    return _pair_windows(_origin_windows(df, row_key, amount_scale)).drop(SPREAD)


def grouped_history(
    df: DataFrame,
    row_key: str = "event_id",
    amount_scale: int | None = 2,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """All history columns from per-step aggregates joined back: no window group exceeds the number of steps."""
    origin_keys, pair_keys = ["step", *ORIGIN], ["step", *PAIR]
    by_origin, by_pair = heavy_keys(df, [origin_keys, pair_keys], hot_rows)
    with_origin = skew_left_join(df, origin_history(df, amount_scale), origin_keys, row_key, by_origin, hot_rows)
    return skew_left_join(with_origin, pair_history(df), pair_keys, row_key, by_pair, hot_rows)


def step_history(
    df: DataFrame,
    row_key: str = "event_id",
    amount_scale: int | None = 2,
    plan: str = "auto",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Input rows plus ``orig_prior_txn_count``, ``orig_prior_amount_sum``, ``orig_previous_step``,
    ``orig_first_step`` and ``orig_dest_prior_txn_count``.

    ``plan``: ``direct`` (range windows), ``grouped`` (aggregate and join back) or ``auto``: direct for all
    accounts but the heavy ones, which take the grouped form. All three give the same rows.
    """
    if plan == "direct":
        return direct_history(df, row_key, amount_scale)
    if plan == "grouped":
        return grouped_history(df, row_key, amount_scale, hot_rows)
    if plan != "auto":
        raise ValueError(f"unknown plan: {plan}")
    (accounts,) = heavy_keys(df, [ORIGIN], hot_rows)
    if not accounts:
        return direct_history(df, row_key, amount_scale)
    marked = with_hot(df, ORIGIN, accounts)
    return direct_history(marked.where(~F.col(HOT)).drop(HOT), row_key, amount_scale).unionByName(
        grouped_history(marked.where(HOT).drop(HOT), row_key, amount_scale, hot_rows)
    )


# --- features on top of the history -------------------------------------------------------------------------------


def orig_prior_amount_mean() -> Column:
    return F.when(
        F.col("orig_prior_txn_count") > 0, F.col("orig_prior_amount_sum") / F.col("orig_prior_txn_count")
    ).otherwise(F.lit(0.0))


def orig_steps_since_prev_txn() -> Column:
    return F.coalesce(F.col("step") - F.col("orig_previous_step"), F.lit(-1))


def orig_account_age_steps() -> Column:
    return F.col("step") - F.col("orig_first_step")


def amount_vs_prior_mean() -> Column:
    return F.when(
        (F.col("orig_prior_txn_count") > 0) & (F.col("orig_prior_amount_sum") > 0),
        F.col("amount") / (F.col("orig_prior_amount_sum") / F.col("orig_prior_txn_count")),
    ).otherwise(F.lit(0.0))


def dest_seen_before() -> Column:
    return F.when(F.col("orig_dest_prior_txn_count") > 0, F.lit(1)).otherwise(F.lit(0))


def behavioral_features(
    df: DataFrame,
    row_key: str = "event_id",
    amount_scale: int | None = 2,
    plan: str = "auto",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The stored feature table: safe raw columns plus history of strictly earlier steps, keyed by ``row_key``.

    Ordering by step belongs to the sink (``write_features``); sorting here would only cost a second shuffle.
    """
    return (
        step_history(df, row_key, amount_scale, plan, hot_rows)
        .withColumns(
            {
                "orig_prior_amount_mean": orig_prior_amount_mean(),
                "orig_steps_since_prev_txn": orig_steps_since_prev_txn(),
                "orig_account_age_steps": orig_account_age_steps(),
                "amount_vs_prior_mean": amount_vs_prior_mean(),
                "dest_seen_before": dest_seen_before(),
            }
        )
        .select(row_key, *FEATURE_COLUMNS)
    )
