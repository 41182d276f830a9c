"""Behavioural history from earlier *rows*: ties in step are ordered by the row key and do see each other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from steprisk.operators.history import (
    ORIGIN,
    PAIR,
    PLAIN,
    ROUGH,
    SPREAD,
    UNITS,
    as_amount,
    spread_incomplete,
    summable,
)
from steprisk.operators.prefix import ordered_prefix
from steprisk.operators.skew import HOT, HOT_ROWS, complete, heavy_keys, with_hot

_ONE = "_one"
_TOTALS = {f"_total{name}": name for name in (UNITS, ROUGH, PLAIN)}
_STATE = ("_count", *_TOTALS, "_previous", "_first", "_pair_count")


def _direct_state(df: DataFrame, row_key: str) -> DataFrame:
    by_row = [F.col("step"), F.col(row_key)]
    origin = Window.partitionBy(*ORIGIN, SPREAD).orderBy(*by_row)
    pair = Window.partitionBy(*ORIGIN, SPREAD, "nameDest").orderBy(*by_row)
    before = origin.rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.withColumn(SPREAD, spread_incomplete(["step", *ORIGIN], row_key))
        .withColumns(
            {
                "_count": (F.row_number().over(origin) - 1).cast("bigint"),
                **{out: F.sum(name).over(before) for out, name in _TOTALS.items()},
                "_previous": F.lag("step").over(origin),
                "_first": F.min("step").over(origin.rowsBetween(Window.unboundedPreceding, 0)),
            }
        )
        .withColumn("_pair_count", (F.row_number().over(pair) - 1).cast("bigint"))
        .drop(SPREAD)
    )


def _ranged_state(df: DataFrame, row_key: str) -> DataFrame:
    """Same columns for heavy accounts: each account is range-partitioned over many tasks."""
    by_row = [F.col("step"), F.col(row_key)]
    counted = df.withColumn(_ONE, F.lit(1).cast("bigint"))
    with_origin = ordered_prefix(
        counted, by_row, {"_count": _ONE, **_TOTALS}, ORIGIN, {"_previous": "step"}
    )
    # Only heavy accounts get here: one row per ``hot_rows`` rows of input at most.
    first = df.groupBy(*ORIGIN).agg(F.min("step").alias("_first"))
    return ordered_prefix(
        with_origin.join(first, ORIGIN, "left"), by_row, {"_pair_count": _ONE}, PAIR
    ).drop(_ONE)


def row_history(
    df: DataFrame, row_key: str = "event_id", amount_scale: int | None = 2, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """All input columns plus the row-order history columns.

    Spark rows have no input order, so ``row_key`` must be a unique, non-NULL ordinal: it breaks ties in step.
    """
    (heavy,) = heavy_keys(df, [ORIGIN], hot_rows)
    counted = df.withColumns(summable("amount", amount_scale))
    if heavy:
        # Rows without a step belong to no history and stay on the window path.
        hot = F.col(HOT) & F.col("step").isNotNull()
        marked = with_hot(counted, ORIGIN, heavy)
        state = _direct_state(marked.where(~hot).drop(HOT), row_key).unionByName(
            _ranged_state(marked.where(hot).drop(HOT), row_key)
        )
    else:
        state = _direct_state(counted, row_key)
    keyed = complete(["step", *ORIGIN])
    return (
        state.withColumns(
            {
                "orig_prior_txn_count": F.when(keyed, F.col("_count")),
                "orig_prior_amount_sum": F.when(keyed, as_amount(*[F.col(out) for out in _TOTALS], amount_scale)),
            }
        )
        .withColumn("orig_prior_amount_mean", row_prior_amount_mean())
        .withColumns(
            {
                "orig_steps_since_prev_txn": F.coalesce(F.when(keyed, F.col("step") - F.col("_previous")), F.lit(-1)),
                "orig_account_age_steps": F.when(keyed, F.col("step") - F.col("_first")),
                "amount_vs_prior_mean": row_amount_vs_prior_mean(),
                "orig_dest_prior_txn_count": F.when(complete(["step", *PAIR]), F.col("_pair_count")),
            }
        )
        .withColumn("dest_seen_before", F.coalesce((F.col("orig_dest_prior_txn_count") > 0).cast("int"), F.lit(0)))
        .drop(UNITS, ROUGH, PLAIN, *_STATE)
    )


def row_prior_amount_mean() -> Column:
    return F.when(
        F.col("orig_prior_txn_count") > 0, F.col("orig_prior_amount_sum") / F.col("orig_prior_txn_count")
    ).otherwise(F.lit(0.0))


def row_amount_vs_prior_mean() -> Column:
    """Guarded by the mean itself, unlike the step form, which checks count and sum."""
    return F.when(
        F.col("orig_prior_amount_mean") > 0, F.col("amount") / F.col("orig_prior_amount_mean")
    ).otherwise(F.lit(0.0))
