"""Per-row transaction features and the feature sets handed to the models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from steprisk.schema import TRANSACTION_TYPES

# The 14 columns of the leaky benchmark, in order.
LEAKY_FEATURES = (
    "step", "amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest",
    "amount_log", "orig_balance_delta", "dest_balance_delta", "orig_balance_error",
    "dest_balance_error", "amount_to_orig_balance", "hour", "day",
)

# The numeric part of the production model input, in order.
MODEL_NUMERIC = (
    "step", "amount", "oldbalanceOrg", "oldbalanceDest", "hour", "day", "amount_to_orig_balance",
    "orig_prior_txn_count", "orig_prior_amount_mean", "orig_steps_since_prev_txn",
    "orig_account_age_steps", "amount_vs_prior_mean", "orig_dest_prior_txn_count", "dest_seen_before",
)
MODEL_FEATURES = (*MODEL_NUMERIC, *[f"type_{name}" for name in TRANSACTION_TYPES])

# Numeric inputs of the leakage-safe model.
SAFE_NUMERIC = ("step", "amount", "oldbalanceOrg", "oldbalanceDest", "hour", "day", "amount_to_orig_balance")


def amount_log() -> Column:
    return F.log1p("amount")


def orig_balance_delta() -> Column:
    return F.col("oldbalanceOrg") - F.col("newbalanceOrig")


def dest_balance_delta() -> Column:
    return F.col("newbalanceDest") - F.col("oldbalanceDest")


def orig_balance_error() -> Column:
    return F.col("oldbalanceOrg") - F.col("amount") - F.col("newbalanceOrig")


def dest_balance_error() -> Column:
    return F.col("oldbalanceDest") + F.col("amount") - F.col("newbalanceDest")


def amount_to_orig_balance() -> Column:
    """NULL where the divisor is zero (balance -1)."""
    return F.try_divide(F.col("amount"), F.col("oldbalanceOrg") + 1.0)


def hour() -> Column:
    return F.pmod(F.col("step"), F.lit(24))


def day() -> Column:
    return F.floor(F.col("step") / 24).cast("int")


def type_indicator(name: str) -> Column:
    return F.coalesce((F.col("type") == name).cast("int"), F.lit(0)).alias(f"type_{name}")


# Learned types that become columns at most.
MOST_TYPES = 1_000


def type_one_hot(names: Sequence[str] = TRANSACTION_TYPES) -> list[Column]:
    """One 0/1 column per name; an unknown or NULL type is all zeros."""
    return [type_indicator(name) for name in names]


def learned_types(train: DataFrame) -> list[str]:
    """Types seen in training, sorted; each becomes a column. More than ``MOST_TYPES`` are an error, not a model's input."""
    found = train.where("type IS NOT NULL").select("type").distinct().limit(MOST_TYPES + 1).collect()
    if len(found) > MOST_TYPES:
        raise ValueError(f"more than {MOST_TYPES} types: too many to become columns")
    return sorted(row["type"] for row in found)


def transaction_features(df: DataFrame) -> DataFrame:
    """All input columns plus the eight derived ones."""
    return df.withColumns(
        {
            "amount_log": amount_log(),
            "orig_balance_delta": orig_balance_delta(),
            "dest_balance_delta": dest_balance_delta(),
            "orig_balance_error": orig_balance_error(),
            "dest_balance_error": dest_balance_error(),
            "amount_to_orig_balance": amount_to_orig_balance(),
            "hour": hour(),
            "day": day(),
        }
    )


def leaky_benchmark_features(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Benchmark only: it contains balances known after the transaction."""
    return transaction_features(df).select(*keep, *LEAKY_FEATURES)


def safe_features(df: DataFrame, types: Sequence[str] = TRANSACTION_TYPES, keep: Sequence[str] = ()) -> DataFrame:
    """Only what is known when the decision is taken. ``types`` fixes the indicator columns."""
    return df.select(
        *keep,
        "step",
        "amount",
        "oldbalanceOrg",
        "oldbalanceDest",
        hour().alias("hour"),
        day().alias("day"),
        amount_to_orig_balance().alias("amount_to_orig_balance"),
        *type_one_hot(types),
    )


def model_columns(dtype: str = "float") -> dict[str, Column]:
    """The 19 production inputs by name, in order; ``dtype`` of the numeric ones is ``float`` or ``double``."""
    if dtype not in ("float", "double"):
        raise ValueError(f"dtype must be float or double, not {dtype}")
    derived = {"hour": hour(), "day": day(), "amount_to_orig_balance": amount_to_orig_balance()}
    numeric = {name: derived.get(name, F.col(name)).cast(dtype) for name in MODEL_NUMERIC}
    return numeric | {f"type_{name}": type_indicator(name) for name in TRANSACTION_TYPES}


def model_features(df: DataFrame, dtype: str = "float", keep: Sequence[str] = ()) -> DataFrame:
    """The production inputs of each row of the stored feature table."""
    return df.select(*keep, *[column.alias(name) for name, column in model_columns(dtype).items()])


def drift_features(df: DataFrame) -> DataFrame:
    """Stored features plus the three derived columns that are also watched for drift."""
    return df.withColumns({"hour": hour(), "day": day(), "amount_to_orig_balance": amount_to_orig_balance()})
