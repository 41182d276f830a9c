"""Adapter from the ``events`` table to the transaction schema."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Event type -> transaction type; any other event type is a TRANSFER.
EVENT_TYPES = {"signup": "CASH_IN", "click": "CASH_OUT", "view": "DEBIT", "purchase": "PAYMENT"}
OTHER_TYPE = "TRANSFER"
FIRST_DAY = date(2024, 1, 1)


def transactions_from_events(events: DataFrame) -> DataFrame:
    """One transaction per event; ``event_id`` is kept as row key and file position.

    ``step`` counts hours from the first day, starting at 1. ``ts`` has no time zone, and day and hour of such
    a timestamp do not depend on the session's.
    """
    slot = F.get_json_object("props", "$.k").cast("bigint")
    days = F.date_diff(F.col("ts").cast("date"), F.lit(FIRST_DAY))
    step = days * 24 + F.hour("ts") + 1
    kind = F.lit(OTHER_TYPE)
    for event_type, name in EVENT_TYPES.items():
        kind = F.when(F.col("event_type") == event_type, F.lit(name)).otherwise(kind)
    origin_balance = ((F.col("user_id") * 37) % 500).cast("double")
    dest_balance = ((slot * 53) % 300).cast("double")
    return events.select(
        "event_id",
        step.cast("int").alias("step"),
        kind.alias("type"),
        F.col("value").alias("amount"),
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("nameOrig"),
        origin_balance.alias("oldbalanceOrg"),
        F.greatest(origin_balance - F.col("value"), F.lit(0.0)).alias("newbalanceOrig"),
        F.concat(F.lit("M"), F.get_json_object("props", "$.k")).alias("nameDest"),
        dest_balance.alias("oldbalanceDest"),
        (dest_balance + F.col("value")).alias("newbalanceDest"),
        F.when((F.col("event_type") == "error") & (F.col("value") >= 100), 1).otherwise(0).alias("isFraud"),
        F.when(F.col("value") >= 250, 1).otherwise(0).alias("isFlaggedFraud"),
    )


def read_events_as_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return transactions_from_events(spark.read.parquet(f"{folder}/events.parquet"))
