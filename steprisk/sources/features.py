"""Feature table sink and source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_features(df: DataFrame, path: str, row_key: str = "event_id", global_order: bool = True) -> None:
    """Parquet, ZSTD, ordered by step over all files, so that step predicates skip whole files and row groups.

    The table is range-partitioned by step; the row key takes part in the boundaries, so a step holding very many rows is
    split over several files. ``global_order=False`` saves that shuffle and orders each file by itself: every file then
    spans most steps, and only row groups of large files can be skipped.
    """
    if global_order:
        df = df.repartitionByRange("step", row_key)
    (
        df.sortWithinPartitions("step")
        .write.mode("overwrite")
        .option("compression", "zstd")
        .parquet(path)
    )


def read_window(
    spark: SparkSession, path: str, predicate: Column | str | None = None, columns: Sequence[str] = ()
) -> DataFrame:
    """Stored features restricted to some rows and columns; both reach the Parquet scan."""
    table = spark.read.parquet(path)
    if predicate is not None:
        table = table.where(predicate)
    return table.select(*columns) if columns else table


def output_summary(table: DataFrame) -> DataFrame:
    return table.agg(
        F.count(F.lit(1)).alias("rows"), F.min("step").alias("min_step"), F.max("step").alias("max_step")
    )
