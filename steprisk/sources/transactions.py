"""Raw transaction source."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from steprisk.operators.quality import validate_schema
from steprisk.schema import HISTORY_INPUT, TRANSACTIONS


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, columns matched by name; further columns are kept as text.

    Types come from the fixed schema, not from a sampling pass over the file.
    """
    try:
        raw = spark.read.csv(path, header=True)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no transactions at {path}") from error
        raise
    validate_schema(raw)
    return raw.withColumns({field.name: F.col(field.name).cast(field.dataType) for field in TRANSACTIONS})


def with_row_key(df: DataFrame, row_key: str = "event_id") -> DataFrame:
    """The table with a unique row number, if it has none yet: the position in its files, in order of their paths.

    Within a task numbers rise along each block of a file; the rows that precede a block are counted in one narrow scan, a row per
    block. So the number is the same however the files are split. A table that is not read from files gets numbers that are
    unique but depend on its partitions.
    """
    if row_key in df.columns:
        return df
    try:
        placed = df.select(
            "*",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_start"),
            F.monotonically_increasing_id().alias("_id"),
        )
    except AnalysisException as error:
        if not str(error.getCondition()).startswith("UNRESOLVED_COLUMN"):
            raise
        return df.withColumn(row_key, F.monotonically_increasing_id())
    blocks = placed.groupBy("_file", "_start").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    # One row per file, then one row per block of a file.
    files = blocks.groupBy("_file").agg(F.sum("_rows").alias("_rows")).select(
        "_file", F.coalesce(F.sum("_rows").over(earlier.orderBy("_file")), F.lit(0)).alias("_before")
    )
    inside = F.coalesce(F.sum("_rows").over(earlier.partitionBy("_file").orderBy("_start")), F.lit(0))
    offsets = blocks.withColumn("_inside", inside).join(files, "_file").select(
        "_file", "_start", (F.col("_before") + F.col("_inside") - F.col("_first")).alias("_offset")
    )
    return placed.join(offsets, ["_file", "_start"]).select(*df.columns, (F.col("_id") + F.col("_offset")).alias(row_key))


def typed_projection(df: DataFrame, keep: tuple[str, ...] = (), permissive: bool = False) -> DataFrame:
    """The eight history input columns with fixed types; ``permissive`` turns unreadable values into NULL."""
    def typed(name: str):
        column = F.col(name)
        kind = TRANSACTIONS[name].dataType
        return (column.try_cast(kind) if permissive else column.cast(kind)).alias(name)

    return df.select(*keep, *[typed(name) for name in HISTORY_INPUT])
