"""Report and table sinks for small results."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def write_report(report: DataFrame, path: str) -> None:
    """One-row report as JSON."""
    report.coalesce(1).write.mode("overwrite").json(path)


def read_report(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON report with a known schema; multi-line documents are accepted."""
    try:
        return spark.read.schema(schema).json(path, multiLine=True)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no report at {path}") from error
        raise


def write_threshold_table(sweep: DataFrame, path: str) -> None:
    """CSV with a header, one file, thresholds ascending (99 rows by default)."""
    sweep.coalesce(1).sortWithinPartitions("threshold").write.mode("overwrite").csv(path, header=True)


def read_threshold_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True)
