"""Run log: parameters and metrics of training runs as rows of a Parquet table."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

RUN_LOG = "experiment string, run_id string, run_name string, kind string, key string, value string"


def log_run(
    spark: SparkSession,
    path: str,
    experiment: str,
    run_name: str,
    params: Mapping[str, object],
    metrics: Mapping[str, object],
    run_id: str | None = None,
) -> str:
    """Append one row per parameter and metric; returns the run id."""
    run_id = run_id or uuid.uuid4().hex
    rows = [
        (experiment, run_id, run_name, kind, key, str(value))
        for kind, entries in (("param", params), ("metric", metrics))
        for key, value in entries.items()
    ]
    spark.createDataFrame(rows, RUN_LOG).coalesce(1).write.mode("append").parquet(path)
    return run_id


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG).parquet(path)
