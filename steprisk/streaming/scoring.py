"""Scoring a stream of requests with the batch operator."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from steprisk.plans.training import score_transactions
from steprisk.schema import DECISION_THRESHOLD


def score_stream(
    model: PipelineModel,
    requests: DataFrame,
    output: str,
    checkpoint: str,
    threshold: float = DECISION_THRESHOLD,
    available_now: bool = False,
) -> StreamingQuery:
    """Score a streaming DataFrame into Parquet files, exactly once, in append mode.

    Each request carries its own history, so there is no state and no watermark; ``available_now`` drains
    the source and stops.
    """
    writer = (
        score_transactions(model, requests, threshold)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()
