"""Session helpers: the shared checkpoint folder and lineage cuts."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local master without that setting gets a temporary folder; a cluster session must name one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="steprisk-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def findable(spark: SparkSession) -> None:
    """Lets Python workers import this package when the driver runs from its source folder."""
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    places = spark.sparkContext.environment.get("PYTHONPATH", "")
    if home not in places.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [home, places]))


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` on reliable storage and drop its lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
