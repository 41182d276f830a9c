"""What the operators share: the word rule, table access and lineage cuts."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from steprisk.session import findable, shared_folder

# Words are runs of anything but space, tab, line feed, vertical tab, form feed and carriage return. ``bytes.split()``
# splits on exactly these six, so a UTF-8 text splits into the same words in Python as by this pattern.
WORD = "[^ \\t-\\r]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    findable(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``."""
    return f"{shared_folder(spark)}/steprisk-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back: cuts the lineage, survives executors."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def free_name(name: str, taken: list[str]) -> str:
    """``name``, with underscores added until no column of ``taken`` is called so (in any case)."""
    lower = {other.lower() for other in taken}
    while name.lower() in lower:
        name += "_"
    return name


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mixed(values: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit multiplicative hash (every input bit reaches every output bit)."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))
