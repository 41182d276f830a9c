"""Finding heavy keys cheaply, and joining on them without a straggler task.

A key tuple is identified by its ``xxhash64``. Treating a key as heavy only changes the physical plan, never
the result, so hash collisions cannot make an answer wrong. Counts are exact: no heavy key is missed, however many there are.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of one key that a single task handles comfortably (sorts and spills included).
HOT_ROWS = 5_000_000

# A list of heavy keys up to this long is broadcast (16 MB); a longer one is joined as Spark sees fit.
BROADCAST_KEYS = 1_000_000

PARTS = "_parts"
SALT = "_salt"
_HASH = "_key_hash"
_NULL_SALTS = 65_536


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(key) for key in keys])


def complete(keys: Sequence[str]) -> Column:
    """True where no key column is NULL."""
    return reduce(and_, [F.col(key).isNotNull() for key in keys])


def heavy_keys(
    df: DataFrame, key_sets: Sequence[Sequence[str]], hot_rows: int = HOT_ROWS
) -> list[dict[int, int]]:
    """For each key set, ``{key hash: rows}`` of the keys with at least ``hot_rows`` rows.

    One column-pruned scan counts the hashes of all key sets; partial counts keep a heavy key's shuffle small. What reaches
    the driver is bounded by rows / ``hot_rows`` entries per key set: 200,000 of 16 bytes for 10**12 rows.
    """
    hashed = df.select(
        F.posexplode(F.array(*[F.when(complete(keys), key_hash(keys)) for keys in key_sets])).alias("_set", _HASH)
    )
    counts = hashed.where(F.col(_HASH).isNotNull()).groupBy("_set", _HASH).agg(F.count(F.lit(1)).alias("rows"))
    found: list[dict[int, int]] = [{} for _ in key_sets]
    for row in counts.where(F.col("rows") >= hot_rows).collect():
        found[row["_set"]][row[_HASH]] = row["rows"]
    return found


HOT = "_hot"


def with_hot(df: DataFrame, keys: Sequence[str], heavy: dict[int, int]) -> DataFrame:
    """``df`` with ``HOT``: is the key tuple complete and heavy.

    The heavy keys are joined as a table, a row each, so the plan does not grow with their number.
    """
    if not heavy:
        return df.withColumn(HOT, F.lit(False))
    parts = heavy_parts(df.sparkSession, heavy, 1).select(_HASH, F.lit(True).alias(HOT))
    parts = F.broadcast(parts) if len(heavy) <= BROADCAST_KEYS else parts
    marked = df.withColumn(_HASH, F.when(complete(keys), key_hash(keys))).join(parts, _HASH, "left").drop(_HASH)
    return marked.withColumn(HOT, F.coalesce(HOT, F.lit(False)))


def heavy_parts(spark: SparkSession, heavy: dict[int, int], hot_rows: int) -> DataFrame:
    """(hash, number of pieces) table: a row per heavy key."""
    rows = [(key, -(-count // hot_rows)) for key, count in heavy.items()]
    return spark.createDataFrame(rows, f"{_HASH} bigint, {PARTS} bigint")


def skew_left_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    row_key: str,
    heavy: dict[int, int],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """LEFT equi-join where ``right`` has one row per key and ``left`` may have very many for a few keys.

    Rows of a heavy key are dealt over ``ceil(rows / hot_rows)`` salts and the one matching right row is
    repeated once per salt. Rows with a NULL in the key match nothing and are dealt over negative salts, so
    they do not pile up in one task. Every other row has salt 0.
    """
    keys = list(keys)
    deal = F.xxhash64(row_key)
    unmatched = -1 - F.pmod(deal, F.lit(_NULL_SALTS))
    if heavy:
        parts = heavy_parts(left.sparkSession, heavy, hot_rows)
        if len(heavy) <= BROADCAST_KEYS:
            parts = F.broadcast(parts)
        left = left.withColumn(_HASH, key_hash(keys)).join(parts, _HASH, "left").drop(_HASH)
        right = right.withColumn(_HASH, key_hash(keys)).join(parts, _HASH, "left").drop(_HASH)
        matched = F.coalesce(F.pmod(deal, F.col(PARTS)), F.lit(0))
        last = F.coalesce(F.col(PARTS), F.lit(1)) - 1
        right = right.withColumn(SALT, F.explode(F.sequence(F.lit(0).cast("bigint"), last))).drop(PARTS)
    else:
        matched = F.lit(0)
        right = right.withColumn(SALT, F.lit(0).cast("bigint"))
    salted = left.withColumn(SALT, F.when(complete(keys), matched).otherwise(unmatched).cast("bigint"))
    return salted.drop(PARTS).join(right, [*keys, SALT], "left").drop(SALT)
