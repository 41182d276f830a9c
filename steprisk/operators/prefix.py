"""Exact running totals over a globally ordered table, without a one-task window."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from steprisk.session import checkpointed

_PART = "_part"
_NULLS = "_nulls"


def ordered_prefix(
    df: DataFrame,
    order: Sequence[Column],
    sums: Mapping[str, str],
    group: Sequence[str] = (),
    maxima: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add, per ``group``, totals over the rows strictly before the current one in ``order``.

    ``sums``/``maxima`` map an output name to the column that is summed (0 before the first row) or maximised
    (NULL before the first row). ``order`` must be unique within a group. NULL is a group
    of its own.

    Rows are range-partitioned by (group, order), so even a group holding most rows spreads over many tasks.
    The partition number is fixed by a reliable checkpoint; each partition contributes one total per group it
    holds, the offsets are running totals of those, and detail rows only ever see a window of one partition.
    """
    maxima = dict(maxima or {})
    group = list(group)
    keys = [*group, _NULLS] if group else []
    ranged = checkpointed(
        _without_nulls(df, group)
        .repartitionByRange(*[F.col(name) for name in keys], *order)
        .withColumn(_PART, F.spark_partition_id())
    )
    inside = Window.partitionBy(*keys, _PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumns(
        {out: F.coalesce(F.sum(name).over(inside), F.lit(0)) for out, name in sums.items()}
        | {out: F.max(name).over(inside) for out, name in maxima.items()}
    )

    # At most one row per (group, partition): (number of partitions + number of groups) rows in all.
    earlier = Window.partitionBy(*keys).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(*keys, _PART)
        .agg(
            *[F.sum(name).alias(f"_{out}") for out, name in sums.items()],
            *[F.max(name).alias(f"_{out}") for out, name in maxima.items()],
        )
        .select(
            *keys,
            _PART,
            *[F.coalesce(F.sum(f"_{out}").over(earlier), F.lit(0)).alias(f"_{out}") for out in sums],
            *[F.max(f"_{out}").over(earlier).alias(f"_{out}") for out in maxima],
        )
    )
    # The join keys are the partitioning of the window above, so the detail rows are not shuffled again.
    joined = local.join(offsets if group else F.broadcast(offsets), [*keys, _PART], "left")
    totals = joined.withColumns(
        {out: F.col(out) + F.col(f"_{out}") for out in sums}
        | {out: F.greatest(out, f"_{out}") for out in maxima}
    )
    return _with_nulls(totals, group).select(*df.columns, *sums, *maxima)


def _without_nulls(df: DataFrame, group: Sequence[str]) -> DataFrame:
    """Group columns filled with a stand-in, and a bit mask of what was NULL: plain equality then finds NULL groups."""
    if not group:
        return df
    mask = reduce(add, [F.when(F.col(name).isNull(), 1 << i).otherwise(0) for i, name in enumerate(group)])
    filled = {}
    for name in group:
        kind = df.schema[name].dataType
        stand_in = F.lit("1970-01-01" if isinstance(kind, T.DatetimeType) else "0").cast(kind)
        filled[name] = F.coalesce(F.col(name), stand_in)
    return df.withColumn(_NULLS, mask).withColumns(filled)


def _with_nulls(df: DataFrame, group: Sequence[str]) -> DataFrame:
    return df.withColumns(
        {name: F.when(F.col(_NULLS).bitwiseAND(1 << i) == 0, F.col(name)) for i, name in enumerate(group)}
    ) if group else df
