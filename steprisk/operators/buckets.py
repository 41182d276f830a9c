"""Exact running totals along a numeric column, by buckets from a quantile sketch.

A mergeable KLL sketch of the column, read in one pass, gives the ends of buckets of about equal size; a value frequent enough to
fill a bucket gets one of its own. Bucket numbers are a function of the value alone, so nothing has to be written down to keep
them. Detail rows are exchanged once, by group and bucket: equal values are then counted, and running totals formed,
within that partitioning. What lies in other buckets comes from one total per group and bucket. Rows of a bucket of
one value are not exchanged at all, only counted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import inf, isfinite, nextafter
from typing import NamedTuple

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# KLL parameter of the sketch of a single column: about 0.02 % rank error.
SKETCH = 32_768
# Rows that a bucket holds about, beyond three buckets per shuffle partition.
BUCKET_ROWS = 4_000_000
MOST_BUCKETS = 4_096

_BUCKET = "_bucket"


class Buckets(NamedTuple):
    """``edges``: bucket n holds values from edge n - 1 to below edge n; ``single``: buckets that hold just one value."""

    edges: list[float]
    single: dict[int, float]


def quantile_buckets(df: DataFrame, name: str) -> Buckets:
    """Buckets of about equal size over a double column without -0.0; missing values and NaN are left out."""
    least = 3 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = F.split(F.lit(",".join(str(place / MOST_BUCKETS) for place in range(MOST_BUCKETS + 1))), ",").cast("array<double>")
    found = df.agg(F.count(name).alias("rows"), F.kll_sketch_agg_double(name, F.lit(SKETCH)).alias("sketch"))
    # A column of nothing but NaN counts rows and leaves the sketch empty.
    quantile = F.when(F.kll_sketch_get_n_double("sketch") > 0, F.kll_sketch_get_quantile_double("sketch", shares))
    row = found.select("rows", quantile.alias("grid")).first()
    count = min(max(least, row["rows"] // BUCKET_ROWS), MOST_BUCKETS)
    values = [row["grid"][round(place * MOST_BUCKETS / count)] for place in range(count + 1)] if row["grid"] else []
    values = [value + 0.0 for value in values if isfinite(value)]
    frequent = {value for value, after in zip(values, values[1:]) if value == after}
    edges = sorted({*values, *[nextafter(value, inf) for value in frequent]} - {inf})
    return Buckets(edges, {edges.index(value) + 1: value for value in frequent})


def with_bucket(df: DataFrame, name: str, buckets: Buckets) -> DataFrame:
    """``df`` with the bucket of each value; -1 for a missing one, the last number for NaN."""
    splits = [-inf, *(buckets.edges or [0.0]), inf]
    cut = Bucketizer(splits=splits, inputCol=name, outputCol=_BUCKET, handleInvalid="keep").transform(df)
    return cut.withColumn(_BUCKET, F.coalesce(F.col(_BUCKET).cast("int"), F.lit(-1)))


def _same_cell(names: Sequence[str]) -> Column:
    condition = F.col(f"l.{_BUCKET}") == F.col(f"r.{_BUCKET}")
    for name in names:
        condition &= F.col(f"l.{name}").eqNullSafe(F.col(f"r.{name}"))
    return condition


def running_totals(
    df: DataFrame, value: str, sums: Mapping[str, str], group: Sequence[str] = (), descending: bool = False
) -> DataFrame:
    """One row per ``group`` and distinct ``value``: the sums of the columns that are keys of ``sums``, and, under the names they
    map to, their sums over the rows before, all those with a smaller value (or a larger one).

    ``value`` is a double column. Missing values come first (last if ``descending``), NaN is larger than any number. NULL is a
    group of its own.
    """
    group = list(group)
    plain = df.select(*group, (F.col(value) + 0.0).alias(value), *sums)
    buckets = quantile_buckets(plain, value)
    marked = with_bucket(plain, value, buckets)
    cell = [*group, _BUCKET]
    order = F.col(_BUCKET).desc() if descending else F.col(_BUCKET)
    earlier = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    totals = marked.groupBy(*cell).agg(*[F.sum(name).alias(name) for name in sums])
    # At most one row per group and bucket.
    offsets = totals.select(*cell, *sums, *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"_{name}") for name in sums])

    last = len(buckets.edges or [0.0]) + 1
    alone = {-1: None, last: float("nan"), **buckets.single}
    is_alone = F.col(_BUCKET).isin(list(alone))
    single = F.element_at(F.create_map(*[F.lit(x) for item in alone.items() for x in item]), F.col(_BUCKET)).cast("double")
    counted = offsets.where(is_alone).select(*group, single.alias(value), *sums, *[F.col(f"_{name}").alias(out) for name, out in sums.items()])

    ranked = F.col(value).desc() if descending else F.col(value)
    inside = Window.partitionBy(*cell).orderBy(ranked).rowsBetween(Window.unboundedPreceding, -1)
    detail = (
        marked.where(~is_alone)
        .repartition(*[F.col(name) for name in cell])
        .groupBy(*cell, value)
        .agg(*[F.sum(name).alias(name) for name in sums])
        .withColumns({out: F.coalesce(F.sum(name).over(inside), F.lit(0)) for name, out in sums.items()})
    )
    small = offsets.select(*cell, *[f"_{name}" for name in sums])
    joined = detail.alias("l").join((small if group else F.broadcast(small)).alias("r"), _same_cell(group)).select(
        *[F.col(f"l.{name}").alias(name) for name in (*group, value, *sums)],
        *[(F.col(f"l.{out}") + F.col(f"r._{name}")).alias(out) for name, out in sums.items()],
    )
    return joined.unionByName(counted)
