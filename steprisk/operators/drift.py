"""Distribution drift between a reference and a current window.

Input tables carry a ``window`` column with the values ``reference`` and ``current`` (see ``fixed_windows``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from math import floor
from operator import add, and_
from typing import NamedTuple

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from steprisk.functions.decisions import severity, worst_severity
from steprisk.operators.ranks import Selector, attach, folded, grid, local, long_rows, present, selector, sketched_ranges

BINS = 10
# Smallest share used for an empty bin, name of the score metric.
EMPTY_SHARE = 1e-6
SCORE_FEATURE = "model_fraud_probability"

_SIDES = ("reference", "current")


def _in_window(name: str) -> Column:
    return F.col("window") == name


# --- bin edges ---------------------------------------------------------------------------------------------------


def _values(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """The window and the features as doubles: NaN is missing, -0.0 is 0.0."""
    return df.select("window", *[(present(df, name).cast("double") + 0.0).alias(name) for name in features])


def _between(low: float, high: float, share: float) -> float:
    """Linear interpolation, evaluated from the nearer end."""
    return low + (high - low) * share if share < 0.5 else high - (high - low) * (1 - share)


def equal_width_edges(low: float, high: float, bins: int = BINS) -> list[float]:
    """``bins + 1`` equally spaced edges; none when the range is a single value."""
    if low == high:
        return []
    width = (high - low) / bins
    return sorted({low + i * width for i in range(bins)} | {high})


class _Side(NamedTuple):
    """What the sketching pass tells of one feature (in one segment)."""

    reference: int
    current: int
    low: float
    high: float
    grid: Sequence[float] | None


class BinEdges:
    """Distinct bin edges per (segment, feature), and the reduced table they were found in.

    Reference quantiles; with fewer than three distinct ones, equal widths over both windows; no edges where no drift can be
    measured (one side empty, or a single value everywhere). Two scans: a sketch per segment and feature, then the counts
    that give both the exact quantiles and the rows of either window between them.
    """

    def __init__(self, df: DataFrame, features: Sequence[str], bins: int = BINS, by: Sequence[str] = ()):
        self.keys = [*by, "feature"]
        sides = [_in_window(name).cast("bigint").alias(name) for name in _SIDES]
        self.long = long_rows(df.where(F.col("window").isin(*_SIDES)), list(features), [*[F.col(name) for name in by], *sides])
        sketched = grid(F.when(F.col("reference") == 1, F.col("value")))
        rows = self.long.groupBy(*self.keys).agg(
            *[F.sum(name).alias(name) for name in _SIDES], F.min("value").alias("low"), F.max("value").alias("high"), sketched.alias("grid")
        )
        self.sides = {
            tuple(row[key] for key in self.keys): _Side(*[row[name] for name in _Side._fields]) for row in rows.collect()
        }
        usable = {key: side for key, side in self.sides.items() if side.reference and side.current}
        self.bins, self.shares = bins, [i * (1 / bins) for i in range(bins)] + [1.0]
        self.selector: Selector | None = None
        self.edges: dict[tuple, list[float]] = {key: [] for key in self.sides}
        # Edges that the selector's stretches do not end at, so that rows must be counted once more.
        self.later: set[tuple] = set()
        if usable:
            self._find(usable)

    def _spots(self, rows: int) -> list[tuple[int, int]]:
        return [(floor((rows - 1) * share), min(floor((rows - 1) * share) + 1, rows - 1)) for share in self.shares]

    def _ranges(self, side: _Side, margin: float) -> list[tuple[float, float]]:
        """Ranges that hold the quantiles; single points where the sketch already shows that edges are of equal width."""
        found = sketched_ranges(side.grid, side.reference, self._spots(side.reference), margin)
        values = {value for ends in found for value in ends}
        if all(low == high for low, high in found) and len(values) < 3:
            return [(value, value) for value in sorted(values.union(equal_width_edges(side.low, side.high, self.bins)))]
        return found

    def _find(self, usable: Mapping[tuple, _Side]) -> None:
        spots = {key: self._spots(side.reference) for key, side in usable.items()}
        ends: dict[tuple, list[tuple[float, float]]] = {}

        def ranges(margin: float) -> dict[tuple, list[tuple[float, float]]]:
            ends.update({key: self._ranges(side, margin) for key, side in usable.items()})
            return ends

        self.selector = selector(self.long, self.keys, ranges, spots, _SIDES)
        values = self.selector.values({key: [rank for spot in found for rank in spot] for key, found in spots.items()})
        for key, side in usable.items():
            places = [(side.reference - 1) * share for share in self.shares]
            found = [_between(values[key][first], values[key][last], place - first) for place, (first, last) in zip(places, spots[key])]
            distinct = sorted(set(found))
            if len(distinct) < 3:
                distinct = equal_width_edges(side.low, side.high, self.bins)
                if not {(edge, edge) for edge in distinct} <= set(ends[key]):
                    self.later.add(key)
            self.edges[key] = distinct if len(distinct) >= 3 else []

    def bin_counts(self) -> DataFrame:
        """(keys, bin, reference, current) for every bin, empty ones included."""
        spark = self.long.sparkSession
        number = {(*key, bin): [0, 0] for key, found in self.edges.items() for bin in range(len(found) - 1)}
        now = {key: found for key, found in self.edges.items() if found and key not in self.later}
        again = {key: found for key, found in self.edges.items() if found and key in self.later}
        tables = [(self.selector.reduced, now)] if now else []
        if again:
            points = {key: [(edge, edge) for edge in found] for key, found in again.items()}
            tables.append((folded(self.long, self.keys, points, _SIDES), again))
        for table, edges in tables:
            for row in _binned(table, self.keys, edges).collect():
                number[(*[row[key] for key in self.keys], row["bin"])] = [row[name] for name in _SIDES]
        schema = T.StructType(
            [self.long.schema[key] for key in self.keys]
            + [T.StructField("bin", T.IntegerType()), *[T.StructField(name, T.LongType()) for name in _SIDES]]
        )
        return local(spark, [(*key, *counts) for key, counts in number.items()], schema)

    def release(self) -> None:
        if self.selector:
            self.selector.release()


def _binned(reduced: DataFrame, keys: Sequence[str], edges: Mapping[tuple, Sequence[float]]) -> DataFrame:
    """Rows of either window per bin. A folded stretch lies in one bin, that of its least value."""
    schema = T.StructType([reduced.schema[key] for key in keys] + [T.StructField("inner", T.ArrayType(T.DoubleType()))])
    table = local(reduced.sparkSession, [(*key, [edge + 0.0 for edge in found[1:-1]]) for key, found in edges.items()], schema)
    most = max(len(found) - 2 for found in edges.values())
    value = F.coalesce("value", "low")
    bin = reduce(add, [F.coalesce((value >= F.get("inner", F.lit(n))).cast("int"), F.lit(0)) for n in range(most)])
    return (
        attach(reduced, table, keys, ["inner"])
        .groupBy(*keys, bin.alias("bin"))
        .agg(*[F.sum(name).alias(name) for name in _SIDES])
    )


def psi_edges(df: DataFrame, features: Sequence[str], bins: int = BINS) -> dict[str, list[float]]:
    """Distinct bin edges per feature, before the outer two are opened to infinity (see ``BinEdges``)."""
    found = BinEdges(df, features, bins)
    found.release()
    return {name: found.edges.get((name,), []) for name in features}


def edges_table(spark: SparkSession, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """(feature, position, edge) rows: at most ``bins + 1`` per feature."""
    rows = [(name, i, float(edge)) for name, found in edges.items() for i, edge in enumerate(found)]
    return spark.createDataFrame(rows, "feature string, position int, edge double")


# --- population stability ----------------------------------------------------------------------------------------


def psi_bin_counts(df: DataFrame, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """(feature, bin, reference, current) for every bin, empty ones included.

    All features are binned in one scan (half-open bins, outer ones unbounded) and counted together; what is
    shuffled is at most one row per feature and bin from each task. The bin search would tell -0.0 from 0.0,
    so neither values nor edges hold it.
    """
    spark = df.sparkSession
    names = [name for name, found in edges.items() if found]
    grid = spark.createDataFrame(
        [(name, i) for name in names for i in range(len(edges[name]) - 1)], "feature string, bin int"
    )
    if not names:
        return grid.select("feature", "bin", F.lit(0).alias("reference"), F.lit(0).alias("current"))
    bins = Bucketizer(
        splitsArray=[[float("-inf"), *[edge + 0.0 for edge in edges[name][1:-1]], float("inf")] for name in names],
        inputCols=names,
        outputCols=[f"{name}:bin" for name in names],
        handleInvalid="keep",
    ).transform(_values(df, names))
    counted = (
        bins.select("window", *[F.col(f"{name}:bin").cast("int").alias(name) for name in names])
        .unpivot(["window"], names, "feature", "bin")
        .where(F.col("bin").isNotNull())
        .groupBy("feature", "bin")
        .agg(
            F.count_if(_in_window("reference")).alias("reference"),
            F.count_if(_in_window("current")).alias("current"),
        )
    )
    return grid.join(F.broadcast(counted), ["feature", "bin"], "left").fillna(0, ["reference", "current"])


def psi(bin_counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, feature, psi) from complete bin counts; shares are floored, not re-normalised."""
    keys = [*by, "feature"]
    feature = Window.partitionBy(*keys)

    def share(side: str) -> Column:
        return F.greatest(F.col(side) / F.greatest(F.sum(side).over(feature), F.lit(1)), F.lit(EMPTY_SHARE))

    return (
        bin_counts.select(*keys, share("reference").alias("expected"), share("current").alias("actual"))
        .groupBy(*keys)
        .agg(F.sum((F.col("actual") - F.col("expected")) * F.log(F.col("actual") / F.col("expected"))).alias("psi"))
    )


def numeric_drift(df: DataFrame, features: Sequence[str], bins: int = BINS, by: Sequence[str] = ()) -> DataFrame:
    """(by, feature, metric, value, severity): PSI rounded to 6, severity from the unrounded value.

    Two scans for all features and segments together. ``by``: columns whose values are segments, each with edges of its
    own; a segment without any value does not appear. Per segment and feature a few summary rows come to the driver.
    """
    features, by = list(features), list(by)
    found = BinEdges(df, features, bins, by)
    measured = psi(found.bin_counts(), by)
    found.release()
    segments = {key[:-1]: None for key in found.sides} if by else {(): None}
    schema = T.StructType([found.long.schema[key] for key in found.keys])
    names = local(df.sparkSession, [(*segment, name) for segment in segments for name in features], schema)
    value = F.coalesce("psi", F.lit(0.0))
    equal = reduce(and_, [F.col(f"n.{key}").eqNullSafe(F.col(f"m.{key}")) for key in found.keys])
    return names.alias("n").join(F.broadcast(measured).alias("m"), equal, "left").select(
        *[F.col(f"n.{key}").alias(key) for key in found.keys],
        F.lit("PSI").alias("metric"), F.round(value, 6).alias("value"), severity(value).alias("severity"),
    )


def score_drift(df: DataFrame, score: str = "score", bins: int = BINS, by: Sequence[str] = ()) -> DataFrame:
    return numeric_drift(df.withColumnRenamed(score, SCORE_FEATURE), [SCORE_FEATURE], bins, by)


# --- categories, labels, windows ---------------------------------------------------------------------------------


def window_counts(df: DataFrame, feature: str = "type", label: str = "isFraud") -> DataFrame:
    """(window, category, rows, labelled, positive, min_step, max_step): one narrow scan for all that is counted per window.

    A missing category is one of its own.
    """
    category = F.coalesce(F.col(feature).cast("string"), F.lit("nan"))
    return df.groupBy("window", category.alias("category")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(label).alias("labelled"),
        F.sum(label).alias("positive"),
        F.min("step").alias("min_step"),
        F.max("step").alias("max_step"),
    )


def _variation(per_category: DataFrame, feature: str, totals: Mapping[str, int]) -> DataFrame:
    """Half the sum of share differences over categories (``reference``, ``current``: rows)."""
    shares = [F.col(side) / F.lit(max(totals[side], 1)) for side in _SIDES]
    return per_category.agg(F.coalesce(F.sum(F.abs(shares[0] - shares[1])) / 2, F.lit(0.0)).alias("distance")).select(
        F.lit(feature).alias("feature"),
        F.lit("total_variation").alias("metric"),
        F.round("distance", 6).alias("value"),
        severity("distance").alias("severity"),
    )


def counted_total_variation(counts: DataFrame, feature: str, totals: Mapping[str, int]) -> DataFrame:
    """``categorical_total_variation`` of ``window_counts``."""
    sides = [F.coalesce(F.sum(F.when(_in_window(side), F.col("rows"))), F.lit(0)).alias(side) for side in _SIDES]
    return _variation(counts.groupBy("category").agg(*sides), feature, totals)


def categorical_total_variation(df: DataFrame, feature: str = "type") -> DataFrame:
    """(feature, metric, value, severity): half the sum of share differences over all categories.

    One count per category and window aligns both sides; a missing category is a category of its own. The rows per window are
    sums over that count, taken beside it, so that the table is read once and no window over the categories is needed.
    """
    category = F.coalesce(F.col(feature).cast("string"), F.lit("nan"))
    counts = df.groupBy(category.alias("category")).agg(*[F.count_if(_in_window(side)).alias(side) for side in _SIDES])
    totals = counts.agg(*[F.greatest(F.sum(side), F.lit(1)).alias(f"{side}_rows") for side in _SIDES])
    shares = [F.col(side) / F.col(f"{side}_rows") for side in _SIDES]
    distance = F.coalesce(F.sum(F.abs(shares[0] - shares[1])) / 2, F.lit(0.0))
    # One row beside each: the totals are a single row.
    return counts.join(F.broadcast(totals)).agg(distance.alias("distance")).select(
        F.lit(feature).alias("feature"),
        F.lit("total_variation").alias("metric"),
        F.round("distance", 6).alias("value"),
        severity("distance").alias("severity"),
    )


def overall_severity(metrics: DataFrame) -> DataFrame:
    """The worst severity of a metric table, LOW when it is empty."""
    return metrics.agg(worst_severity("severity").alias("overall_severity"))


def _shift(rates: DataFrame) -> DataFrame:
    return rates.select(
        F.round("reference_rate", 8).alias("reference_fraud_rate"),
        F.round("current_rate", 8).alias("current_fraud_rate"),
        F.round(F.col("current_rate") / F.greatest("reference_rate", F.lit(1e-12)), 4).alias("fraud_rate_ratio"),
    )


def label_shift(df: DataFrame, label: str = "isFraud") -> DataFrame:
    """Fraud rate per window (8 digits) and their ratio (4 digits), the ratio from unrounded rates."""
    return _shift(df.agg(*[F.avg(F.when(_in_window(side), F.col(label))).alias(f"{side}_rate") for side in _SIDES]))


def counted_label_shift(counts: DataFrame) -> DataFrame:
    """``label_shift`` of ``window_counts``."""

    def rate(side: str) -> Column:
        return F.try_divide(F.sum(F.when(_in_window(side), F.col("positive"))), F.sum(F.when(_in_window(side), F.col("labelled"))))

    return _shift(counts.agg(*[rate(side).alias(f"{side}_rate") for side in _SIDES]))


def window_profile(df: DataFrame) -> DataFrame:
    """Rows, first and last step of each window."""
    return df.groupBy("window").agg(
        F.count(F.lit(1)).alias("rows"), F.min("step").alias("min_step"), F.max("step").alias("max_step")
    )
