"""Chronological splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from steprisk.operators.ranks import present, values_at_ranks
from steprisk.schema import REFERENCE_END_STEP


_WHOLE = (T.IntegralType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _as_number(df: DataFrame, name: str) -> Column:
    """A date as days and a timestamp as microseconds, so that any time column can be ranked as a number."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(name).cast("bigint")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(name)
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(F.convert_timezone(F.lit("UTC"), F.lit("UTC"), F.col(name)).cast("timestamp"))
    return F.col(name)


def cutoff_row(df: DataFrame, fraction: float, time_column: str = "step") -> dict | None:
    """``time_column`` at 0-based position ``int(rows * fraction)`` of the sorted column, that position, and whether rows lie before it.

    Two levels of counting replace a sort and a window over all times: rows per range of times, then the times of the range
    that holds the position (``ranks``). Rows without a time are left out; NULL for a table without times.
    """
    timed = df.where(present(df, time_column).isNotNull())
    number = _as_number(df, time_column)
    if isinstance(df.schema[time_column].dataType, _WHOLE):
        number = number.cast("bigint")
    numbers = timed.select(number.alias("at"))
    told = {}

    def position(rows: int) -> int:
        told["rows"] = rows
        return int(rows * fraction)

    found = values_at_ranks(numbers, {"at": [position, lambda rows: 0]})["at"]
    if not found:
        return None
    rank = int(told["rows"] * fraction)
    value = found[rank]
    kind = df.schema[time_column].dataType
    if not isinstance(kind, T.NumericType):  # a date or timestamp again, by one row that holds it
        at = timed.where(number == F.lit(value)).select(time_column).first()[0]
    else:
        at = int(value) if isinstance(kind, T.IntegralType) else value
    return {time_column: at, "position": rank, "earlier": found[0] < value}


def split_guards(df: DataFrame, train_fraction: float = 0.8, time_column: str = "step") -> int:
    """The cutoff time, or an error when a strict split at it is impossible.

    A cutoff taken from the data always has rows at or after it, and sides defined by ``<`` and ``>=`` cannot overlap, so
    only the train side can turn out empty.
    """
    if not 0 < train_fraction < 1:
        raise ValueError("train_fraction must lie strictly between 0 and 1")
    if time_column not in df.columns:
        raise ValueError(f"no such column: {time_column}")
    found = cutoff_row(df, train_fraction, time_column)
    if found is None:
        raise ValueError("nothing to split")
    if found["position"] == 0:
        raise ValueError("too few rows for this fraction")
    if not found["earlier"]:
        raise ValueError(f"no rows before the cutoff {found[time_column]}")
    return found[time_column]


def cutoff_step(df: DataFrame, train_fraction: float = 0.8, time_column: str = "step") -> int:
    """The time at which the test side starts: a step, or a value of whatever type the column has."""
    return split_guards(df, train_fraction, time_column)


def label_split(df: DataFrame, cutoff: int, time_column: str = "step") -> DataFrame:
    """Input rows with ``split`` = train (before the cutoff) or test (at or after it)."""
    return df.where(F.col(time_column).isNotNull()).withColumn(
        "split", F.when(F.col(time_column) < cutoff, "train").otherwise("test")
    )


def strict_time_split(
    df: DataFrame, train_fraction: float = 0.8, time_column: str = "step"
) -> tuple[DataFrame, DataFrame, int]:
    """Rows before the cutoff, rows from the cutoff on, and the cutoff. A step is never on both sides."""
    cutoff = split_guards(df, train_fraction, time_column)
    return df.where(F.col(time_column) < cutoff), df.where(F.col(time_column) >= cutoff), cutoff


def positional_split(
    df: DataFrame, train_fraction: float = 0.8, row_key: str = "event_id"
) -> tuple[DataFrame, DataFrame]:
    """First ``int(rows * fraction)`` rows in order of the row key, and all others; a step may be cut in two.

    The order is that of the table, which the row key stands for; steps play no role, so rows without one are in it too.
    The boundary is found by exact rank selection on the row key; both sides are plain filters. ``row_key`` must be a
    unique number; rows without one come last.
    """
    rows = df.count()
    rank = int(rows * train_fraction)
    # The last rank stands in where all rows with a key are on the first side.
    found = values_at_ranks(df, {row_key: [lambda keyed: min(rank, keyed - 1), lambda keyed: keyed - 1]})[row_key]
    if rank not in found:
        first = F.col(row_key).isNotNull()
    else:
        first = F.coalesce(F.col(row_key) < found[rank], F.lit(False))
    return df.where(first), df.where(~first)


def fixed_windows(df: DataFrame, cutoff: int = REFERENCE_END_STEP) -> DataFrame:
    """Input rows with ``window`` = reference (before the cutoff) or current; rows without a step are left out."""
    return df.where(F.col("step").isNotNull()).withColumn(
        "window", F.when(F.col("step") < cutoff, "reference").otherwise("current")
    )
