"""Packing documents into fixed-size sequences: cutting stock by column generation.

1. One pass tokenizes whole texts. A document longer than a sequence is cut into full sequences and a remainder, any
   other stays whole. Only piece lengths, checksums and ids are written.
2. The histogram of lengths, in units of ``UNIT`` tokens rounded up, has at most ``capacity / UNIT`` rows and goes to
   the driver. A linear program over patterns (how many pieces of each length make up a sequence) starts from
   one-length patterns; a knapsack dynamic program prices new ones until none improves the bound by ``GAP``.
3. Whole parts of the pattern counts are kept, what they leave over is filled largest first. If filling everything
   largest first needs fewer sequences (a small table), that is taken.
4. Pieces are ranked within their length class, by counts per hash bucket and a place within it, so no class is ever in
   one task. Ranks map to (sequence, slot) by arithmetic; a running sum per sequence gives the offsets.

Defined results: null text is an empty text, which is the one end id. Equal or null ``doc_id`` rows are pieces of their
own. An empty table gives no pieces. Other columns play no role. Sequence numbers are dense from 0.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from steprisk.llm.common import written
from steprisk.llm.tokens import DEFAULT_VOCABULARY, IDS, WordTokenizer, one_by_one

CAPACITY = 2048
UNIT = 8
END_ID = 1
GAP = 5e-4
MAX_COLUMNS = 5000
BUCKET_ROWS = 50_000

PIECES = T.StructType(
    [
        T.StructField("piece", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
    ]
)


# --- pieces ------------------------------------------------------------------------------------------------------


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """``doc_id``, ``piece`` (a number of its own), ``start``, ``length``, ``ids_crc32``, ``doc_tokens``."""
    end = np.array([END_ID], IDS).tobytes()
    schema = T.StructType([docs.schema["doc_id"], *PIECES])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer.of(vocabulary)
        number = TaskContext.get().partitionId() << 36
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), tokenizer.encode(one_by_one(batch.column(1)))):
                ids += end
                total = len(ids) // IDS.itemsize
                for start in range(0, total, capacity):
                    part = ids[start * IDS.itemsize : (start + capacity) * IDS.itemsize]
                    rows.append((doc_id, number, start, len(part) // IDS.itemsize, zlib.crc32(part), total))
                    number += 1
            columns = list(zip(*rows)) if rows else [[] for _ in schema]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], batch.schema.field(0).type), *[pa.array(c, pa.int64()) for c in columns[1:]]],
                names=schema.names,
            )

    return docs.select("doc_id", "text").mapInArrow(cut, schema)


# --- patterns ----------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Pattern:
    """``times`` sequences, each holding ``counts[size]`` pieces of every size class in it."""

    counts: dict[int, int]
    times: int


def best_pattern(values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the pattern of largest total value. ``values[i]`` belongs to size ``i + 1``."""
    best, choice = np.zeros(capacity + 1), np.zeros(capacity + 1, dtype=np.int64)
    for room in range(1, capacity + 1):
        options = best[room - 1 :: -1][: len(values)] + values[: min(room, len(values))]
        pick = int(np.argmax(options))
        best[room], choice[room] = options[pick], pick + 1
        if best[room - 1] >= best[room]:
            best[room], choice[room] = best[room - 1], 0  # one unit stays empty
    counts, room = np.zeros(len(values), dtype=np.int64), capacity
    while room > 0:
        if choice[room]:
            counts[choice[room] - 1] += 1
        room -= max(1, int(choice[room]))
    return float(best[capacity]), counts


def inverted(matrix: np.ndarray) -> np.ndarray:
    """Gauss-Jordan with row exchange: small matrices, and no multi-threaded library in the driver process."""
    size = len(matrix)
    work = np.hstack([matrix.astype(float), np.eye(size)])
    for step in range(size):
        pivot = step + int(np.argmax(np.abs(work[step:, step])))
        work[[step, pivot]] = work[[pivot, step]]
        work[step] /= work[step, step]
        factors = work[:, step].copy()
        factors[step] = 0.0
        work -= factors[:, None] * work[step]
    return work[:, size:]


def starting_columns(demand: np.ndarray, capacity: int, sizes: np.ndarray) -> np.ndarray:
    """Basis of the largest-first filling: each of its patterns uses up some size and stands in that size's column;
    sizes used up along with another keep the pattern of that size alone."""
    columns = np.diag((capacity // sizes).astype(float))
    left = demand[sizes - 1].astype(float)
    while (left > 0).any():
        room, column = capacity, np.zeros(len(sizes))
        for place in np.flatnonzero(left > 0)[::-1]:
            column[place] = min(room // sizes[place], np.ceil(left[place]))
            room -= int(column[place]) * sizes[place]
        held = np.flatnonzero(column)
        times = left[held] / column[held]
        used_up = held[np.argmin(times)]
        left[held] = np.maximum(left[held] - times.min() * column[held], 0.0)
        left[left < 1e-9] = 0.0
        left[used_up] = 0.0
        columns[:, used_up] = column
    return columns


def solve(demand: np.ndarray, capacity: int, gap: float = GAP) -> tuple[np.ndarray, np.ndarray]:
    """Columns (size x pattern) and how often each is used in the linear program, by revised simplex steps."""
    sizes = np.flatnonzero(demand) + 1
    wanted = demand[sizes - 1].astype(float)
    columns = starting_columns(demand, capacity, sizes)
    inverse = inverted(columns)
    bound = float((sizes * wanted).sum()) / capacity  # no packing beats one without waste
    for step in range(1, MAX_COLUMNS + 1):
        used = np.maximum((inverse * wanted).sum(axis=1), 0.0)
        if used.sum() <= bound * (1.0 + gap):
            break
        prices = np.zeros(capacity)
        prices[sizes - 1] = np.maximum(inverse.sum(axis=0), 0.0)
        value, counts = best_pattern(prices, capacity)
        bound = max(bound, float((prices[sizes - 1] * wanted).sum()) / max(value, 1.0))
        if value <= 1.0 + 1e-9 or used.sum() <= bound * (1.0 + gap):
            break
        column = counts[sizes - 1].astype(float)
        direction = (inverse * column).sum(axis=1)
        ratio = np.where(direction > 1e-9, used / np.where(direction > 1e-9, direction, 1.0), np.inf)
        leaves = int(np.argmin(ratio))
        if not np.isfinite(ratio[leaves]):
            break
        columns[:, leaves] = column
        row = inverse[leaves] / direction[leaves]
        inverse -= direction[:, None] * row
        inverse[leaves] = row
        if step % 250 == 0:
            inverse = inverted(columns)
    return columns, used


def filled(demand: np.ndarray, capacity: int) -> list[Pattern]:
    """Largest first, the same pattern as often as the counts allow."""
    left, patterns = demand.copy(), []
    while left.any():
        room, counts = capacity, {}
        for size in np.flatnonzero(left)[::-1] + 1:
            fit = min(room // size, int(left[size - 1]))
            if fit:
                counts[int(size)] = int(fit)
                room -= fit * size
            if room == 0:
                break
        times = min(int(left[size - 1]) // count for size, count in counts.items())
        for size, count in counts.items():
            left[size - 1] -= count * times
        patterns.append(Pattern(counts, times))
    return patterns


def cutting_stock(demand: np.ndarray, capacity: int) -> list[Pattern]:
    """Patterns that together hold exactly ``demand[i]`` pieces of size ``i + 1``."""
    if not demand.any():
        return []
    sizes = np.flatnonzero(demand) + 1
    columns, used = solve(demand, capacity)
    whole = np.floor(used + 1e-9).astype(np.int64)
    left = demand.astype(np.int64).copy()
    rounded = []
    for place, times in enumerate(whole):
        column = columns[:, place].astype(np.int64)
        held = column > 0
        times = min(int(times), int((left[sizes - 1][held] // column[held]).min()))
        if times > 0:
            rounded.append(Pattern({int(s): int(c) for s, c in zip(sizes[held], column[held])}, times))
            left[sizes[held] - 1] -= column[held] * times
    rounded += filled(left, capacity)
    plain = filled(demand.astype(np.int64), capacity)
    return min(rounded, plain, key=lambda patterns: sum(p.times for p in patterns))


# --- assignment --------------------------------------------------------------------------------------------------


def pack(cut: DataFrame, capacity: int = CAPACITY, unit: int = UNIT) -> DataFrame:
    """``cut`` (a written table of ``pieces``) with ``sequence_id`` and ``offset``."""
    sized = cut.withColumn("_class", F.ceil(F.col("length") / unit).cast("int"))
    histogram = sized.groupBy("_class").agg(F.count(F.lit(1)).alias("n")).collect()  # at most capacity / unit rows
    demand = np.zeros(capacity // unit, dtype=np.int64)
    for row in histogram:
        demand[row["_class"] - 1] = row["n"]
    ranges, first, taken = [], 0, dict.fromkeys(range(1, len(demand) + 1), 0)
    for pattern in cutting_stock(demand, capacity // unit):
        slot = 0
        for size, count in pattern.counts.items():
            upto = taken[size] + count * pattern.times
            ranges.append((size, taken[size], upto, count, first, slot))
            taken[size], slot = upto, slot + count
        first += pattern.times
    # Bounded by patterns times classes, both at most capacity / unit (and what filling adds): a few thousand rows.
    lookup = cut.sparkSession.createDataFrame(
        ranges, "_class int, _from long, _to long, _each long, _first long, _slot long"
    )

    buckets = int(demand.sum()) // BUCKET_ROWS + 16
    keyed = sized.withColumn("_bucket", F.pmod(F.xxhash64("piece"), F.lit(buckets)))
    before = Window.partitionBy("_class").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        keyed.groupBy("_class", "_bucket")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_class", "_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    place = F.row_number().over(Window.partitionBy("_class", "_bucket").orderBy("piece")) - 1
    ranked = keyed.withColumn("_place", place).join(starts, ["_class", "_bucket"]).withColumn(
        "_rank", F.col("_start") + F.col("_place")
    )
    within = F.col("_rank") - F.col("_from")
    slotted = (
        ranked.join(F.broadcast(lookup), "_class")
        .where((F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")))
        .withColumns(
            {
                "sequence_id": F.col("_first") + F.floor(within / F.col("_each")),
                "_slot": F.col("_slot") + within % F.col("_each"),
            }
        )
    )
    along = Window.partitionBy("sequence_id").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    return slotted.select(
        *cut.columns, "sequence_id", F.coalesce(F.sum("length").over(along), F.lit(0)).alias("offset")
    )


def op2_packing(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset`` per piece."""
    return pack(written(pieces(docs), "pieces")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )
