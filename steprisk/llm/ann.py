"""Nearest neighbours by cosine: stable projections, a kd-tree over them, and a chi-square stopping test.

Vectors are scaled to length one, so the largest cosine is the smallest distance. ``PROJECTIONS`` Gaussian projections
(2-stable) turn a distance d into a projected distance whose square is d squared times a chi-square variable with as
many degrees of freedom. A kd-tree over projected vectors, fitted on at most ``FIT_ROWS`` rows taken by hash, gives
every vector a cell; every row is indexed.

Search goes outwards in waves: a query first visits its own cell, then cells in order of the distance of their box.
Inside a cell, vectors are verified against the full vectors in order of projected distance as long as
``projected <= kth best distance * sqrt(chi2 quantile of CONFIDENCE)``: beyond that, a nearer vector would have to be an
outlier of its own projection. The same test drops whole cells before a wave. There is no cap on cells or candidates.

Rows of a cell travel in blocks of at most about ``BLOCK_ROWS`` vectors, queries in packs of ``PACK_QUERIES``, so a cell that
holds a third of all rows is many blocks and a task holds one block and one pack at a time.

Defined results: vectors that are null, of length zero, or hold a null or a non-finite component take no part, neither
as query nor as candidate; neither do rows with a null id, nor vectors whose length differs from the most frequent
one. A query's candidates are the rows with another id; a query id that occurs repeatedly is asked once, with its
smallest vector. Equal scores go to the smaller id. Fewer than ``k`` candidates: all of them. Other columns play no role.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from steprisk.llm.common import written

PROJECTIONS = 10
CONFIDENCE = 0.995
FIT_ROWS = 32_768
CELL_ROWS = 1024
MAX_CELLS = 1024
BLOCK_ROWS = 1024
PACK_QUERIES = 128
WAVES = (1, 9)
SEED = 11


# --- the stopping test ---------------------------------------------------------------------------------------------


def chi_square_quantile(probability: float, degrees: int) -> float:
    """For an even number of degrees the distribution function is a finite sum; bisection inverts it."""
    if degrees % 2:
        raise ValueError("an even number of projections is needed")

    def cumulated(x: float) -> float:
        return 1.0 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(degrees // 2))

    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if cumulated(middle) < probability else (low, middle)
    return high


# --- the tree ------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Tree:
    """Cells of a kd-tree: a split per inner node in heap order, and each cell's box."""

    axes: np.ndarray
    cuts: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @property
    def cells(self) -> int:
        return len(self.low)

    def cell(self, points: np.ndarray) -> np.ndarray:
        """Cell of every point."""
        node = np.zeros(len(points), dtype=np.int64)
        for _ in range(int(math.log2(self.cells))):
            right = points[np.arange(len(points)), self.axes[node]] > self.cuts[node]
            node = 2 * node + 1 + right
        return node - (self.cells - 1)

    def distances(self, points: np.ndarray) -> np.ndarray:
        """Distance of every point to every cell's box."""
        total = np.zeros((len(points), self.cells))
        for axis in range(points.shape[1]):
            at = points[:, axis, None]
            total += np.maximum(np.maximum(self.low[:, axis] - at, at - self.high[:, axis]), 0.0) ** 2
        return np.sqrt(total)


def fit_tree(sample: np.ndarray, cells: int) -> Tree:
    """Median splits on the widest axis, down to ``cells`` (a power of two) cells; outer boxes are unbounded."""
    width = sample.shape[1]
    low, high = [np.full(width, -np.inf)], [np.full(width, np.inf)]
    members, axes, cuts = [sample], [], []
    while len(members) < cells:
        following: tuple[list, list, list] = ([], [], [])
        for points, lower, upper in zip(members, low, high):
            axis = int(np.argmax(points.std(axis=0))) if len(points) else 0
            cut = float(np.median(points[:, axis])) if len(points) else 0.0
            axes.append(axis)
            cuts.append(cut)
            inner_high, inner_low = upper.copy(), lower.copy()
            inner_high[axis], inner_low[axis] = cut, cut
            right = points[:, axis] > cut
            for group, items in zip(following, ((points[~right], points[right]), (lower, inner_low), (inner_high, upper))):
                group.extend(items)
        members, low, high = following
    return Tree(np.array(axes, dtype=np.int64), np.array(cuts), np.array(low), np.array(high))


# --- rows to arrays ------------------------------------------------------------------------------------------------


# Sums of squares beyond these lose digits, or over- or underflow.
SAFE_SQUARES = (1e-200, 1e200)


def _usable(vector: Column) -> Column:
    """Neither null nor zero, and no component null or not finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _safe(vector: Column) -> Column:
    """The vector, or, where its squares leave the range of doubles, the vector over its largest component: the same cosines."""
    squares = F.aggregate(vector, F.lit(0.0), lambda total, x: total + x * x)
    largest = F.array_max(F.transform(vector, F.abs))
    return F.when(squares.between(*SAFE_SQUARES), vector).otherwise(F.transform(vector, lambda x: x / largest))


def _matrix(column: pa.Array) -> np.ndarray:
    """An array of equally long, null-free vectors as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]


def _cosines(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Row by row in one fixed order of summation: equal vectors get equal scores."""
    dots = (vectors * query).sum(axis=1)
    return dots / (np.sqrt((query * query).sum()) * np.sqrt((vectors * vectors).sum(axis=1)))


# --- search --------------------------------------------------------------------------------------------------------


def _visited(projection: np.ndarray, k: int, factor: float):
    """Verifies one block against one pack of queries; ``factor``: root of the chi-square quantile."""

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], np.int64)
                block = np.frombuffer(row["vectors"], np.float64).reshape(len(ids), -1)
                unit, asked = _unit(block), np.frombuffer(row["query_ids"], np.int64)
                queries = np.frombuffer(row["query_vectors"], np.float64).reshape(len(asked), -1)
                kth = np.frombuffer(row["kth"], np.float64)
                ours, theirs = unit @ projection, _unit(queries) @ projection
                apart = np.sqrt(
                    np.maximum((ours**2).sum(1)[None, :] + (theirs**2).sum(1)[:, None] - 2 * theirs @ ours.T, 0.0)
                )
                found: list[tuple] = []
                for place, (query_id, query) in enumerate(zip(asked, queries)):
                    found.extend(_verified(query_id, query, kth[place], ids, block, apart[place], k, factor))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*found), (pa.int64(), pa.int64(), pa.float64()))],
                        names=["query_id", "vec_id", "score"],
                    )

    return visit


def _verified(query_id, query, kth, ids, block, apart, k, factor) -> list[tuple]:
    """Best ``k`` of the block for one query, taking vectors by growing projected distance until the test holds."""
    order = np.argsort(apart, kind="stable")
    best_ids, best = np.zeros(0, np.int64), np.zeros(0)
    step, start = 16 * k, 0
    while start < len(order):
        part = order[start : start + step]
        if apart[part[0]] > kth * factor + 1e-9:
            break
        part = part[(apart[part] <= kth * factor + 1e-9) & (ids[part] != query_id)]
        if len(part):
            scores = np.concatenate((best, _cosines(query, block[part])))
            members = np.concatenate((best_ids, ids[part]))
            keep = np.lexsort((members, -scores))[:k]
            best, best_ids = scores[keep], members[keep]
            if len(best) == k:
                kth = min(kth, math.sqrt(max(0.0, 2.0 - 2.0 * best[-1])))
        start += step
        step *= 2
    return [(int(query_id), int(i), float(s)) for i, s in zip(best_ids, best)]


def _assign(projection: np.ndarray, tree: Tree):
    """Cell of every row, with its vector as bytes."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            vectors = _matrix(batch.column(1))
            cells = tree.cell(_unit(vectors) @ projection)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cells), pa.array([v.tobytes() for v in vectors], pa.binary())],
                names=["vec_id", "cell", "vector"],
            )

    return assign


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows, sorted by cell, as blocks of one cell; a block never exceeds ``BLOCK_ROWS`` rows."""
    cell, ids, vectors = None, [], []

    def block() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([cell], pa.int64()), pa.array([np.array(ids, np.int64).tobytes()], pa.binary()), pa.array([b"".join(vectors)], pa.binary())],
            names=["cell", "ids", "vectors"],
        )

    for batch in batches:
        for vec_id, at, vector in zip(*(column.to_pylist() for column in batch.columns)):
            if ids and (at != cell or len(ids) >= BLOCK_ROWS):
                yield block()
                ids, vectors = [], []
            cell = at
            ids.append(vec_id)
            vectors.append(vector)
    if ids:
        yield block()


def _waves(projection: np.ndarray, tree: Tree, first: int, upto: int | None, factor: float):
    """For every query the cells numbered ``first`` to ``upto`` by distance that the test does not drop."""

    def waves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            vectors = np.stack([np.frombuffer(v, np.float64) for v in batch.column(1).to_pylist()])
            kth = batch.column(2).to_numpy(zero_copy_only=False)
            for start in range(0, len(vectors), 512):
                part = vectors[start : start + 512]
                away = tree.distances(_unit(part) @ projection)
                order = np.argsort(away, axis=1, kind="stable")[:, first:upto]
                near = np.take_along_axis(away, order, axis=1) <= kth[start : start + 512, None] * factor + 1e-9
                rows, columns = np.nonzero(near)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(rows + start)),
                        batch.column(1).take(pa.array(rows + start)),
                        pa.array(kth[rows + start]),
                        pa.array(order[rows, columns]),
                    ],
                    names=["query_id", "vector", "kth", "cell"],
                )

    return waves


def _packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Visits, sorted by cell, as packs of queries of one cell."""
    cell, ids, vectors, kth = None, [], [], []

    def pack() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([cell], pa.int64()),
                pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
                pa.array([b"".join(vectors)], pa.binary()),
                pa.array([np.array(kth).tobytes()], pa.binary()),
            ],
            names=["cell", "query_ids", "query_vectors", "kth"],
        )

    for batch in batches:
        for query_id, vector, far, at in zip(*(column.to_pylist() for column in batch.columns)):
            if ids and (at != cell or len(ids) >= PACK_QUERIES):
                yield pack()
                ids, vectors, kth = [], [], []
            cell = at
            ids.append(query_id)
            vectors.append(vector)
            kth.append(far)
    if ids:
        yield pack()


def _best(found: DataFrame, k: int) -> DataFrame:
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, confidence: float = CONFIDENCE) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` for ``queries`` among ``vectors`` (both ``vec_id``, ``vector``)."""
    spark = vectors.sparkSession
    # Squares of single-precision components always fit a double.
    wide = [t.schema["vector"].dataType.elementType == T.DoubleType() for t in (vectors, queries)]
    usable = [
        t.where(F.col("vec_id").isNotNull() & _usable(F.col("vector"))).select(
            F.col("vec_id").cast("long").alias("vec_id"), (_safe(F.col("vector")) if scale else F.col("vector")).alias("vector")
        )
        for t, scale in zip((vectors, queries), wide)
    ]
    widths = usable[0].groupBy(F.size("vector").alias("width")).agg(F.count(F.lit(1)).alias("n"))
    usual = widths.orderBy(F.desc("n"), "width").first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if usual is None:
        return empty
    width, rows = usual["width"], usual["n"]
    index, asked = (t.where(F.size("vector") == width) for t in usable)

    projection = np.random.default_rng(SEED).standard_normal((width, PROJECTIONS))
    factor = math.sqrt(chi_square_quantile(confidence, PROJECTIONS))
    cells = 1 << max(0, min(MAX_CELLS, rows // CELL_ROWS).bit_length() - 1)
    share = max(1, rows // FIT_ROWS)
    fitted = index.where(F.pmod(F.xxhash64("vec_id", F.lit(SEED)), F.lit(share)) == 0).limit(2 * FIT_ROWS).select("vector")
    sample = [row["vector"] for row in fitted.toLocalIterator()] or [[1.0] * width]
    tree = fit_tree(_unit(np.array(sample, dtype=np.float64)) @ projection, cells)

    assigned = index.mapInArrow(_assign(projection, tree), "vec_id long, cell long, vector binary")
    # Dealt by cell and hash, so that a large cell lies in many partitions and each makes blocks of its share.
    pieces = max(1, rows // BLOCK_ROWS)
    dealt = assigned.repartitionByRange(max(1, min(pieces, 4096)), "cell", F.xxhash64("vec_id")).sortWithinPartitions("cell")
    blocks = written(dealt.mapInArrow(_blocks, "cell long, ids binary, vectors binary"), "ann-blocks")

    far = math.sqrt(4.0) + 1.0  # no two unit vectors are further apart
    state = asked.groupBy("vec_id").agg(F.min("vector").alias("vector")).select(
        F.col("vec_id").alias("query_id"), "vector"
    ).mapInArrow(_as_bytes, "query_id long, vector binary")
    state = written(state, "ann-queries")
    found = None
    bounds = [0, *[min(w, tree.cells) for w in WAVES], None]
    for first, upto in zip(bounds, bounds[1:]):
        if upto is not None and first >= upto or first >= tree.cells:
            continue
        if found is None:
            open_queries = state.withColumn("kth", F.lit(far))
        else:
            kth = found.where(F.col("rank") == k).select(
                "query_id", F.sqrt(F.greatest(F.lit(0.0), 2.0 - 2.0 * F.col("score"))).alias("kth")
            )
            open_queries = state.join(kth, "query_id", "left").withColumn("kth", F.coalesce("kth", F.lit(far)))
        visits = open_queries.mapInArrow(
            _waves(projection, tree, first, upto, factor), "query_id long, vector binary, kth double, cell long"
        )
        packs = (
            visits.repartitionByRange("cell", F.xxhash64("query_id"))
            .sortWithinPartitions("cell")
            .mapInArrow(_packs, "cell long, query_ids binary, query_vectors binary, kth binary")
        )
        seen = packs.join(blocks, "cell").select("ids", "vectors", "query_ids", "query_vectors", "kth").mapInArrow(
            _visited(projection, k, factor), "query_id long, vec_id long, score double"
        )
        found = written(_best(seen if found is None else seen.unionByName(found.drop("rank")), k), "ann-found")
    return found.select("query_id", "rank", "vec_id", "score")


def _as_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if len(batch):
            vectors = _matrix(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([v.tobytes() for v in vectors], pa.binary())], names=["query_id", "vector"]
            )


def op1_ann(embeddings: DataFrame) -> DataFrame:
    """The 5 nearest rows to every row whose ``vec_id`` is divisible by 50, among all rows."""
    vectors = embeddings.select("vec_id", F.col("embedding").alias("vector"))
    return nearest(vectors, vectors.where(F.col("vec_id") % 50 == 0))
