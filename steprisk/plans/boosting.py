"""Weighted gradient-boosted trees under the logistic loss, level by level over binned features.

The rows are binned once, into blocks of one byte a feature that stay where they are. A level is one job: every task adds up
its rows by (node, feature, bin, class), and only these sums, bounded by nodes and bins, come to the driver, which picks
the splits. Of two siblings only the one of fewer rows is added up; the other is the parent less that one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from steprisk.session import findable, shared_folder

BLOCK_ROWS = 1 << 17
# After so many rounds the margins are worked out anew from all trees, which cuts the lineage without writing anything.
REBASE = 60
# Gains at or below these shares of a node's own sum are rounding.
RELATIVE, ABSOLUTE = 1e-9, 1e-14
POSITIVE = "_positive"


@dataclass(frozen=True)
class Tree:
    """Splits by level (feature and last bin that goes below, per place in the level) and values of the last level.

    A place that is not split sends all its rows below, so every row ends in the last level."""

    features: list[np.ndarray]
    cuts: list[np.ndarray]
    values: np.ndarray
    nodes: list[tuple]


# --- bins --------------------------------------------------------------------------------------------------------


def _matrix(batch: pa.RecordBatch, features: int) -> list[np.ndarray]:
    """The first columns as doubles; NULL is NaN."""
    return [batch.column(at).cast(pa.float64()).to_numpy(zero_copy_only=False) for at in range(features)]


def _few_values(features: int, most: int):
    """Distinct values of every feature in a partition, NULL where there are more than ``most``."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[np.ndarray | None] = [np.empty(0) for _ in range(features)]
        for batch in batches:
            for at, values in enumerate(_matrix(batch, features)):
                if seen[at] is not None:
                    both = np.union1d(seen[at], values[~np.isnan(values)])
                    seen[at] = both if len(both) <= most else None
        yield pa.RecordBatch.from_pydict(
            {"feature": pa.array(range(features), pa.int32()), "few": pa.array(seen, pa.list_(pa.float64()))}
        )

    return of


def split_candidates(rows: DataFrame, features: Sequence[str], bins: int, weight: float) -> list[np.ndarray]:
    """Ascending thresholds of every feature, a row going below at or under one; NULL and NaN go above all.

    Between any two values for a feature of at most ``bins`` values, at the weighted quantiles of all rows otherwise, and
    after the greatest value where some rows have none. The weighted quantiles come from those of either class."""
    few: list[np.ndarray | None] = [np.empty(0) for _ in features]
    partial = rows.select(*features).mapInArrow(_few_values(len(features), bins), "feature int, few array<double>")
    for feature, values in partial.collect():
        if few[feature] is not None:
            both = None if values is None else np.union1d(few[feature], values)
            few[feature] = both if both is not None and len(both) <= bins else None
    points = 20 * bins
    # One expression of text: as a list, every step would be a call of its own.
    steps = F.expr(f"array({', '.join(f'{step / points!r}D' for step in range(1, points + 1))})")
    known = {name: F.when(~F.isnan(F.col(name).cast("double")), F.col(name).cast("double")) for name in features}
    asked = []
    for column, values in zip(known.values(), few, strict=True):
        asked += [F.count_if(column.isNull()), F.max(column)]
        for side in (F.col(POSITIVE), ~F.col(POSITIVE)) if values is None else ():
            mine = F.when(side, column)
            asked += [F.count(mine), F.percentile_approx(mine, steps, max(10_000, 10 * points))]
    found = iter(rows.agg(*asked).first())
    thresholds = []
    for values in few:
        unknown, top = next(found), next(found)
        if values is None:
            sides = [(next(found), next(found)) for _ in range(2)]
            at = _weighted_quantiles([(rows * share, at) for (rows, at), share in zip(sides, (weight, 1.0), strict=True)], bins)
            at = at[at < top]
        else:
            with np.errstate(all="ignore"):
                at = values[:-1] / 2 + values[1:] / 2
                at = np.where((values[:-1] <= at) & (at < values[1:]), at, values[:-1])
        thresholds.append(np.append(at, top) if unknown and top is not None else at)
    return thresholds


def _weighted_quantiles(parts: list[tuple[float, list[float] | None]], bins: int) -> np.ndarray:
    """Distinct values at the inner ``bins``-quantiles of several parts, each its weight and evenly spaced quantiles."""
    parts = [(whole, np.array(at)) for whole, at in parts if at]
    values = np.concatenate([at for _, at in parts])
    weights = np.concatenate([np.full(len(at), whole / len(at)) for whole, at in parts])
    order = np.argsort(values, kind="stable")
    upto = weights[order].cumsum()
    wanted = upto[-1] * np.arange(1, bins) / bins
    return np.unique(values[order][np.minimum(upto.searchsorted(wanted), len(upto) - 1)])


def _blocks(thresholds: list[np.ndarray], width: str):
    """Binned rows in blocks of ``BLOCK_ROWS``, one row of bytes each."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, count = TaskContext.get().partitionId() << 32, 0
        bins, positive, waiting = [], [], 0

        def block() -> pa.RecordBatch:
            data = {
                "block": [first + count],
                "rows": [waiting],
                "bins": [np.concatenate(bins, axis=1).tobytes()],
                "positive": [np.packbits(np.concatenate(positive)).tobytes()],
            }
            return pa.RecordBatch.from_pydict(data)

        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                columns = _matrix(part, len(thresholds))
                bins.append(np.stack([at.searchsorted(x).astype(width) for at, x in zip(thresholds, columns, strict=True)]))
                positive.append(part.column(len(thresholds)).to_numpy(zero_copy_only=False).astype(bool))
                waiting += part.num_rows
                if waiting >= BLOCK_ROWS:
                    yield block()
                    bins, positive, waiting, count = [], [], 0, count + 1
        if waiting:
            yield block()

    return of


def _unpacked(features: int, width: str):
    def of(row) -> tuple:
        bins = np.frombuffer(row.bins, width).reshape(features, row.rows)
        positive = np.unpackbits(np.frombuffer(row.positive, "uint8"), count=row.rows).astype(bool)
        return row.block, bins, positive, np.zeros(row.rows)

    return of


# --- what tasks do -----------------------------------------------------------------------------------------------


def _places(bins: np.ndarray, features: list[np.ndarray], cuts: list[np.ndarray]) -> np.ndarray:
    """Place of each row in the level below the given ones."""
    rows = bins.shape[1]
    flat, row = bins.reshape(-1), np.arange(rows)
    place = np.zeros(rows, "int64")
    for feature, cut in zip(features, cuts, strict=True):
        if len(feature) == 1:
            above = bins[feature[0]] > cut[0]
        else:
            above = flat.take(feature.take(place) * rows + row) > cut.take(place)
        place = 2 * place + above
    return place


def _advance(trees: list[tuple[Tree, float]]):
    """Blocks with the given trees added to their margins, one after the other."""

    def of(block: tuple) -> tuple:
        number, bins, positive, margin = block
        for tree, weight in trees:
            margin = margin + weight * tree.values.take(_places(bins, tree.features, tree.cuts))
        return number, bins, positive, margin

    return of


def _sums(turn: int, features: list, cuts: list, slots: np.ndarray, bins: int, weight: float, fraction: float, seed: int):
    """Counts and weighted residuals of a partition's sampled rows by slot, feature, bin and class (negative, positive).

    ``slots`` numbers the places of the level that are added up, -1 for the others."""
    wanted = int(slots.max()) + 1

    def of(blocks: Iterator[tuple]) -> Iterator[np.ndarray]:
        total = None
        for number, binned, positive, margin in blocks:
            slot = slots.take(_places(binned, features, cuts))
            taken = slot >= 0
            if fraction < 1:
                taken &= np.random.default_rng((seed, turn, number)).random(len(taken), dtype="float32") < fraction
            at = np.flatnonzero(taken)
            mine = positive.take(at)
            sign = np.where(mine, 1.0, -1.0)
            with np.errstate(over="ignore"):
                gradient = sign if turn == 0 else 4 * sign / (1 + np.exp(2 * sign * margin.take(at)))
            gradient = gradient * np.where(mine, weight, 1.0)
            base = slot.take(at) * (2 * bins) + mine
            size = wanted * bins * 2
            found = np.empty((2, len(binned), size))
            for feature, column in enumerate(binned):
                key = column.take(at).astype("int64")
                key *= 2
                key += base
                found[0, feature] = np.bincount(key, minlength=size)
                found[1, feature] = np.bincount(key, gradient, size)
            total = found if total is None else total + found
        if total is not None:
            yield total.reshape(2, len(total[0]), wanted, bins, 2)

    return of


# --- what the driver does ----------------------------------------------------------------------------------------


def _best(sums: np.ndarray, weight: float, thresholds: list[np.ndarray], usable: np.ndarray) -> tuple | None:
    """(gain, feature, bin) of a node's best split, the first of equals; ``sums`` by count or residual, feature, bin, class."""
    counts = sums[0].cumsum(axis=1)
    below = counts[..., 0] + weight * counts[..., 1]
    gradients = sums[1].sum(axis=-1).cumsum(axis=1)
    rows, whole, gradient = counts.sum(axis=-1), below[:, -1:], gradients[:, -1:]
    with np.errstate(all="ignore"):
        own = gradient**2 / whole
        gain = gradients**2 / below + (gradient - gradients) ** 2 / (whole - below) - own
    cut = np.arange(gain.shape[1])[None, :] < np.array([len(at) for at in thresholds])[:, None]
    valid = cut & usable[:, None] & (rows > 0) & (rows < rows[:, -1:]) & np.isfinite(gain)
    valid &= gain > RELATIVE * own + ABSOLUTE * whole
    if not valid.any():
        return None
    gain = np.where(valid, gain, -1.0)
    feature, at = np.unravel_index(np.flatnonzero(gain >= gain.max() * (1 - 1e-12))[0], gain.shape)
    return float(gain[feature, at] / whole[feature, 0]), int(feature), int(at)


def _level_sums(state: RDD, level: int, parents: dict, children: list[int], job) -> dict[int, np.ndarray]:
    """Sums of every place in ``children``; of two siblings the one of more rows is the parent less the other."""
    built = children if not parents else []
    for parent, (sums, feature, at) in parents.items():
        rows = sums[0, feature].sum(axis=-1)
        built.append(2 * parent if 2 * rows[: at + 1].sum() <= rows.sum() else 2 * parent + 1)
    slots = np.full(1 << level, -1, "int64")
    slots[built] = np.arange(len(built))
    added = state.mapPartitions(job(slots)).reduce(np.add)
    found = {place: added[:, :, slot] for slot, place in enumerate(built)}
    for parent, (sums, _, _) in parents.items():
        one = next(place for place in (2 * parent, 2 * parent + 1) if place in found)
        found[one ^ 1] = sums - found[one]
        found[one ^ 1][0] = np.rint(found[one ^ 1][0])
    return found


def _fitted_tree(state: RDD, turn: int, thresholds: list[np.ndarray], weight: float, boosting) -> Tree:
    bins = max(len(at) for at in thresholds) + 1
    usable = np.ones(len(thresholds), bool)
    share = max(1, int(np.ceil(boosting.column_fraction * len(thresholds) - 1e-9)))
    features, cuts, nodes, values = [], [], [], None
    # Nodes of the level by place: number among all nodes, and the sums of those that were split.
    numbers, parents, children = {0: 0}, {}, [0]
    for level in range(boosting.depth):
        if children:
            job = lambda slots: _sums(
                turn, features, cuts, slots, bins, weight, boosting.row_fraction, boosting.seed
            )
            sums = _level_sums(state, level, parents, list(children), job)
        feature, cut = np.zeros(1 << level, "int64"), np.full(1 << level, np.iinfo("int64").max)
        if level == 0:
            values = np.zeros(1)
            nodes.append([0, *_node(sums[0], weight)])
            values[0] = nodes[0][1]
        following = np.repeat(values, 2)
        parents, split, further = {}, {}, []
        for place in children:
            if share < len(thresholds):
                usable = np.zeros(len(thresholds), bool)
                draw = np.random.default_rng((boosting.seed, turn, level, place))
                usable[draw.choice(len(thresholds), share, replace=False)] = True
            best = _best(sums[place], weight, thresholds, usable)
            if best is None:
                continue
            gain, column, at = best
            feature[place], cut[place] = column, at
            parents[place] = (sums[place], column, at)
            one = sums[place][:, column : column + 1]
            sides = [_node(side, weight) for side in (one[:, :, : at + 1], one[:, :, at + 1 :])]
            ids = [len(nodes), len(nodes) + 1]
            nodes[numbers[place]] += [gain, column, float(thresholds[column][at]), *ids]
            for side, (number, node) in enumerate(zip(ids, sides, strict=True)):
                nodes.append([number, *node])
                split[2 * place + side] = number
                following[2 * place + side] = node[0]
                further.append(2 * place + side)
        features, cuts, values = [*features, feature], [*cuts, cut], following
        numbers, children = split, further
    return Tree(features, cuts, values, [tuple(node) for node in nodes])


def _node(sums: np.ndarray, weight: float) -> tuple[float, float, float, int]:
    """Prediction, weight, weighted residuals and rows of a node."""
    counts, gradient = sums[0, 0].sum(axis=0), float(sums[1, 0].sum())
    whole = float(counts[0] + weight * counts[1])
    return (gradient / whole if whole > 0 else 0.0), whole, gradient, int(counts.sum())


# --- the fit -----------------------------------------------------------------------------------------------------


def fit_trees(rows: DataFrame, features: Sequence[str], weight: float, boosting) -> list[tuple[Tree, float]]:
    """Trees and their weights, fitted on ``rows`` (the features and a boolean ``POSITIVE``); a positive row weighs ``weight``.

    The first tree fits the labels -1 and 1, every other the residuals 4y / (1 + exp(2ym)) of the margin m so far. Each
    tree sees a share of the rows, drawn by block number and round, and each node a share of the features.
    """
    context = rows.sparkSession.sparkContext
    findable(rows.sparkSession)
    rows = rows.select(*features, POSITIVE).repartition(context.defaultParallelism).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        thresholds = split_candidates(rows, features, boosting.bins, weight)
        width = "uint8" if max(len(at) for at in thresholds) < 256 else "int32"
        packed = rows.mapInArrow(_blocks(thresholds, width), "block long, rows long, bins binary, positive binary")
        blocks = packed.rdd.map(_unpacked(len(features), width)).persist(StorageLevel.MEMORY_AND_DISK)
        count = blocks.map(lambda block: len(block[3])).sum()
        if count == 0:
            raise ValueError("no rows to fit on")
    finally:
        rows.unpersist()
    # A level of few rows is a job of few tasks, which leaves room for another fit at the same time; the blocks stay as they are.
    dealt = blocks.coalesce(max(1, -(-count // BLOCK_ROWS)))
    trees, state = [], dealt
    try:
        for turn in range(boosting.rounds):
            before = state
            if turn and turn % REBASE == 0:
                state = dealt.map(_advance(trees)).persist(StorageLevel.MEMORY_AND_DISK)
            elif turn:
                state = state.map(_advance(trees[-1:])).persist(StorageLevel.MEMORY_AND_DISK)
            tree = _fitted_tree(state, turn, thresholds, weight, boosting)
            trees.append((tree, 1.0 if turn == 0 else boosting.rate))
            if before is not state and before is not dealt:
                before.unpersist()
    finally:
        state.unpersist()
        blocks.unpersist()
    return trees


def as_model(
    spark: SparkSession, trees: list[tuple[Tree, float]], features: int, classifier: GBTClassifier
) -> GBTClassificationModel:
    """The trees as Spark ML's model with the parameters of ``classifier``, by way of its stored form.

    Impurities, which nothing here computes, are stored as -1; gains, weights and row counts are there."""
    folder = f"{shared_folder(spark)}/steprisk-{spark.sparkContext.applicationId}/trees-{uuid.uuid4().hex[:12]}"

    def description(stage, name: str, **more) -> str:
        path = f"{folder}/{stage.uid}"
        stage.write().overwrite().save(path)
        found = json.loads(spark.read.text(f"{path}/metadata").first()[0])
        return json.dumps(found | {"class": f"org.apache.spark.ml.{name}"} | more)

    head = description(
        classifier, "classification.GBTClassificationModel", numFeatures=features, numTrees=len(trees)
    )
    regressor = DecisionTreeRegressor(maxDepth=classifier.getMaxDepth(), maxBins=classifier.getMaxBins())
    single = description(regressor, "regression.DecisionTreeRegressionModel")
    stored = []
    for number, (tree, _) in enumerate(trees):
        for node, value, weight, gradient, rows, *split in tree.nodes:
            gain, feature, threshold, below, above = split or (-1.0, -1, None, -1, -1)
            at = [] if threshold is None else [threshold]
            stats = [weight, gradient, -1.0]
            stored.append((number, (node, value, -1.0, stats, rows, gain, below, above, (feature, at, -1))))
    split = "struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,numCategories:int>"
    schema = (
        "treeID int, nodeData struct<id:int,prediction:double,impurity:double,impurityStats:array<double>,"
        f"rawCount:bigint,gain:double,leftChild:int,rightChild:int,split:{split}>"
    )
    path = f"{folder}/model"
    spark.createDataFrame([(head,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    weights = [(number, single, weight) for number, (_, weight) in enumerate(trees)]
    spark.createDataFrame(weights, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame(stored, schema).coalesce(1).write.parquet(f"{path}/data")
    return GBTClassificationModel.load(path)
