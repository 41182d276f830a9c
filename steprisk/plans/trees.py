"""A stored classifier read as a table and walked node by node: scores that share no code with the library that fitted it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from steprisk.session import findable

LEAF = -1


def stored_nodes(spark: SparkSession, path: str) -> DataFrame:
    """One row per tree node of the model stored at ``path``: tree, its weight, node, feature, threshold, children, value.

    A row goes to the child ``below`` if its feature is at or below the threshold, else (NaN as well) to ``above``; a
    leaf has ``LEAF`` there. Nodes of a tree are numbered from 0, the root, without gaps.
    """
    node = F.col("nodeData")
    weights = spark.read.parquet(f"{path}/stages/1_*/treesMetadata").toDF("tree", "metadata", "weight")
    nodes = spark.read.parquet(f"{path}/stages/1_*/data").select(
        F.col("treeID").alias("tree"),
        node["id"].alias("node"),
        node["split"]["featureIndex"].alias("feature"),
        F.try_element_at(node["split"]["leftCategoriesOrThreshold"], F.lit(1)).alias("threshold"),
        node["leftChild"].alias("below"),
        node["rightChild"].alias("above"),
        node["prediction"].alias("value"),
    )
    return nodes.join(weights.drop("metadata"), "tree")


def walked_score(
    spark: SparkSession, path: str, table: DataFrame, features: Sequence[str], depth: int, name: str = "walked",
    inputs: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``table`` with the probability that the trees stored at ``path`` give each row, by walking every tree.

    The trees, at most rounds * 2^(depth + 1) nodes whatever the table's size, go to every task as arrays; rows stay where
    they are, and a batch of them takes each step of a tree together. ``inputs`` computes the named features where the
    table does not hold them. A NULL input counts as NaN.
    """
    findable(spark)
    columns = [(inputs[feature] if inputs else F.col(feature)).cast("double") for feature in features]
    trees: dict[int, tuple] = {}
    for row in stored_nodes(spark, path).orderBy("tree", "node").collect():
        weight, nodes = trees.setdefault(row.tree, (row.weight, []))
        leaf = row.below == LEAF
        threshold = float("nan") if row.threshold is None else row.threshold
        children = (row.node, row.node) if leaf else (row.below, row.above)
        nodes.append((0 if leaf else row.feature, threshold, *children, row.value))
    walks = [(weight, *(np.array(part) for part in zip(*nodes, strict=True))) for weight, nodes in trees.values()]

    @F.arrow_udf("double")
    def walked(*arrays: pa.Array) -> pa.Array:
        return pa.array(_walked(walks, [array.to_numpy(zero_copy_only=False) for array in arrays], depth))

    return table.withColumn(name, walked(*[F.coalesce(column, F.lit(float("nan"))) for column in columns]))


def _walked(walks: Sequence[tuple], columns: Sequence[np.ndarray], depth: int) -> np.ndarray:
    rows = len(columns[0])
    values, row = np.concatenate(columns), np.arange(rows)
    margin = np.zeros(rows)
    for weight, feature, threshold, below, above, value in walks:
        place = np.zeros(rows, "int64")
        for _ in range(depth):
            goes = values.take(feature.take(place) * rows + row) <= threshold.take(place)
            place = np.where(goes, below.take(place), above.take(place))
        margin += weight * value.take(place)
    with np.errstate(over="ignore"):
        return 1 / (1 + np.exp(-2 * margin))
