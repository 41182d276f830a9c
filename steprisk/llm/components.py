"""Connected components of a distributed edge list by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from steprisk.llm.common import written


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of the node's neighbourhood."""
    directed = _both_ways(edges)
    least = directed.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return directed.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    onto = down.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return onto.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (its least node) of every node of ``edges`` (``u``, ``v``); self-links are allowed.

    Each round is written to the shared folder, which cuts the lineage. The number of rounds grows with the logarithm
    of the number of nodes. Nodes without an edge do not appear.
    """
    spark = edges.sparkSession
    current = written(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links"
    )
    mark = None
    while True:
        current = written(_small_star(_large_star(current)), "links")
        # Order-free fingerprint of the edge set: two equal ones in a row mean that every component is a star.
        row = current.agg(
            F.count(F.lit(1)).alias("n"),
            F.bit_xor(F.xxhash64("u", "v")).alias("x"),
            F.sum(F.xxhash64("v", "u") % F.lit(1 << 40)).alias("s"),
        ).first()
        if row["n"] == 0:
            return spark.createDataFrame([], "node long, component long")
        if tuple(row) == mark:
            break
        mark = tuple(row)
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
