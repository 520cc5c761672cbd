"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of every node of ``edges (a, b)``; the root is its component's smallest node.

    Alternating star contractions: each round links every node's larger neighbours, then its
    smaller ones, to the smallest neighbour, until only stars are left. The number of rounds grows with
    the logarithm of the largest component. Every round is stored, and joins find each node's
    smallest neighbour (combined before the shuffle) beside its edges, so no node's
    neighbours are ever gathered.
    """
    pairs = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now = materialize(pairs.distinct(), "edges")
    while not _stars(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(near, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large, "large-stars")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(low.select("u", F.col("m").alias("v")))
        now = materialize(small.filter("u <> v").distinct(), "small-stars")
    leaves = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return materialize(leaves.unionByName(leaves.select(F.col("root").alias("node"), "root").distinct()), "components")


def _stars(edges: DataFrame) -> bool:
    """Whether every node with a smaller neighbour has just one, which has none itself."""
    sizes = edges.agg(F.count("*").alias("edges"), F.count_distinct("u").alias("nodes")).first()
    if sizes["edges"] != sizes["nodes"]:
        return False
    return edges.join(edges.select(F.col("u").alias("v")), "v", "left_semi").isEmpty()
