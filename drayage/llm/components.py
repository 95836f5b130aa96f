"""Connected components by alternating large-star and small-star steps."""

from pyspark.sql import DataFrame, functions as F

from ..materialize import Scratch

MAX_ROUNDS = 60


def _stars(edges: DataFrame, small: bool) -> DataFrame:
    """Links the neighbours of each node, on one side of it, to its smallest neighbour.

    The smallest neighbour is found by a grouping that combines on the map side and is joined back, so a node with
    very many links is never gathered in one place; adaptive execution splits it in the join.
    """
    if small:
        near = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    else:
        near = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).select(
            F.col("a").alias("u"), F.col("b").alias("v"))
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = near.join(least, "u")
    if small:
        linked = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    else:
        linked = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return linked.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` -> ``(node, component)`` with the smallest node of each component, for all nodes with an edge.

    Each round is written to the shared folder, which cuts the lineage, and the one before it is removed then. The edges have converged when a round leaves
    the same set; this is seen from its count and an order-free sum of hashes. Self links are left out.
    """
    scratch = Scratch(edges.sparkSession)
    current = scratch.keep(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                           .distinct(), "links")
    seen = None
    for _ in range(MAX_ROUNDS):
        mark = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                current.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
        seen, before = mark, current
        current = scratch.keep(_stars(_stars(current, small=False), small=True), "links")
        scratch.drop(before)
    raise RuntimeError("components have not converged")
