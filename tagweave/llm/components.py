"""Connected components of an edge table by min-label contraction, on DataFrames alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.llm.common import materialize


def connected(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges (a, b)``; the component is its least node.

    Large-star and small-star steps in turn: each node links its neighbours to the least of
    them, so that paths shrink geometrically. Per step the least neighbour is a map-side
    combined minimum and is joined back, so no neighbourhood is ever gathered; it is written
    first, so that both sides of the join are shuffled for it and a hub can be split. Each step
    is written to the shared folder, which cuts the lineage. Nulls and loops are ignored.
    """
    both = edges.select("a", "b").where("a is not null and b is not null")
    pairs = materialize(both.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    loops = both.where("a = b").select(F.col("a").alias("node"))
    nodes = both.select(F.col("a").alias("node")).unionByName(both.select(F.col("b").alias("node"))).unionByName(loops).distinct()
    if pairs.isEmpty():
        return nodes.select("node", F.col("node").alias("component"))
    before = None
    while True:
        pairs = materialize(_small_star(_large_star(pairs)), "star")
        # Both steps keep the node set, and every change lowers the sum of the parents or drops an edge.
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return nodes.join(pairs.select(F.col("a").alias("node"), F.col("b").alias("component")), "node", "left").select(
        "node", F.coalesce("component", "node").alias("component")
    )


def _large_star(pairs: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the least node of its neighbourhood."""
    ways = pairs.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(pairs.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = materialize(ways.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    # The larger neighbours of u are the rows whose smaller end is u.
    larger = pairs.select(F.col("b").alias("u"), F.col("a").alias("v"))
    return larger.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """Link each smaller neighbour of a node, and the node, to the least of them."""
    least = materialize(pairs.groupBy("a").agg(F.min("b").alias("m")), "least")
    joined = pairs.join(least, "a")
    linked = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
