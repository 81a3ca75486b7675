"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyframe.llm.common import materialise


def _least(edges: DataFrame) -> DataFrame:
    """``u, m``: the smallest neighbour of each node, merged inside each task first."""
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    least = _least(down)
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node has one link downwards, or only links from above: then no step changes anything."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up"))
    )
    each = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return each.where("down > 1 OR (down > 0 AND up > 0)").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node with a link, from links ``u, v`` (any order, any number of times).

    The component is its smallest node. Links with a null end or to itself say nothing and are
    left out. Each round is written to the shared folder, so lineage stays short; the rounds end
    once only stars are left, after a number of them that grows with the logarithm of the nodes.
    """
    at = edges.select("u", "v").where("u <> v")
    while True:
        at = materialise(small_star(large_star(at)), "stars")
        if _is_stars(at):
            break
    roots = at.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return at.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
