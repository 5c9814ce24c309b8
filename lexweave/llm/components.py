"""Connected components of accepted pairs by alternating large and small stars.

Every round is two aggregations and two joins on the node, whatever the size of
a component: no node's neighbours are gathered in one place. A round's edges
are written to the shared folder, so lineage stays short and a lost executor
costs one round at most. Rounds grow with the logarithm of the longest chain;
edges that are stars around their least nodes, as those of names are, take none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import durable


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Connect each node's greater (or lesser) neighbours to the least node that it knows."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = both.where("b < a")
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    told = both.join(least.hint("merge"), "a")  # what grows isn't gathered by the driver
    if large:
        out = told.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # The node itself learns the least through its neighbour's view.
        return out.where("a <> b").distinct()
    out = told.select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return out.union(own).where("a <> b").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether the edges are stars around their least nodes: no greater end has two lesser ones or is one itself."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(edges.select("b", F.lit(0), F.lit(1))).groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.where("up + down > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the component is its least node. ``edges`` has columns a and b; lone nodes don't appear."""
    current = durable(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    while not _settled(current):  # every round shortens the longest chain, so this ends
        current = durable(_star(_star(current, True), False))
    roots = current.select(F.col("b").alias("node")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )
