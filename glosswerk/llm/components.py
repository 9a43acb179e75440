"""Connected components by alternating large-star and small-star steps.

Both steps replace a node's edges by a star around its smallest neighbour, so
labels reach along chains in a logarithmic number of rounds.  A node's
smallest neighbour comes from a partial aggregation; rows find it by a join
against a written table, whose large keys Spark can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, written


def _settled(edges: DataFrame) -> bool:
    """Whether each node has one edge, to a node that has none of its own."""
    ends = edges.select(F.col("a").alias("x"), F.lit(1).alias("own"), F.lit(0).alias("of")).unionByName(edges.select(F.col("b").alias("x"), F.lit(0).alias("own"), F.lit(1).alias("of")))
    return ends.groupBy("x").agg(F.sum("own").alias("own"), F.max("of").alias("of")).where("own > 1 OR own = 1 AND of = 1").isEmpty()


def _star(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Edges (a, b) with a > b, around the smallest neighbour of each node, itself included."""
    near = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if both_ways else edges
    least = written(near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "component-least")
    rows = near.join(least, "a")
    if both_ways:
        out = rows.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = rows.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    out = written(out.where("a <> b").distinct(), "component-edges")
    forget(least)
    return out


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge, as a written table; ``edges`` has two long columns, a and b.

    The root is the smallest node of the component.  Nulls aren't nodes;
    edges from a node to itself and repeated edges don't matter; no edges give an
    empty table.
    """
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "component-edges")
    while not _settled(now):
        large = _star(now, both_ways=True)
        forget(now)
        now = _star(large, both_ways=False)
        forget(large)
    # at the fixed point each node has one edge, to its component's smallest node
    out = written(now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()), "component-roots")
    forget(now)
    return out
