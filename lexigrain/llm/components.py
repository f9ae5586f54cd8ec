"""Connected components of a table of edges, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of ``edges``; a component is named by its smallest node.

    In each round every node joins its neighbour of the smallest random number, unless its own
    is smaller; edges then run between those that were joined, and edges inside fall away. The
    numbers are drawn anew each round, so the nodes left shrink by a constant factor whatever
    the graph's shape. Neighbours are only ever compared by partial aggregation, so a node with
    very many of them is no single task's work.
    """
    left = staged(edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a <> b").distinct(), "edges")
    nodes = left.select(F.col("a").alias("node")).union(left.select("b")).distinct()
    label = staged(nodes.select("node", F.col("node").alias("at")), "labels")
    seed = 0
    while not left.isEmpty():
        seed += 1
        draw = lambda c, s=seed: F.struct(F.xxhash64(F.lit(s), F.col(c)).alias("r"), F.col(c).alias("node"))
        both = left.union(left.select("b", "a"))
        least = both.groupBy("a").agg(F.min(draw("b")).alias("near")).select("a", F.least(draw("a"), "near")["node"].alias("to"))
        least = staged(least, "joined")
        label = staged(
            label.join(least.withColumnRenamed("a", "at"), "at", "left").select("node", F.coalesce("to", "at").alias("at")), "labels",
        )
        moved = left.join(least, "a").select(F.col("to").alias("x"), F.col("b").alias("a")).join(least, "a").select("x", F.col("to").alias("y"))
        left = staged(moved.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    names = label.groupBy("at").agg(F.min("node").alias("component"))
    return label.join(names, "at").select("node", "component")
