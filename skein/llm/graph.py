"""Connected components by repeated contraction of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (u, v: long); a component is named by its smallest node.

    In each round every node points to its smallest neighbour if that is smaller, pointers are
    followed twice, and edges are contracted to what they point to; cliques and stars vanish in one
    round, a path of n nodes in O(log n). Each round's state is written to the shared folder. The
    smallest neighbour is an aggregate with map-side combining, so a hub is no hot task.
    """
    edges = materialize(edges.select("u", "v").filter("u <> v").distinct(), "edges")
    named = materialize(edges.select(F.col("u").alias("node")).union(edges.select("v")).distinct()
                        .select("node", F.col("node").alias("component")), "components")
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        to = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("to"))
        to = materialize(to, "pointers")
        for _ in range(2):
            far = to.select(F.col("u").alias("to"), F.col("to").alias("far"))
            to = to.join(far, "to", "left").select("u", F.coalesce("far", "to").alias("to"))
        to = materialize(to, "pointers")
        named = materialize(named.join(to.withColumnRenamed("u", "component"), "component", "left")
                            .select("node", F.coalesce("to", "component").alias("component")), "components")
        moved = edges.join(to.withColumnRenamed("to", "a"), "u").select("a", F.col("v").alias("u"))
        moved = moved.join(to.withColumnRenamed("to", "b"), "u").filter("a <> b")
        edges = materialize(moved.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), "edges")
    return named
