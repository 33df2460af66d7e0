"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.scratch import stored


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node each node can reach, for all nodes that an edge to another node touches.

    Alternates two steps until nothing changes: each node's neighbours are tied to the smallest of them, first for
    the larger neighbours, then for the smaller ones. Every round is one aggregation and one join, distinct edges
    only, written to the shared folder; rounds grow with the logarithm of the longest path. Nodes of very many edges
    meet as aggregates, and AQE may split them in the join. Nulls and edges from a node to itself tie nothing.
    """
    u, v = F.greatest(a, b), F.least(a, b)
    now = stored(edges.filter(F.col(a) != F.col(b)).select(u.alias("u"), v.alias("v")).distinct(), "edges")
    while True:
        # Large star: each neighbour above a node goes to the smallest of the node and its neighbours.
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("low")).select(F.col("u").alias("w"), F.least("low", "u").alias("low"))
        large = (both.join(least, F.col("u") == F.col("w")).filter(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("low").alias("v")).filter("u != v").distinct())
        # Small star: each neighbour below a node, and the node itself, go to the smallest neighbour.
        least = large.groupBy("u").agg(F.min("v").alias("low")).select(F.col("u").alias("w"), "low")
        small = (large.join(least, F.col("u") == F.col("w"))
                 .select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("low").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("low").alias("v")))).alias("e"))
                 .select("e.u", "e.v").filter("u != v").distinct())
        then = stored(small, "edges")
        same = then.count() == now.count() and then.join(now, ["u", "v"], "left_anti").isEmpty()
        now = then
        if same:
            break
    roots = now.groupBy("u").agg(F.min("v").alias("component"))
    return roots.select(F.col("u").alias("node"), "component").unionByName(
        roots.select(F.col("component").alias("node"), "component").distinct())
