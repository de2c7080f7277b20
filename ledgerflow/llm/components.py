"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` -> ``(node, component)``, the least node of each component,
    for every node with an edge to another one.

    Each round hooks all neighbours of a node to the least of them: the larger
    ones first, then the smaller ones; rounds grow with the logarithm of the
    longest path, and edges never get more.  A round begins with the least and
    the largest neighbour of every node (counted before the shuffle): where each
    node that has a lesser neighbour has no other one, all components are stars
    and done.  Every round's edges are written to the shared folder; only that
    answer reaches the driver.  The least neighbours are written before they are
    joined, so the join reads two plain shuffles and adaptive execution splits the
    edges of a hub.
    """
    now = staged(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), "edges")
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = staged(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"), F.max("v").alias("most")), "least")
        if least.filter("m < u and most > m").isEmpty():
            return least.select(F.col("u").alias("node"), F.col("m").alias("component"))
        large = staged(both.join(least.select("u", "m"), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")), "large")
        low = staged(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        now = staged(large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                     .unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
