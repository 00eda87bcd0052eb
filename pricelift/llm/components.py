"""Connected components of a graph that is a DataFrame of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelift.llm.common import stored


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node of edges (a, b): the smallest node it is connected with.

    Each round every node points at its smallest neighbour, pointers are followed once more, and edges
    are drawn between what their ends point at; edges inside one node vanish.  The graph shrinks
    at every round, each round ends in a written table, and nothing but the number of edges left comes
    to the driver.  A node with very many edges is aggregated map-side; joins meet it on the side that
    adaptive execution can split.
    """
    pairs = edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    left = stored(pairs, name)
    labels = None
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = both.groupBy("a").agg(F.min("b").alias("m"))
        first = stored(nearest.select(F.col("a").alias("node"), F.least("a", "m").alias("to")), name)
        again = first.select(F.col("node").alias("to"), F.col("to").alias("further"))
        moved = stored(first.join(again, "to").select("node", F.col("further").alias("to")), name)
        if labels is None:
            labels = moved.select("node", F.col("to").alias("component"))
        else:
            step = moved.select(F.col("node").alias("component"), "to")
            labels = labels.join(step, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
        labels = stored(labels, name)
        ends = [moved.select(F.col("node").alias(c), F.col("to").alias(f"to_{c}")) for c in "ab"]
        drawn = left.join(ends[0], "a").join(ends[1], "b").filter("to_a != to_b")
        left = stored(drawn.select(F.greatest("to_a", "to_b").alias("a"), F.least("to_a", "to_b").alias("b")).distinct(), name)
    if labels is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
