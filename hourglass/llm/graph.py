"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.llm.storage import written


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (the smallest node reachable) for the nodes of ``edges`` (a, b).

    Every round hooks each node to its smallest neighbour, jumps one pointer, and contracts the edges; the
    rounds end when no edge joins two labels. Edges and labels stay in written tables; only the number of
    edges left comes to the driver. A node with very many edges is one partial minimum per task, and the
    lookups are joins that AQE can split.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    left = written(both.filter("a <> b").distinct(), "edges")
    labels = None
    while not left.isEmpty():
        hook = left.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("up"))
        hook = written(hook, "hooks")
        over = hook.select(F.col("node").alias("up"), F.col("up").alias("top"))
        step = written(hook.join(over, "up").select("node", F.col("top").alias("label")), "labels")
        if labels is None:
            labels = step.select("node", F.col("label").alias("component"))
        else:
            moved = step.select(F.col("node").alias("component"), F.col("label").alias("to"))
            labels = written(labels.join(moved, "component", "left").select(
                "node", F.coalesce("to", "component").alias("component")), "components")
        ends = step.select(F.col("node").alias("a"), F.col("label").alias("la"))
        other = step.select(F.col("node").alias("b"), F.col("label").alias("lb"))
        left = written(left.join(ends, "a").join(other, "b").filter("la <> lb").select(
            F.col("la").alias("a"), F.col("lb").alias("b")).distinct(), "edges")
    if labels is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
