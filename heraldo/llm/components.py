"""Connected components of an edge table, by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import persisted


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of edges (a, b): component is the smallest node reachable.

    Each round takes the least label among a node and its neighbours, then the label of that label. Rounds end when no
    label changes; near-duplicate groups need a handful. Labels are written to the shared folder each round. Sums over
    neighbours are pre-aggregated, so a node with a very large neighbourhood costs one partial row per task.
    """
    both = persisted(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = persisted(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("component")), "labels")
    for _ in range(max_rounds):
        near = both.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        lower = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("root"))
        new = persisted(lower.join(jump, "component", "left").select("node", "old", F.least("component", F.coalesce("root", "component")).alias("component")), "labels")
        changed = new.where("component <> old").limit(1).count()
        labels = new.select("node", "component")
        if not changed:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return labels
