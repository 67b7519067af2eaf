"""Connected components of a graph given as edges, by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.workspace import apart, removed, written


def components(edges: DataFrame) -> DataFrame:
    """node, component (its least node) for every node of ``edges`` (a, b: long).

    Each round a node takes the least label among its neighbours, then the label of that label, so the
    rounds grow with the logarithm of a component's diameter. Joins meet one row per node on one side,
    so that a node with countless edges can be split. Every round is a written table, which the next one replaces.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a != b").distinct()
    both = written(both, "links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("component")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("component").alias("least"))
        stepped = labels.join(near, F.col("node") == F.col("a")).select(
            "node", F.col("component").alias("before"), F.least("component", "least").alias("label")
        )
        target = apart(stepped).select(F.col("node").alias("at"), F.col("label").alias("its_label"))
        jumped = stepped.join(target, F.col("label") == F.col("at"), "left").select(
            "node", "before", F.least("label", F.coalesce("its_label", "label")).alias("component")
        )
        moved = written(jumped, "labels")
        removed(labels)
        labels = moved.select("node", "component")
        if moved.where("component != before").isEmpty():
            removed(both)
            return labels
