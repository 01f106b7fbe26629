"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.keep import keep


def components(edges: DataFrame) -> DataFrame:
    """(node, component): for each end of the edges (a, b), the least node it reaches.

    Labels are the least of the neighbours' labels, then of the label's own label,
    until none changes; both steps are joins whose hot keys Spark can split, and the
    aggregate combines before its shuffle. Each round is kept in the shared folder.
    Rounds grow with the logarithm of the longest path, roughly.
    """
    ends = edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct()
    both = keep(ends, "edges")
    labels = keep(
        both.groupBy(F.col("a").alias("node")).agg(
            F.least(F.col("a"), F.min("b")).alias("component")
        ),
        "labels",
    )
    while True:
        near = (
            both.join(labels, F.col("b") == F.col("node"))
            .groupBy("a")
            .agg(F.min("component").alias("least"))
        )
        lower = labels.join(near, F.col("node") == F.col("a")).select(
            "node",
            F.least("component", "least").alias("component"),
            F.col("component").alias("before"),
        )
        own = labels.select(F.col("node").alias("at"), F.col("component").alias("root"))
        jumped = lower.join(own, F.col("component") == F.col("at")).select(
            "node", F.least("component", "root").alias("component"), "before"
        )
        done = keep(jumped, "labels")
        labels = done.select("node", "component")
        if done.filter("component <> before").isEmpty():
            return labels
