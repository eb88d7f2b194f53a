"""Connected components of an edge table by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import discard, settle


def components(edges: DataFrame) -> DataFrame:
    """(node, comp, moved) for every node of `edges` (a, b), a settled table; comp is the smallest node that is reachable.

    A round takes the smallest label among the neighbours, by partial aggregation, then follows
    labels to their own labels, so the rounds grow with the logarithm of the longest path. Each
    round is a table; nothing of the size of the graph reaches the driver. `moved` is false in the end.
    """
    both = settle(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = settle(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("comp")), "labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        lower = settle(labels.join(near, "node").select("node", "comp", F.least("comp", "near").alias("low")), "lower")
        jump = lower.select(F.col("node").alias("target"), F.col("low").alias("lowest"))
        least = F.least("low", "lowest")
        new = lower.join(jump, F.col("low") == F.col("target")).select("node", least.alias("comp"), (least != F.col("comp")).alias("moved"))
        new = settle(new, "labels")
        discard(lower, labels)
        labels = new
        if new.filter("moved").isEmpty():
            discard(both)
            return labels
