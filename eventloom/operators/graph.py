"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.session import settle


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of `edges` (a, b); comp is the smallest node that is reachable.

    Each round takes the smallest label among neighbours and then that label's own label, so rounds
    grow with the logarithm of the longest path; rounds are tables in the shared folder.
    """
    ways = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))  # edges are worked out once
    both = settle(edges.select(F.explode(ways).alias("e")).select("e.a", "e.b").distinct(), "edges")
    labels = settle(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("comp")), "labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        lower = settle(labels.join(near, "node").select("node", "comp", F.least("comp", "near").alias("low")), "lower")
        own = lower.select(F.col("node").alias("target"), F.col("low").alias("lowest"))
        new = settle(lower.join(own, F.col("low") == F.col("target")).select("node", "comp", F.least("low", "lowest").alias("new")), "labels")
        labels = new.select("node", F.col("new").alias("comp"))
        if new.filter("new <> comp").isEmpty():
            return labels
