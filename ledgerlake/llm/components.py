"""Connected components of an edge table by smallest labels and pointer jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for each node of ``edges`` (a, b): label is the smallest node of its component.

    In each round a node takes the smallest label around it and then that label's own label, so paths
    halve. The labels are written after each round; minima are combined before each shuffle, and the
    many edges of one node meet one label row in a join that Spark can split.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).filter("a != b").distinct()
    both = materialize(both, "components-edges")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
                         .select("node", F.least("node", "low").alias("label")), "components-labels")
    while True:
        around = (both.join(labels.withColumnsRenamed({"node": "b", "label": "l"}), "b").groupBy(F.col("a").alias("node"))
                  .agg(F.min("l").alias("low")))
        near = labels.join(around, "node").select("node", "label", F.least("label", "low").alias("next"))
        jump = near.select(F.col("node").alias("next"), F.col("next").alias("far"))
        moved = materialize(near.join(jump, "next").select("node", F.least("next", "far").alias("label"),
                                                           (F.least("next", "far") != F.col("label")).alias("moved")), "components-labels")
        labels = moved.select("node", "label")
        if moved.filter("moved").isEmpty():
            return labels
