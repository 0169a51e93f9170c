"""Connected components of an undirected graph, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for the nodes of ``edges`` (columns ``a, b``): the smallest node that each can reach.

    Every round takes the smallest label among neighbours and then the label of
    that label, so that distances halve: rounds grow with the logarithm of the
    longest path. Each round is stored in the shared folder, which keeps the
    plan short. Nothing but the news whether a label changed reaches the driver.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    links = stored(both.where("a != b").distinct(), "links")
    first = links.groupBy("a").agg(F.min("b").alias("m"))
    labels = stored(first.select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels")
    while True:
        seen = links.join(labels, links["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("m"))
        lower = labels.join(seen, labels["node"] == seen["a"]).select(
            "node", F.col("label").alias("old"), F.least("label", "m").alias("label")
        )
        # The label of a large component is a skewed key, which adaptive execution splits if both sides are scans.
        lower = stored(lower, "lower")
        jump = lower.select(F.col("node").alias("label"), F.col("label").alias("further"))
        labels = stored(
            lower.join(jump, "label", "left").select(
                "node", "old", F.coalesce(F.least("label", "further"), "label").alias("label")
            ),
            "labels",
        )
        if labels.where("old != label").isEmpty():
            return labels.select("node", "label")
