"""Connected components of an edge table, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweir.llm.common import checkpointed


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node in edges (a, b): label is the smallest node of its component.

    A round takes the smallest label among a node's neighbours and its own, then the label of that
    label, so a round at least doubles the reach. Each round is stored; nothing but a count comes to
    the driver.
    """
    edges = checkpointed(edges.select("a", "b").where("a != b").distinct())
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = checkpointed(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("label")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        met = labels.join(near.select(F.col("a").alias("node"), "near"), "node").select("node", "label", F.least("label", "near").alias("next"))
        ahead = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        jumped = checkpointed(met.join(ahead, "next", "left").select("node", F.least("next", F.coalesce("far", "next")).alias("label"), (F.least("next", F.coalesce("far", "next")) != F.col("label")).alias("moved")))
        moving = jumped.where("moved").limit(1).count()
        labels = jumped.select("node", "label")
        if not moving:
            return labels
