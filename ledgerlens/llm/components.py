"""Connected components of an edge table by label propagation with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import stored


def connected(edges: DataFrame) -> DataFrame:
    """node, label (the smallest node of its component) for every node of edges (a, b).

    Each round takes the smallest label among a node's neighbours and then the
    label of that label, so paths shorten by half or more; rounds are written
    to the shared folder, and the loop ends when no label changes.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnsRenamed({"node": "b"}), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lower = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("top"))
        done = stored(lower.join(up, "label", "left").select("node", "old", F.coalesce("top", "label").alias("label")), "labels")
        if not done.where("old <> label").head(1):
            return done.select("node", "label")
        labels = done.select("node", "label")
