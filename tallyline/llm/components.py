"""Connected components of a graph of links, as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.session import materialize


def components(links: DataFrame) -> DataFrame:
    """Rows (node, component) for the ends of ``links`` (columns a, b); a component is named
    after its smallest node. Every round takes the smallest label among the neighbours and
    then the label of one's label, so chains shorten by half. All tables stay distributed
    and every round is written, so a lost executor costs one round at most."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = materialize(both.filter("a != b").distinct(), "edges")
    nodes = edges.select(F.col("a").alias("node")).distinct()
    labels = materialize(nodes.withColumn("component", F.col("node")), "labels")
    while True:
        near = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("component").alias("near"))
        near = materialize(near, "near")
        lower = labels.join(near, labels["node"] == near["a"]).select(
            "node", F.col("component").alias("before"), F.least("component", "near").alias("component")
        )
        lower = materialize(lower, "lower")
        # The label of the label; a label is always a node.
        up = lower.select(F.col("node").alias("component"), F.col("component").alias("up"))
        jumped = lower.join(up, "component").select("node", "before", F.least("component", "up").alias("component"))
        jumped = materialize(jumped, "labels")
        labels = jumped.select("node", "component")
        if jumped.filter("before != component").isEmpty():
            return labels
