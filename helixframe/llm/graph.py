"""Connected components of a table of links, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """node, component (least node that its links reach) of links a, b (long).

    Each round every node takes the least label among itself and its neighbours, then the label
    of that label, so paths halve; it ends when no label falls. A round is two joins on nodes,
    and hubs only meet pre-aggregated minima. Self links and repeated links do no harm.
    """
    edges = stored(links.select(F.col("a").alias("x"), F.col("b").alias("y")).union(links.select(F.col("b").alias("x"), F.col("a").alias("y"))).distinct(), small=True)
    labels = edges.groupBy(F.col("x").alias("node")).agg(F.least(F.min("y"), F.col("x")).alias("component"))
    while True:
        near = edges.join(labels, edges["y"] == labels["node"]).groupBy(F.col("x").alias("node")).agg(F.min("component").alias("near"))
        closer = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("label"))
        up = closer.select(F.col("node").alias("label"), F.col("label").alias("above"))
        closer = stored(closer.join(up, "label").select("node", "old", F.least("label", "above").alias("component")), small=True)
        labels = closer.select("node", "component")
        if closer.filter("component < old").isEmpty():
            return labels
