"""Connected components of an edge table, as Spark joins and aggregations."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def connected_components(edges: DataFrame) -> DataFrame:
    """``(a, b)`` edges -> ``(node, root)`` with the smallest node of each component as root.

    Every round takes the smallest label among a node's neighbours, then
    follows label pointers once (a node's label becomes its label's label), so
    long chains halve. Each round is written to the shared folder; only the
    count of changed labels reaches the driver. Nodes without edges are absent.
    """
    both = stage(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                 .where("a <> b").distinct())
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
                   .select("node", F.least("node", "least").alias("root")))
    while True:
        near = (both.join(labels, both.b == labels.node)
                .groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near")))
        hooked = stage(labels.join(near, "node")
                       .select("node", F.col("root").alias("old"), F.least("root", "near").alias("root")))
        up = hooked.select(F.col("node").alias("root"), F.col("root").alias("above"))
        jumped = stage(hooked.join(up, "root").select("node", "old", F.col("above").alias("root")))
        changed = jumped.where("root <> old").limit(1).count()
        labels = jumped.select("node", "root")
        if not changed:
            return labels
