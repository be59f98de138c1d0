"""Connected components of a link table, by least labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterhouse.session import write_and_read


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b); label is the least node of its component.

    Each round takes the least label among the neighbours and then the label of that label, so paths
    shrink geometrically. All joins have plain shuffles on both sides, which lets AQE split a label
    that holds a large share of the nodes. Every round is a written table.
    """
    pairs = links.where("a <> b")
    both = pairs.select("a", "b").union(pairs.select(F.col("b"), F.col("a"))).distinct()
    edges = write_and_read(both, "links")
    labels = write_and_read(
        edges.groupBy(F.col("a").alias("node"))
        .agg(F.min("b").alias("least"))
        .select("node", F.least("node", "least").alias("label")),
        "labels",
    )
    while True:
        near = (
            edges.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        lowered = write_and_read(
            labels.join(near, "node").select(
                "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
            ),
            "labels",
        )
        target = lowered.select(F.col("node").alias("label"), F.col("label").alias("next"))
        labels = write_and_read(
            lowered.join(target, "label").select("node", F.col("next").alias("label"), "old"),
            "labels",
        )
        if labels.where("label <> old").isEmpty():
            return labels.select("node", "label")
        labels = labels.select("node", "label")
