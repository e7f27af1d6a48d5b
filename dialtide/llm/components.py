"""Connected components of a graph held as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """node and label (the smallest node of its component) of every node in ``edges`` (a, b).

    Labels spread to neighbours, then each node takes the label of its label,
    which halves long paths. Every step is stored in the shared folder.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).distinct()
    both = materialize(both, "component-edges")
    labels = materialize(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select(
            "node", F.least("node", "low").alias("label")
        ),
        "component-labels",
    )
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("low")), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("low").alias("low"))
        )
        spread = labels.join(near, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "low").alias("label")
        )
        spread = materialize(spread, "component-spread")
        onward = spread.select(F.col("node").alias("label"), F.col("label").alias("further"))
        moved = spread.join(onward, "label").select("node", "old", F.least("label", "further").alias("label"))
        labels = materialize(moved, "component-labels")
        if labels.filter("label <> old").isEmpty():
            return labels.select("node", "label")
