"""Connected components over tables of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node that each linked node reaches, from links (a, b).

    Every round takes the smallest label of the neighbours and then that label's own label, so the number of rounds grows
    with the logarithm of the longest path. A node with very many neighbours is met by joins and
    sums only, never as a group.
    """
    pairs = materialise(
        links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct().toDF("node", "near"),
        "links",
    )
    labels = materialise(
        pairs.groupBy("node").agg(F.min("near").alias("m")).select("node", F.least("node", "m").alias("label")),
        "labels",
    )
    while True:
        reached = (
            pairs.join(labels.toDF("near", "label"), "near")
            .groupBy("node")
            .agg(F.min("label").alias("m"))
        )
        lower = materialise(
            labels.join(reached, "node", "left").select(
                "node", F.col("label").alias("was"), F.least("label", "m").alias("label")
            ),
            "labels-near",
        )
        jumped = materialise(
            lower.join(lower.select(F.col("node").alias("label"), F.col("label").alias("further")), "label", "left")
            .select("node", "was", F.least("label", "further").alias("label")),
            "labels-far",
        )
        moved = jumped.where("label <> was").limit(1).count()
        discard(labels, lower)
        labels = jumped.select("node", "label")
        if not moved:
            discard(pairs)
            return labels
