"""Connected components of a table of links, as joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlens.session import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable, for every node of ``links`` (columns a, b of one ordered type).

    Every round takes the smallest label among the neighbours and then the label of the label, so long chains shorten
    fast. Each round is stored in the shared folder; a lost executor costs one round at most. A node with very many
    links only meets one row of the other side, so adaptive execution can split it.
    """
    both = links.where("a <> b").select("a", "b")
    both = materialize(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")),
                         "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")) \
            .agg(F.min("label").alias("near"))
        step = labels.join(near, "node").select("node", F.least("label", "near").alias("next"),
                                                F.col("label").alias("old"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        step = step.join(jump, "next", "left").select(
            "node", F.least(F.col("next"), F.coalesce("far", "next")).alias("label"), "old")
        step = materialize(step, "labels")
        moved = step.where("label <> old").limit(1).count()
        labels = step.select("node", "label")
        if not moved:
            return labels
