"""Connected components of a graph that is given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.common import cut_lineage, drop_written


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, label): label is the smallest node that can be reached; only nodes with links appear.

    Each round takes the smallest label among a node and its neighbours and then
    the label of that label, so that labels travel far in few rounds. All steps
    are joins and minima on written tables: a hub with very many links is
    pre-aggregated in the minima and can be split in the joins. Nulls are no nodes.
    """
    one = links.select(F.col(a).alias("node"), F.col(b).alias("other")).dropna()
    both = one.union(one.select(F.col("other").alias("node"), F.col("node").alias("other"))).filter("node <> other")
    edges = cut_lineage(both.distinct(), "links")
    labels = cut_lineage(edges.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("label")), "labels")
    while True:
        near = edges.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("label").alias("m"))
        lower = cut_lineage(labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "m").alias("label")), "labels")
        far = lower.select(F.col("node").alias("label"), F.col("label").alias("next"))
        new = cut_lineage(lower.join(far, "label", "left").select("node", "old", F.least("label", "next").alias("label")), "labels")
        changed = new.filter("label <> old").limit(1).count()
        for old in (labels, lower):
            drop_written(old)
        labels = new.select("node", "label")
        if not changed:
            drop_written(edges)
            return labels
