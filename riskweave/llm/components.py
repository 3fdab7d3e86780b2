"""Connected components of a link table, in Spark: smallest label spread and pointer jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import staged


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) of every node in ``links``; a label is the smallest node of its component.

    Each round takes the smallest label among a node and its neighbours, then
    the label's own label. Rounds are written to the shared folder, so lineage
    stays short; their number grows with the logarithm of the longest chain.
    No links give no rows; null ends are ignored.
    """
    pairs = links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a is not null and b is not null")
    both = staged(pairs.union(pairs.select("b", "a")), "links")
    labels = staged(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("label"))
                    .select(F.col("a").alias("node"), "label"), "labels")
    few = labels.count() <= 500_000  # as many in every round
    while True:
        known = F.broadcast(labels) if few else labels
        told = (both.join(known.withColumnRenamed("node", "a"), "a").groupBy("b").agg(F.min("label").alias("told"))
                .withColumnRenamed("b", "node"))
        lower = told.join(known, "node").select("node", F.col("label").alias("old"), F.least("label", "told").alias("label"))
        jump = known.select(F.col("node").alias("label"), F.col("label").alias("up"))
        now = staged(lower.join(jump, "label").select(
            "node", F.least("label", "up").alias("label"), (F.least("label", "up") < F.col("old")).alias("moved")), "labels")
        labels = now.select("node", "label")
        if now.filter("moved").isEmpty():
            return labels
