"""Connected components over a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shopstar.llm.tables import Spool


def components(links: DataFrame, spool: Spool, name: str) -> DataFrame:
    """(node, label) for every node of `links` (a, b); label is the smallest node reachable.

    Each round every node takes the smallest label among its neighbours and then
    the label of that label, so long chains shorten by halves. Only sums and
    minima cross the shuffle for a node with many links; nothing is collected
    but the number of changed labels. No links give an empty table.
    """
    edges = spool.write(
        links.select(F.col("a").alias("node"), F.col("b").alias("other"))
        .unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("other"))),
        f"{name}-edges")
    labels = spool.write(
        edges.groupBy("node").agg(F.min("other").alias("_low"))
        .select("node", F.least("node", "_low").alias("label")), f"{name}-0")
    step = 0
    while True:
        offered = (
            edges.join(labels, "node").groupBy(F.col("other").alias("node"))
            .agg(F.min("label").alias("_offer")))
        lower = labels.join(offered, "node").select(
            "node", F.col("label").alias("_was"), F.least("label", "_offer").alias("_near"))
        root = labels.select(F.col("node").alias("_near"), F.col("label").alias("_far"))
        step += 1
        moved = spool.write(
            lower.join(root, "_near").select(
                "node", F.least("_near", "_far").alias("label"), "_was"), f"{name}-{step}")
        changed = moved.filter(F.col("label") != F.col("_was")).limit(1).count()
        spool.drop(f"{name}-{step - 1}")
        labels = moved.drop("_was")
        if not changed:
            spool.drop(f"{name}-edges")
            return labels
