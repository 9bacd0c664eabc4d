"""Connected components of a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm._common import materialise


def components(links: DataFrame, name: str) -> DataFrame:
    """(node, label) for every node of ``links`` (columns a, b): label is the smallest node
    that links reach.

    Each round hooks every node to its smallest neighbour, follows the hooks to their roots
    (pointer jumping, which halves long chains), and replaces the links by those between
    different roots, once each; a few rounds leave none. Rounds are cut by written tables.
    All joins are plain joins that Spark may split where one node has many links.
    """
    low, high = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    links = materialise(links.where("a <> b").select(low, high).distinct(), f"{name}-links")
    labels = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = materialise(both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("node"), F.least("a", "m").alias("up")), f"{name}-hooks")
        while True:
            jump = materialise(up.join(up.select(F.col("node").alias("of"), F.col("up").alias("root")), F.col("up") == F.col("of"))
                               .select("node", F.col("up").alias("old"), F.col("root").alias("up")), f"{name}-hooks")
            up = jump.select("node", "up")
            if jump.where("old <> up").isEmpty():
                break
        if labels is None:
            labels = up.select("node", F.col("up").alias("label"))
        else:
            to = up.select(F.col("node").alias("of"), "up")
            labels = materialise(labels.join(to, F.col("label") == F.col("of"), "left").select(
                "node", F.coalesce("up", "label").alias("label")), f"{name}-labels")
        a, b = (up.select(F.col("node").alias(f"of_{c}"), F.col("up").alias(f"up_{c}")) for c in ("a", "b"))
        links = links.join(a, F.col("a") == F.col("of_a")).join(b, F.col("b") == F.col("of_b")).where("up_a <> up_b")
        links = materialise(links.select(F.least("up_a", "up_b").alias("a"), F.greatest("up_a", "up_b").alias("b")).distinct(), f"{name}-links")
        if links.isEmpty():
            return labels
