"""Connected components of a graph given as rows of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import checkpoint_root


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for each node of ``links`` (a, b), both long; a component's smallest node names it.

    Every round a node takes the smallest label around it and then the label of its label, so stars
    and short chains settle in two or three rounds and long chains in about the logarithm of their
    length. Labels and links are read from checkpoints, so both sides of each join have an exchange
    of their own and AQE can split the links of a hub.
    """
    checkpoint_root(links.sparkSession)
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a != b").distinct().checkpoint()
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("label")).select("node", "label").checkpoint()
    for _ in range(rounds):
        around = both.join(labels, F.col("a") == F.col("node")).groupBy("b").agg(F.min("label").alias("seen"))
        lower = labels.join(around, F.col("node") == F.col("b"), "left").select(
            "node", F.col("label").alias("old"), F.least("label", "seen").alias("label")
        )
        hop = labels.select(F.col("node").alias("via"), F.col("label").alias("next"))
        moved = lower.join(hop, F.col("label") == F.col("via"), "left").select(
            "node", F.least("label", "next").alias("label"), (F.least("label", "next") != F.col("old")).alias("moved")
        ).checkpoint()
        labels = moved.select("node", "label")
        if moved.filter("moved").isEmpty():
            return labels.withColumnRenamed("label", "component")
    raise RuntimeError(f"no fixed point after {rounds} rounds")
