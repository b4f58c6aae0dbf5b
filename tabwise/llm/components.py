"""Connected components of a link table, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwise.llm.common import durable


def components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for every node of ``links`` (a, b).

    Each round joins nodes to the smallest neighbour they know of; the links
    shrink to stars around the smallest nodes in a number of rounds that grows
    with the logarithm of the number of nodes. Every round is written to the
    checkpoint folder. A node with many links is only ever aggregated by minimum
    (combined before the shuffle) and joined to that single value. Null nodes
    and self links are ignored; repeated links count once.
    """
    edges = durable(links.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))
                    .filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))).distinct())
    nodes = durable(edges.select(F.explode(F.array("high", "low")).alias("node")).distinct())
    while True:
        # Large star: every larger neighbour to the smallest of the neighbourhood.
        both = edges.select(F.col("high").alias("node"), F.col("low").alias("other")).unionAll(
            edges.select(F.col("low").alias("node"), F.col("high").alias("other")))
        least = both.groupBy("node").agg(F.min("other").alias("m")).select(
            "node", F.least("node", "m").alias("m"))
        large = (both.filter(F.col("other") > F.col("node")).join(least, "node")
                 .select(F.col("other").alias("high"), F.col("m").alias("low")).distinct())
        # Small star: every smaller neighbour, and the node, to the smallest of them.
        small_least = large.groupBy("high").agg(F.min("low").alias("m"))
        small = (large.join(small_least, "high")
                 .select(F.explode(F.array(F.struct(F.col("low").alias("high"), F.col("m").alias("low")),
                                           F.struct(F.col("high"), F.col("m").alias("low")))).alias("e"))
                 .select("e.high", "e.low").filter(F.col("high") != F.col("low")).distinct())
        new = durable(small)
        # Both sides are sets: equal sizes and nothing new means a fixed point.
        changed = new.join(edges, ["high", "low"], "left_anti").limit(1).count() or new.count() != edges.count()
        edges = new
        if not changed:
            break
    return nodes.join(edges.groupBy("high").agg(F.min("low").alias("low")), F.col("node") == F.col("high"), "left").select(
        "node", F.coalesce("low", "node").alias("component"))
