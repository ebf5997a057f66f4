"""Connected components of an undirected graph held as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerproof.llm.base import stored


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) of every node in links (a, b): component is the smallest node that can be reached.

    Alternates large-star and small-star steps (each hooks a node's neighbours to its smallest one) until nothing changes.
    Smallest neighbours are taken with map-side combination and joined back, so a node with a third of all links is fine.
    """
    links = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    for _ in range(most_rounds):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = stored(both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct(), "large-star")
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.col("b").alias("x"), F.col("low").alias("y")).where("x <> y").unionByName(low.select(F.col("a").alias("x"), F.col("low").alias("y")))
        after = stored(small.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), "small-star")
        # Done when every node has one link (no node has two roots) and no target is itself linked on: all components are stars.
        flat = after.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty() and after.join(after.select(F.col("a").alias("t")), F.col("b") == F.col("t"), "left_semi").isEmpty()
        links = after
        if flat:
            break
    else:
        raise RuntimeError("components did not settle")
    stars = links.groupBy("a").agg(F.min("b").alias("b"))
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
