"""Connected components of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.session import settle


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a, b) that is not itself the smallest of its component.

    Every step rewires each node's links to its smallest neighbour; nodes and links stay distributed, and
    each step's links are written to the shared folder. The number of steps grows with the logarithm of
    the longest path.
    """
    edges = settle(
        links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = settle(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")))
        large = settle(
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        )
        least = settle(large.groupBy("u").agg(F.min("v").alias("m")))
        low = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        edges = settle(low.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        before, state = state, _state(edges)
        if before == state:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
