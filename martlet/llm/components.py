"""Connected components of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import land


def _signature(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003)).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (a, b); the root is the least node of the component.

    Large star links each node's larger neighbours to its least neighbour, small star its smaller
    ones; both keep components, and they end in stars around the roots. A node with very many
    neighbours is one key of a minimum, which is aggregated before the shuffle, and of a join, whose
    skewed side Spark splits (the minima are landed, since it splits only what the join itself shuffles). Each round
    is landed, so a lost executor costs part of one round.
    """
    ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    now = land(ordered, "links")
    before, seen = None, _signature(now)
    while seen != before and seen[0]:
        now = land(_small_star(land(_large_star(now), "links")), "links")
        before, seen = seen, _signature(now)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = land(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Links come with a > b."""
    least = land(links.groupBy("a").agg(F.min("b").alias("m")), "least")
    to_least = links.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return to_least.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
