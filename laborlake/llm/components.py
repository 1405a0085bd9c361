"""Connected components of links, by alternating stars, with every round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laborlake.llm.common import written


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked with the node's smallest neighbour (or itself); a row per link at most."""
    least = _both_ways(links).groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("_at"), F.least("a", "m").alias("m"))
    up = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a != b")
    joined = up.join(least, F.col("a") == F.col("_at"))
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked with the smallest of them. Larger ends come first."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("_at"), "m")
    joined = down.join(least, F.col("a") == F.col("_at"))
    # The link with the smallest neighbour is the node's own.
    return joined.select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).distinct()


def _are_stars(links: DataFrame) -> bool:
    """Whether every larger end has one smaller one, which is no larger end itself."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(links.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    counts = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return counts.agg(F.count_if((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)))).first()[0] == 0


def components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node that it reaches) for each node of `links` (a, b) but the smallest of a component.

    `links` is read several times and should be a written table. Stops when only stars are left, whose centres are the
    smallest nodes: after about the logarithm of the longest path.
    """
    links = links.select("a", "b").filter("a != b")
    while True:
        links = written(_small_star(_large_star(links)), "links")
        if _are_stars(links):
            return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
