"""Connected components of a link table, by alternating stars over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _nearest(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the node's smallest neighbour or itself."""
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    found = both.join(_nearest(both), "u").where("v > u")
    return found.select(F.col("v").alias("u"), F.least("u", "m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them. Links go from the larger end."""
    found = links.join(_nearest(links), "u")
    hung = found.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(found.select("u", F.col("m").alias("v")))
    return hung.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node) of every node that has a link. ``links``: u, v, long, not null.

    A round is two stars; the links are written after each, and the rounds end when they stay as they are, at
    a star of every component: after a number of rounds that grows with the logarithm of the longest chain.
    """
    links = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    before = None
    while True:
        links = materialize(links, "links")
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        links = _small_star(_large_star(links).where("u <> v").distinct())
    nodes = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
