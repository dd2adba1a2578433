"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import forget, keep


def _pairs(links: DataFrame, high: str, low: str) -> DataFrame:
    return links.select(F.col(high).alias("high"), F.col(low).alias("low")).where("high > low").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest node it reaches) for each node of ``links``
    (columns ``x`` and ``y``, of any ordered type; loops are left out).

    Each step is an aggregate and a join, so a node with very many links is a hot key that
    partial sums and adaptive joins take apart; no neighbourhood is gathered. Every round is
    written to the shared folder, and the one before it deleted. A link with a null end is left out.
    """
    links = keep(_pairs(links.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")), "x", "y"))
    before = None
    while True:
        # large star: what a node has above it moves to the smallest node around
        both = links.union(links.select("low", "high")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _pairs(both.where("v > u").join(least, "u"), "v", "m")
        # small star: what a node has below it, and the node itself, move to the smallest below
        least = large.groupBy("high").agg(F.min("low").alias("m"))
        joined = large.join(least, "high")
        former, links = links, keep(_pairs(joined.select("low", "m").union(joined.select("high", "m")), "low", "m"))
        forget(former)
        now = links.agg(F.count("*"), F.bit_xor(F.xxhash64("high", "low")), F.sum(F.hash("high", "low").cast("long"))).first()
        if now == before:
            break
        before = now
    nodes = links.select(F.col("high").alias("node"), F.col("low").alias("component"))
    return nodes.union(links.select("low", "low").distinct())
