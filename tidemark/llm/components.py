"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import dropped, settled


def _stars(links: DataFrame, small: bool) -> DataFrame:
    """Tie the neighbours of each node to the least of them: those below the node (small) or above it."""
    sides = links if small else links.union(links.select("b", "a"))
    least = sides.groupBy("a").agg(F.min("b").alias("__low")).select(F.col("a"), F.least("a", "__low").alias("low"))
    met = sides.join(least, "a")
    if small:
        return met.select(F.col("b").alias("a"), F.col("low").alias("b")).union(least.select("a", F.col("low").alias("b"))).where("a <> b").distinct()
    return met.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, component (the least node that can be reached) for each node of links (a, b).

    Alternating large and small stars: each round is a few shuffles of the links, the number of rounds grows with the
    logarithm of the longest path, and a node with very many links only costs a partial minimum and a join.
    """
    links = settled(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    state = None
    while True:
        before, links = links, settled(_stars(_stars(links, small=False), small=True), "links")
        dropped(before)
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            found = settled(links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(links.select("b", "b").distinct()), "components")
            dropped(links)
            return found
        state = now
