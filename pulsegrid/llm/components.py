"""Connected components of a table of links, by alternating stars.

In each round every node first sends its larger neighbours to its least neighbour (large star), then its smaller
ones (small star). Paths shrink fast, and a node with many neighbours costs a sum, not a pair for each two. Rounds
are cut by stored tables. No links or labels reach the driver, only a count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.storage import stored

MOST_ROUNDS = 100


def _both(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _settled(edges: DataFrame) -> bool:
    """Whether all links (a, b) are stars: a node ends one link, or is the centre of others."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("centre")).union(
        edges.select("b", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg((F.sum("up") + F.max("centre")).alias("roles")).where("roles > 1").count() == 0


def stars(links: DataFrame) -> DataFrame:
    """node, component (its least reachable node) for the nodes of links (a, b), without those that are the least."""
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .distinct(), "links")
    for _ in range(MOST_ROUNDS):
        both = _both(edges)
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        # Large star: larger neighbours go to the least node around. Equal rows go when the round ends, not by a
        # shuffle of their own here. Stored, as the small star reads it twice.
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.where("a <> b"), "links")
        # Small star: a node and its smaller neighbours go to the least of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("m").alias("y")),
                              F.struct(F.col("b").alias("x"), F.col("m").alias("y")))).alias("s")
        ).select(F.col("s.x").alias("a"), F.col("s.y").alias("b")).where("a <> b").distinct()
        edges = stored(small, "links")
        if _settled(edges):
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    raise RuntimeError("components did not settle")


def with_centres(found: DataFrame) -> DataFrame:
    """Stars (node, component) with a row for each centre."""
    return found.union(found.select(F.col("component").alias("node"), "component").distinct())


def components(links: DataFrame) -> DataFrame:
    """node, component (its least reachable node) for the nodes of links (a, b)."""
    return with_centres(stars(links))
