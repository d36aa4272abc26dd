"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlane.llm.common import kept_aside


def _large_star(edges: DataFrame) -> DataFrame:
    """Every greater neighbour of a vertex links to the least of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return (
        both.where("b > a")
        .join(least, "a")
        .select(F.col("b").alias("a"), F.col("least").alias("b"))
        .where("a != b")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every lesser neighbour of a vertex, and itself, links to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    links = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return links.unionByName(least.select("a", F.col("least").alias("b"))).where("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``vertex`` and ``root`` (least vertex of its component) for all vertices of ``edges``
    (``a``, ``b``). The edges stay no more than they were; each round is cut off by a
    checkpoint, and rounds grow with the logarithm of the vertices.
    """
    stars = kept_aside(edges.where("a != b").select("a", "b").distinct())
    seen = None
    while True:
        stars = kept_aside(_small_star(_large_star(stars)))
        found = stars.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if found == seen:
            break
        seen = found
    roots = stars.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
    return roots.unionByName(
        roots.select(F.col("root").alias("vertex"), "root").distinct()
    )
