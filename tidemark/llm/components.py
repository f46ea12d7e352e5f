"""Connected components by alternating large-star and small-star operations on an edge table.

Edges are pairs of distinct ids (u > v). A large-star links every larger neighbour of a node to the
least node of its neighbourhood; a small-star links a node's smaller neighbours to their least. Their
alternation ends with one star a component, centred on its smallest id, after few rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import forget_plans, release, stored


#: Up to so many edges (a few MB) the joins' other side is broadcast and results take few files.
SMALL, FEW = 100_000, 8


def _least(pairs: DataFrame) -> DataFrame:
    """(u, m): the least neighbour of each u, or u if that is smaller. Partial minima go into the shuffle."""
    return pairs.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m"))


class _Rounds:
    """Where the edges are many, the least neighbours are written before they are joined: both sides of the
    join are then plain exchanges, and Spark can split the rows of a hub. The edges never become more."""

    def __init__(self, edges: DataFrame):
        self.small = edges.count() <= SMALL

    def side(self, least: DataFrame) -> DataFrame:
        return F.broadcast(least.coalesce(FEW)) if self.small else stored(least, "cc-least")

    def kept(self, edges: DataFrame) -> DataFrame:
        return stored(edges.coalesce(FEW) if self.small else edges, "cc-edges")

    def large_star(self, edges: DataFrame) -> DataFrame:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        return both.where("v > u").join(self.side(_least(both)), "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))

    def small_star(self, edges: DataFrame) -> DataFrame:
        least = self.side(_least(edges))
        linked = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return linked.unionByName(edges.select("u").join(least, "u").select("u", F.col("m").alias("v"))).where("u != v").distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one edge down, or only edges up."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(edges.select(F.col("v").alias("id"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    return ends.groupBy("id").agg(F.sum("down").alias("down"), F.max("up").alias("up")).where("down > 1 OR down = 1 AND up = 1").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component_id) for every id in an edge; ``edges`` has two bigint columns u and v.

    Loops, repeated edges, either direction and null ends are allowed (null ends are dropped). Each
    round's edges are written to the scratch folder.
    """
    edges = stored(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc-edges")
    rounds = _Rounds(edges)
    while not _are_stars(edges):
        large = rounds.kept(rounds.large_star(edges))
        release(edges)
        edges = rounds.kept(rounds.small_star(large))
        release(large)
        forget_plans(edges.sparkSession)
    stars = edges.select(F.col("u").alias("id"), F.col("v").alias("component_id"))
    return stars.unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct())
