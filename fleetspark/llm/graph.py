"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspark.llm.common import stored

MAX_ROUNDS = 60


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Each node's neighbours (the smaller ones, or all) meet at the least of them and itself."""
    both = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    if not small:
        both = both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = both.join(least, "u")
    ends = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b")) if not small else joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return ends.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the least node reachable) for every node of ``edges`` (a, b); equal ends are ignored.

    Rounds are stored in the shared folder; their number grows with the logarithm of a component's size. Sums of a hub's
    edges are combined before the shuffle, and adaptive execution splits a hub's side of the join.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
    seen = _print(now)
    for _ in range(MAX_ROUNDS):
        now = stored(_star(_star(now, small=False), small=True), "cc")
        if (found := _print(now)) == seen:
            break
        seen = found
    else:
        raise RuntimeError("the components did not settle")
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
