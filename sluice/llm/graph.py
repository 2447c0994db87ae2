"""Connected components of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.session import materialize


def _smallest(pairs: DataFrame) -> DataFrame:
    """For each ``a`` the smallest ``b`` (pre-aggregated before the shuffle)."""
    return pairs.groupBy("a").agg(F.min("b").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = _smallest(both).withColumn("m", F.least("a", "m"))
    return both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = _smallest(down)
    moved = down.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` (smallest node reachable) of every node in
    ``links`` (columns ``a`` and ``b``, longs).  Each round is stored in the
    shared folder; it ends when a round changes no edge."""
    edges = materialize(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    while True:
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if (state["n"], state["h"]) == mark or not state["n"]:
            break
        mark = (state["n"], state["h"])
        edges = materialize(_small_star(_large_star(edges)), "edges")
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
