"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regline.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` -> ``(node, component)``, the component's smallest node, for every node but the smallest itself.

    A large star links each node's larger neighbours to its smallest
    neighbour; a small star does so with the smaller ones. Both keep
    connectivity, and repeated they end in one star per component after a
    number of rounds logarithmic in the longest path. Every round's edges are
    written to the shared folder. Loops and repeated edges do no harm; nulls
    are left out; no edges give no rows.
    """
    now = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    while not _only_stars(now):
        now = _small_star(_large_star(now))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _only_stars(edges: DataFrame) -> bool:
    """Whether every larger end has one edge and is no other edge's smaller end."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    sums = ends.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    return sums.where("up > 1 OR (up = 1 AND down > 0)").isEmpty()


def _smallest(edges: DataFrame) -> DataFrame:
    """Each ``u`` with its smallest ``v``. Partial sums fold a hub's edges before the shuffle; written,
    so that the joins shuffle both sides themselves and AQE may split a hub."""
    return written(edges.groupBy("u").agg(F.min("v").alias("m")), "smallest")


def _large_star(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` with u > v, as many as before."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _smallest(both).select("u", F.least("u", "m").alias("m"))
    return written(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")), "large-star")


def _small_star(edges: DataFrame) -> DataFrame:
    least = _smallest(edges)
    others = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return written(others.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
