"""Connected components by alternating large-star and small-star.

Every step is a group minimum and a join; edges are written to the shared folder after each
round, which cuts lineage and survives lost executors.  Hubs are joined by key, which adaptive
execution splits when one is hot; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import materialise


def _with_minimum(edges: DataFrame) -> DataFrame:
    """``edges (u, v)`` with ``m``, the least of ``u`` and its neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    return edges.join(least, "u").withColumn("m", F.least("u", "least")).drop("least")


def large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (_with_minimum(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v").distinct())


def small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    found = _with_minimum(down)
    return (found.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(found.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())


def _are_stars(edges: DataFrame) -> bool:
    """Every node has one smaller neighbour, which has none: nothing is left to shorten."""
    several = edges.groupBy("u").agg(F.count("*").alias("k")).filter("k > 1").select("u")
    inner = edges.join(edges.select(F.col("v").alias("u")).distinct(), "u", "left_semi").select("u")
    return several.unionByName(inner).isEmpty()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, root`` for every node of ``edges (u, v)``; ``root`` is the least node.

    Self links are ignored, so a node that only has one does not appear.
    """
    now = edges.filter("u <> v").select("u", "v").distinct()
    for _ in range(max_rounds):
        now = materialise(small_star(large_star(now)), "star_edges")
        if _are_stars(now):
            break
    else:
        raise RuntimeError(f"no stars after {max_rounds} rounds")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
