"""Connected components by alternating large and small stars.

Edges live in a table; no component is ever gathered. Each round replaces
edges by edges to smaller nodes and is checkpointed, so it can be read again
after a lost executor. Rounds stop when the edge table no longer changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlens.session import cut_lineage


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of u move to the least node around u."""
    near = _both_ways(edges)
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return near.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of u, and u, move to the least of them (u > v)."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
    return r.n, r.h


def components(links: DataFrame) -> DataFrame:
    """node and root (its least reachable node) for every node in a link
    (columns a, b). Self links and repeated links do no harm."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    edges = cut_lineage(edges)
    state = _state(edges)
    while state[0]:
        edges = cut_lineage(_small_star(_large_star(edges)))
        new = _state(edges)
        if new == state:
            break
        state = new
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
