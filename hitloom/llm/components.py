"""Connected components of an edge table, by alternating large-star and small-star steps
(Kiveris et al., "Connected Components in MapReduce and Beyond", 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges`` (a long, b long) -> (node long, root long), root the smallest node reachable.

    Only nodes of some edge appear.  Each step takes a node's smallest
    neighbour by an aggregate (combined map-side) and joins it back, so a node
    with very many neighbours is split by the skew join; no neighbour list is
    ever built.  Every round is written out; the loop ends when a round leaves
    the edge set as it was.
    """
    now = cut(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    seen = _mark(now)
    for _ in range(max_rounds):
        if seen[0] == 0:
            break
        now = cut(_small_star(_large_star(now)), "edges")
        mark = _mark(now)
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    # Settled: every node points straight at its root, roots point nowhere.
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _mark(edges: DataFrame) -> tuple:
    """Count and order-free checksum of an edge set."""
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.sum(F.shiftright(h, 16)), F.sum(F.pmod(h, F.lit(65521)))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    linked = edges.join(low, "u")
    return (linked.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("u", F.col("m").alias("v"))).distinct())
