"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import cut_lineage


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b; any order, repeats and loops allowed) as ``node, root``:
    every node that has an edge, with the smallest node of its component.

    Each round links all larger neighbours of a node to the smallest
    neighbour, then all smaller neighbours; the edges stay fewer than the first
    ones and end as one star a component, after about log(nodes) rounds.  Rounds
    are written tables: joins read plain shuffles on both sides, so a node with very
    many edges is split by Spark's skew join."""
    a, b = F.greatest("a", "b"), F.least("a", "b")
    now = cut_lineage(edges.where("a != b").select(a.alias("a"), b.alias("b")).distinct())
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = cut_lineage(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = cut_lineage(both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        low = cut_lineage(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(low, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = cut_lineage(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
