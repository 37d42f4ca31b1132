"""Connected components of a large edge list: alternating large-star and
small-star rounds, each a groupBy and an equi-join, with written tables between
them. A hub is only ever reduced to its smallest neighbour, never gathered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import write_table

MAX_ROUNDS = 40


def _star(edges: DataFrame) -> DataFrame:
    """Large star, then small star: each node's larger, then its other neighbours go to its smallest."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    large = both.join(low, "u").filter("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    kept = low.select("u", F.col("m").alias("v"))
    moved = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return kept.unionByName(moved).distinct()


def _print(edges: DataFrame):
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (u, v); component is its smallest reachable node."""
    now = write_table(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = _print(now)
    for _ in range(MAX_ROUNDS):
        now = write_table(_star(now), "edges")
        if (now_seen := _print(now)) == seen:
            # every node points at its smallest: a star for each component
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component")))
        seen = now_seen
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
