"""Connected components of an edge table by alternating large and small stars.

Every round runs as joins and aggregates over edges; the driver sees only a count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import discard, files_for, saved

MAX_ROUNDS = 60


def _with_least(edges: DataFrame) -> DataFrame:
    """Each (u, v) with m, the least of u and its neighbours; hot nodes are split by the join."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least, "u").withColumn("m", F.least("u", "m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    own = least.select("u", F.col("m").alias("v"))
    others = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return own.unionByName(others)


def _sum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(u, component) of every node that has an edge in edges(a, b), component being the least node reachable.

    Nulls and loops are ignored and repeated edges count once; without edges there are no rows.
    """
    pairs = edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    held = saved(pairs.distinct())
    before = _sum(held)
    for _ in range(MAX_ROUNDS):
        after = saved(_small_star(_large_star(held).distinct()).distinct(), files_for(before[0]))
        discard(held)
        held, now = after, _sum(after)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("the stars did not settle")
    return held.select("u", F.col("v").alias("component")).unionByName(held.select(F.col("v").alias("u"), F.col("v").alias("component")).distinct())
