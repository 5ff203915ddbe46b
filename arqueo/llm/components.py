"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from arqueo.llm.common import Tables


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's greater neighbours go to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its lesser neighbours go to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def connected_components(edges: DataFrame, tables: Tables | None = None) -> DataFrame:
    """node, component (the least node reachable) of every node with an edge to another.

    ``edges`` has u and v (bigint) in either order; loops and nulls are ignored, repeated edges
    count once. The number of rounds grows with the logarithm of the longest path. Each round is
    written to the shared folder, so lost executors cost one round at most; the last one is the
    result, and is among ``tables`` if these are given.
    """
    tables = tables or Tables(edges.sparkSession)
    now, mark = _written(tables, _small_star(edges.where("u <> v")).distinct())
    seen = None
    while mark["n"] and mark != seen:
        seen = mark
        # Each star reads its edges several times, so that they are written between.
        large, _ = _written(tables, _large_star(now).distinct())
        small, mark = _written(tables, _small_star(large).distinct())
        tables.drop(now, large)
        now = small
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _written(tables: Tables, edges: DataFrame) -> tuple[DataFrame, dict]:
    """The edges, written, with their number and digest, taken on the way."""
    seen = Observation()
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    table = tables.write(edges.observe(seen, F.count(F.lit(1)).alias("n"), digest.alias("digest")))
    return table, seen.get
