"""Connected components of a graph given as an edge table, by alternating large and small stars.

Every round is two aggregates and two joins; minima are pre-aggregated per task, and the joins back to the edges may be
split where a node has very many neighbours. Each round's edges are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tejado.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Connect all larger neighbours of a node to the smallest node next to it (or itself)."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("x"), F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, F.col("u") == F.col("x")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Connect a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "x")
    moved = down.join(least, F.col("u") == F.col("x")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select(F.col("x").alias("u"), F.col("m").alias("v")))


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v) of one orderable type -> (node, component): the smallest node reachable; nodes without edges are absent.

    Loops, repeated edges and edges in both directions don't matter. An empty table gives an empty result.
    """
    now = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = None
    while True:
        got = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(got) == mark or not got[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        mark = tuple(got)
        now = written(_small_star(_large_star(now)).where("u <> v").distinct(), "edges")
