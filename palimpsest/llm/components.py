"""Connected components of an edge list by alternating large-star and small-star steps.

Every step is an aggregation and a join on node ids; a hub's edges are spread by AQE's skew
join. Steps are cut by a written table, so a lost executor costs one step at most."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _measure(edges: DataFrame):
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s")).first()
    return row["n"], row["s"]


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (u long, v long) -> (node, root): for every node of an edge the smallest id
    reachable from it. Self-loops, repeated and null edges do no harm; no edges: no rows."""
    both = edges.where("u is not null and v is not null and u <> v")
    now = stored(both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = _measure(now)
    while before[0]:
        # large star: every larger neighbour of a node points to the smallest neighbour
        around = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (around.where("v > u").join(least, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # small star: a node and its smaller neighbours point to the smallest of them
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(down, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(down.select("u", F.col("m").alias("v"))).distinct())
        now = stored(small, "edges")
        after = _measure(now)
        if after == before:
            break
        before = after
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
