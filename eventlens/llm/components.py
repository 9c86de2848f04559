"""Connected components of an edge table by alternating large and small stars.

Every round is two aggregates (combined before the shuffle, so a hub is no
hot group) and two equi-joins whose large partitions Spark splits; the edge
table is written to the shared folder after each star, which cuts lineage.
Only a row count and a hash sum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v: long) that is not its
    component's smallest node; the root is the smallest.  An empty edge table
    gives an empty result; loops (u = v) and null ends are ignored."""
    now = written(edges.where("u <> v").select(F.col("u").cast("long"), F.col("v").cast("long")).distinct(), "cc-edges")
    state = None
    while True:
        now = written(_large_star(now), "cc-large")
        now = written(_small_star(now), "cc-small")
        new = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = new
