"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from shelfwise.sources.scratch import settle


def _min_neighbour(edges: DataFrame) -> DataFrame:
    """`edges` (u, v) with `m`, the smallest of u and all its v. A hub is aggregated before the shuffle
    and its rows are joined back, so no neighbour list is ever gathered."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least.withColumn("m", F.least("u", "m")), "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _min_neighbour(both).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    found = _min_neighbour(down)
    links = found.select(F.col("v").alias("u"), F.col("m").alias("v")).union(found.select("u", F.col("m").alias("v")))
    return links.where("u <> v").distinct()


def _written(edges: DataFrame) -> tuple[DataFrame, dict]:
    """The edges as a written table, with their number and the sum of their hashes, observed while writing."""
    seen = Observation()
    table = settle(edges.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("marks")), "edges")
    return table, seen.get


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (columns a, b): the smallest node it is connected with.

    Repeated edges, loops and both directions are fine; no edges give no rows. Each round is a
    written table, so a lost executor costs a re-read.
    """
    now, mark = _written(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v").distinct())
    while mark["rows"]:
        before = mark
        now, mark = _written(_small_star(_large_star(now)))
        if mark == before:
            break
    found = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return found.union(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).groupBy("node").agg(F.min("component").alias("component"))
