"""Connected components of a graph given as a table of edges.

Rounds of large-star and small-star: every node hands its neighbours above it,
then those below it, to the smallest one it knows, until nothing changes. Each
round is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges``: u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (its smallest node) for all nodes of ``edges`` (longs ``a``, ``b``)."""
    kept = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    before = None
    while True:
        # Each round leaves edges from larger to smaller nodes; in the end they are stars.
        kept = materialize(_small_star(_large_star(kept).where("u <> v").distinct()).distinct(), "stars")
        state = kept.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    stars = kept.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionAll(stars.select(F.col("component").alias("node"), "component").distinct())
