"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidewater.llm.common import stored


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """Each node passes its smallest neighbour (or itself) to its larger neighbours
    (``larger``), or to its smaller ones and itself."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")) \
        .union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    if not larger:
        both = both.filter("v < u")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = both.join(least, "u")
    out = joined.filter("v > u") if larger else joined.filter("v != m").union(
        least.select("u", F.col("u").alias("v"), "m"))
    return out.select(F.col("m").alias("a"), F.col("v").alias("b")).filter("a != b").distinct()


def labels(edges: DataFrame, name: str) -> DataFrame:
    """(node, label) for each node of ``edges`` (a, b): its component's smallest node.
    Every round is written to the shared folder, so its plan and losses stay small;
    the write itself observes whether the round changed anything."""
    spark = edges.sparkSession
    now = stored(spark, edges.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                 .distinct(), f"{name}-edges")
    mark = None
    while True:
        seen = Observation()
        edge = F.xxhash64("a", "b").cast("decimal(38,0)")
        stars = _stars(_stars(now, True), False).observe(seen, F.count(F.lit(1)).alias("n"), F.sum(edge).alias("sum"))
        now = stored(spark, stars, f"{name}-stars")
        if seen.get == mark:
            break
        mark = seen.get
    return now.select(F.col("b").alias("node"), F.col("a").alias("label")) \
        .union(now.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct())
