"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roadgauge.session import stage


def _starred(edges: DataFrame, large: bool) -> DataFrame:
    """One step. The minimum of a neighbourhood is aggregated before the shuffle and joined back, so a hub's
    edges need not meet in one task."""
    if large:
        near = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = near.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    joined = near.join(low, "a")
    if large:
        made = joined.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        made = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).union(low.select("a", F.col("low").alias("b")))
    return made.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(a, root) for every node with an edge: root is the smallest node reachable.

    edges: columns a and b, longs; loops and repeats are allowed. Each step is written to the shared folder, which
    keeps the lineage short. The number of steps grows with the logarithm of the size.
    """
    now = stage(edges.where("a <> b").distinct(), "edges")
    seen = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38, 0)"))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
        now = stage(_starred(stage(_starred(now, True), "large-star"), False), "small-star")
    tops = now.select(F.col("b").alias("a"), F.col("b").alias("root")).distinct()
    return now.select("a", F.col("b").alias("root")).union(tops)
