"""Mergeable sets of vehicles: exact as bitmaps over dense vehicle numbers, approximate as sketches.

A set is one row per group and block of 32,768 numbers, however many pings it stands for. Sets of steps, batches or
days are merged by OR, so distinct vehicles of any span are counted from stored rows without reading pings again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

BUCKETS = 64


def numbered(vehicles: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """vehicle_id and vehicle_number of the vehicles that ``known`` lacks. Numbers go on from the greatest known one, from 1.

    Vehicles are ranked within hash buckets, which then follow one another, so no task holds all of them. The same new
    vehicles over the same known ones get the same numbers.
    """
    fresh, top = vehicles.where("vehicle_id is not null").select("vehicle_id").distinct(), 0
    if known is not None:
        fresh = fresh.join(known.select("vehicle_id"), "vehicle_id", "left_anti")
        top = known.agg(F.max("vehicle_number")).first()[0] or 0
    ranked = fresh.withColumn("bucket", F.pmod(F.xxhash64("vehicle_id"), F.lit(BUCKETS))).withColumn(
        "rank", F.row_number().over(Window.partitionBy("bucket").orderBy("vehicle_id")))
    # one row per bucket
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranked.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    starts = sizes.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return ranked.join(starts, "bucket").select(
        "vehicle_id", (F.lit(top) + F.col("start") + F.col("rank")).cast("long").alias("vehicle_number"))


def vehicle_sets(pings: DataFrame, by: list[str], moving: str | None = "is_moving") -> DataFrame:
    """Per group and block of numbers: pings, the vehicles' bitmap and sketch, and the latest time.

    pings: vehicle_id, vehicle_number, event_timestamp. A ping without vehicle counts as a ping in a block of its own.
    """
    measures = [
        F.count(F.lit(1)).alias("events"),
        F.bitmap_construct_agg(F.bitmap_bit_position("vehicle_number")).alias("vehicles"),
        F.hll_sketch_agg("vehicle_id").alias("sketch"),
        F.max("event_timestamp").alias("last_updated"),
    ]
    if moving is not None and moving in pings.columns:
        measures.append(F.count_if(moving).alias("moving"))
    return pings.groupBy(*by, F.bitmap_bucket_number("vehicle_number").alias("block")).agg(*measures)


def merged(sets: DataFrame, by: list[str]) -> DataFrame:
    """Sets of coarser or equal groups, in the same form."""
    sums = [F.sum(c).alias(c) for c in ("events", "moving") if c in sets.columns]
    return sets.groupBy(*by, "block").agg(
        *sums, F.bitmap_or_agg("vehicles").alias("vehicles"), F.hll_union_agg("sketch").alias("sketch"),
        F.max("last_updated").alias("last_updated"))


def counts(sets: DataFrame, by: list[str]) -> DataFrame:
    """Per group: pings, exact distinct vehicles, the sketch's estimate of them, and the latest time."""
    whole = merged(sets, by)
    sums = [F.sum("moving").alias("moving_count")] if "moving" in whole.columns else []
    return whole.groupBy(*by).agg(
        F.sum("events").alias("total_events"),
        F.sum(F.bitmap_count("vehicles")).alias("active_vehicles"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimated_vehicles"),
        *sums, F.max("last_updated").alias("last_updated"))
