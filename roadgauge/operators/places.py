"""Stays of vehicles and the known places next to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from roadgauge.functions import geo
from roadgauge.operators import timeline
from roadgauge.operators.trips import PING_ORDER

#: A stay ends when a vehicle has moved so far since its last ping; and lasts so long at least.
STAY_MILES, STAY_MINUTES = 0.25, 5.0
MILES_PER_DEGREE = 69.0


def stays(gps: DataFrame, miles: float = STAY_MILES, minutes: float = STAY_MINUTES) -> DataFrame:
    """Stretches of a vehicle's successive pings, each within ``miles`` of the one before, that last ``minutes`` or more.

    Their place is the mean of their pings. A ping without position belongs to no stay and ends one.
    """
    linked = timeline.with_previous(gps, "vehicle_id", PING_ORDER, ["latitude", "longitude"], keep_slice=True)
    moved = geo.flat_miles("previous.latitude", "previous.longitude", "latitude", "longitude")
    numbered = timeline.with_running_total(
        linked.withColumn("_leaves", F.coalesce((moved > miles).cast("int"), F.lit(1))), "vehicle_id", PING_ORDER, F.col("_leaves"), "_stay")
    grouped = numbered.where("latitude is not null and longitude is not null").groupBy("vehicle_id", "_stay").agg(
        F.min("event_timestamp").alias("start_time"), F.max("event_timestamp").alias("end_time"),
        F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude"), F.count(F.lit(1)).alias("pings"))
    lasted = (F.unix_micros("end_time") - F.unix_micros("start_time")) / 60e6
    return grouped.withColumn("minutes", lasted).where(F.col("minutes") >= minutes).drop("_stay")


def _row(miles: float) -> Column:
    return F.floor(F.col("latitude") * MILES_PER_DEGREE / miles)


def _cells(miles: float, around: bool) -> Column:
    """Cells whose sides are at least ``miles`` long: the row of latitude, and in it the column of longitude.

    A row's columns are as wide as its edge nearest the pole needs, so a point's neighbours within ``miles`` lie in its own cell or one
    of the eight around. Around: all nine. Columns are counted modulo the row's number of them, over the 180th meridian.
    """
    def columns(row: Column) -> Column:
        edge = F.least(F.greatest(F.abs(row), F.abs(row + 1)) * miles / MILES_PER_DEGREE, F.lit(89.9))
        # one more row further out: the neighbour's own longitude scale may be the smaller one
        shrunk = F.cos(F.radians(F.least(edge + miles / MILES_PER_DEGREE, F.lit(89.9))))
        return F.greatest(F.floor(360 * MILES_PER_DEGREE * shrunk / miles), F.lit(1))

    def cell(row: Column, shift: int) -> Column:
        n = columns(row)
        place = F.floor((F.col("longitude") + 180) / 360 * n)
        return F.struct(row.alias("row"), F.pmod(place + shift, n).alias("column"))

    if not around:
        return cell(_row(miles), 0)
    return F.array_distinct(F.array(*[cell(_row(miles) + up, side) for up in (-1, 0, 1) for side in (-1, 0, 1)]))


def near_places(points: DataFrame, places: DataFrame, key: list[str], miles: float) -> DataFrame:
    """Every point with the nearest place within ``miles`` (ties: the smaller place_id); nulls if there is none.

    points: key columns, latitude, longitude. places: place_id, latitude, longitude. Points take part in the nine cells around
    them and meet only the places of those cells; the distance decides among these.
    """
    around = points.withColumn("_cell", F.explode(_cells(miles, True))).withColumnRenamed("latitude", "_lat").withColumnRenamed(
        "longitude", "_lon").select(*key, "_lat", "_lon", "_cell")
    located = places.withColumn("_cell", _cells(miles, False)).select("place_id", "latitude", "longitude", "_cell")
    met = around.join(located, "_cell").withColumn("place_miles", geo.flat_miles("_lat", "_lon", "latitude", "longitude"))
    best = met.where(F.col("place_miles") <= miles).groupBy(*key).agg(F.min(F.struct("place_miles", "place_id")).alias("_best"))
    return points.join(best, key, "left").select(
        *points.columns, F.col("_best.place_id").alias("place_id"), F.col("_best.place_miles").alias("place_miles"))
