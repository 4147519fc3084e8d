"""Stream-stream joins in event time."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from roadgauge.streaming.windows import DELIVERY, VEHICLE_WATERMARK

NEAR = timedelta(minutes=5)
PING = ("event_id", "latitude", "longitude", "speed_mph")


EVENT = ("delivery_id", "event_type", "vehicle_id", "event_timestamp")


def nearest_pings(deliveries: DataFrame, gps: DataFrame, near: timedelta = NEAR) -> DataFrame:
    """Each delivery event with the vehicle's ping nearest in time, within ``near`` on either side; without one, nulls.

    Of equally near pings the earlier counts, then the smaller id. Streams and tables give the same rows; events that repeat all of their
    four columns are one.
    """
    seconds = int(near.total_seconds())
    live = deliveries.isStreaming or gps.isStreaming
    best = _joined_streams(deliveries, gps, seconds) if live else _carried(deliveries, gps, seconds)
    return best.select(
        *EVENT, (F.col("ping.gap") / 1e6).alias("gap_seconds"),
        F.timestamp_micros("ping._micros").alias("ping_timestamp"), *[F.col(f"ping.{c}").alias(c) for c in PING])


def _cell(micros: Column, length: int) -> Column:
    return F.floor(micros / F.lit(length * 1_000_000))


def _cells(micros: Column, seconds: int, length: int) -> Column:
    """The cells of time that hold an event the ping is near to."""
    return F.sequence(_cell(micros - seconds * 1_000_000, length), _cell(micros + seconds * 1_000_000, length))


def _carried(deliveries: DataFrame, gps: DataFrame, seconds: int) -> DataFrame:
    """Tables: within vehicle and cell the last ping is carried forward to the events, and the next one back, so no event meets all near pings."""
    micros, length = F.unix_micros("event_timestamp"), 6 * seconds
    known = gps.where("vehicle_id is not null and event_timestamp is not null").select(
        "vehicle_id", F.explode(_cells(micros, seconds, length)).alias("_cell"), micros.alias("_at"), F.lit(0).alias("_feed"),
        F.struct(micros.alias("_micros"), *PING).alias("_ping"))
    events = deliveries.select(*EVENT, _cell(micros, length).alias("_cell"), micros.alias("_at"), F.lit(1).alias("_feed"))
    stacked = events.unionByName(known, allowMissingColumns=True)
    within = Window.partitionBy("vehicle_id", "_cell")
    # of pings at one time the smallest comes last, and events come after the pings of their time
    rest = ["_feed", F.desc("_ping")]
    carried = stacked.withColumns({
        name: F.last("_ping", ignorenulls=True).over(within.orderBy(order, *rest).rowsBetween(Window.unboundedPreceding, 0))
        for name, order in (("_before", F.asc("_at")), ("_after", F.desc("_at")))
    }).where("_feed = 1")

    def candidate(name: str) -> Column:
        gap = F.abs(F.col("_at") - F.col(f"{name}._micros"))
        return F.when(gap <= seconds * 1_000_000, F.struct(gap.alias("gap"), f"{name}.*"))

    # the cell is that of the event, and keeps the rows where they are
    return carried.withColumn("ping", F.least(candidate("_before"), candidate("_after"))).groupBy("_cell", *EVENT).agg(F.min("ping").alias("ping"))


def _joined_streams(deliveries: DataFrame, gps: DataFrame, seconds: int) -> DataFrame:
    """Streams: events and pings are gathered by vehicle and cell, twice as long as the range, and the two lists of a cell are joined.

    State holds one row per vehicle and cell of each side and none per event. Both sides carry a watermark on the start of the cell, late enough
    to take every row that one on the row's own time takes. The lists of a cell come out together once its time has passed, an event without
    ping with them, and there each event is compared with the pings of its cell only.
    """
    length, micros = 2 * seconds, F.unix_micros("event_timestamp")

    def start(cell: Column) -> Column:
        return F.timestamp_micros(cell * F.lit(length * 1_000_000))

    # times up to a cell after its start count for an event, and half a cell more to either side for a ping
    events = deliveries.select(*EVENT, start(_cell(micros, length)).alias("_cell")).withWatermark(
        "_cell", f"{DELIVERY.watermark} {length} seconds")
    known = gps.where("vehicle_id is not null and event_timestamp is not null").select(
        F.col("vehicle_id").alias("_vehicle"), F.struct(micros.alias("_micros"), *PING).alias("_ping"),
        F.explode(_cells(micros, seconds, length)).alias("_place"))
    pings = known.withColumn("_ping_cell", start(F.col("_place"))).withWatermark("_ping_cell", f"{VEHICLE_WATERMARK} {2 * length} seconds")
    left = events.groupBy("vehicle_id", "_cell").agg(F.collect_set(F.struct("delivery_id", "event_type", "event_timestamp")).alias("_events"))
    right = pings.groupBy("_vehicle", "_ping_cell").agg(F.collect_list("_ping").alias("_pings"))
    met = left.join(right, (F.col("vehicle_id") == F.col("_vehicle")) & (F.col("_cell") == F.col("_ping_cell")), "left_outer")
    pinged = met.select("vehicle_id", "_pings", F.explode("_events").alias("_event")).select("vehicle_id", "_pings", "_event.*")

    def gap(ping: Column) -> Column:
        return F.abs(micros - ping["_micros"])

    # the least gap first, so that few pings are compared as a whole
    least = pinged.withColumn("gap", F.array_min(F.transform("_pings", gap)))
    nearest = F.array_min(F.filter("_pings", lambda ping: gap(ping) == F.col("gap")))
    found = least.withColumn("_ping", F.when(F.col("gap") <= seconds * 1_000_000, nearest))
    return found.select(*EVENT, F.when(F.col("_ping").isNotNull(), F.struct("gap", "_ping.*")).alias("ping"))
