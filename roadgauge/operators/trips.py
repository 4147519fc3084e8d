"""Attempts, trips, idle time, distances, route performance and cost measures."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from roadgauge.functions import columns as C, geo
from roadgauge.operators import timeline
from roadgauge.schemas import RATES, Rates

PING_ORDER = ["event_timestamp", "event_id"]


def attempt_numbers(deliveries: DataFrame, order: list[str] | None = None, tasks: int | None = None) -> DataFrame:
    """Number each delivery's final-status events by time, from 1.

    Takes events before deduplication, which would keep only one failed attempt. A delivery has a handful of
    events, so a plain window does with one shuffle. That goes to ``tasks`` tasks: given by the size of the feed, each
    sorts as many rows of a large one as of a small one. Without it, to the session's shuffle partitions.
    """
    order = order or ["event_timestamp", "event_type", "vehicle_id", "driver_id"]
    within = Window.partitionBy("delivery_id").orderBy(*order)
    ended = deliveries.where(C.is_terminal())
    if tasks is not None:
        ended = ended.repartition(tasks, "delivery_id")
    return ended.withColumn("attempt_number", F.row_number().over(within).cast("long"))


def linked_pings(gps: DataFrame, keep_slice: bool = False) -> DataFrame:
    """Each ping with the vehicle's preceding one: minutes, miles and fuel in between."""
    columns = ["latitude", "longitude", "fuel_level", "engine_status", "odometer_miles"]
    was = F.col("previous")
    return timeline.with_previous(gps, "vehicle_id", PING_ORDER, columns, keep_slice=keep_slice).withColumns({
        "gap_minutes": (F.unix_micros("event_timestamp") - F.unix_micros(was["event_timestamp"])) / 60e6,
        "gap_miles": geo.flat_miles(was["latitude"], was["longitude"], F.col("latitude"), F.col("longitude")),
        # refuelling raises the level and is not consumption
        "fuel_burned": F.greatest(was["fuel_level"] - F.col("fuel_level"), F.lit(0.0)),
        "was_idle": was["engine_status"] == "IDLE",
        "is_stop": (was["engine_status"] == "ON") & (F.col("engine_status") != "ON"),
    })


def ping_distances(gps: DataFrame) -> DataFrame:
    """Distance from the preceding ping beside the odometer difference."""
    return linked_pings(gps).select(
        "event_id", "vehicle_id", "event_timestamp", "gap_miles",
        (F.col("odometer_miles") - F.col("previous.odometer_miles")).alias("odometer_gap_miles"),
    )


def with_trip_id(gps: DataFrame, rates: Rates = RATES) -> DataFrame:
    """Number each vehicle's trips. A trip starts on the first ping, after a gap longer than
    ``trip_gap_minutes``, and on the ping after the engine was OFF."""
    linked = linked_pings(gps, keep_slice=True)
    starts = (
        F.col("previous").isNull()
        | (F.col("gap_minutes") > rates.trip_gap_minutes)
        | (F.col("previous.engine_status") == "OFF")
    )
    flagged = linked.withColumn("starts_trip", F.coalesce(starts, F.lit(False)))
    numbered = timeline.with_running_total(
        flagged, "vehicle_id", PING_ORDER, F.col("starts_trip").cast("int"), "trip_number",
    )
    return numbered.withColumn(
        "trip_id", F.concat_ws("-", "vehicle_id", F.col("trip_number").cast("string")),
    )


def trips(gps: DataFrame, rates: Rates = RATES) -> DataFrame:
    """One row per trip with distance, fuel, stops, idle time and cost."""
    inside = ~F.col("starts_trip")

    def within(column: str):
        return F.sum(F.when(inside, F.col(column)).otherwise(0.0))

    per_trip = with_trip_id(gps, rates).groupBy("vehicle_id", "trip_number", "trip_id").agg(
        F.count(F.lit(1)).alias("gps_events"),
        F.min("event_timestamp").alias("start_time"),
        F.max("event_timestamp").alias("end_time"),
        F.avg("speed_mph").alias("avg_speed_mph"),
        F.max("speed_mph").alias("max_speed_mph"),
        (F.max("odometer_miles") - F.min("odometer_miles")).alias("distance_miles"),
        (within("fuel_burned") * rates.tank_gallons).alias("gallons"),
        F.sum(F.when(inside & F.col("was_idle"), F.col("gap_minutes")).otherwise(0.0)).alias("idle_minutes"),
        F.count_if(inside & F.col("is_stop")).alias("stop_count"),
    )
    return per_trip.withColumns({
        "duration_minutes": (F.unix_micros("end_time") - F.unix_micros("start_time")) / 60e6,
        "fuel_cost": F.col("gallons") * rates.fuel_price,
        "cost_per_mile": F.try_divide(F.col("gallons") * rates.fuel_price, F.col("distance_miles")),
    })


def gap_sessions(gps: DataFrame, gap_minutes: int = RATES.trip_gap_minutes) -> DataFrame:
    """Sessions split only by time: a pause of ``gap_minutes`` or more ends one.

    Batch twin of the streaming session window, whose end is the last ping plus the gap.
    """
    linked = timeline.with_previous(gps, "vehicle_id", PING_ORDER, [], keep_slice=True)
    pause = F.unix_micros("event_timestamp") - F.unix_micros("previous.event_timestamp")
    starts = F.coalesce(pause >= gap_minutes * 60_000_000, F.lit(True))
    numbered = timeline.with_running_total(
        linked.withColumn("starts", starts.cast("int")).drop("previous"),
        "vehicle_id", PING_ORDER, F.col("starts"), "session_number",
    )
    return numbered.groupBy("vehicle_id", "session_number").agg(
        F.min("event_timestamp").alias("session_start"),
        (F.max("event_timestamp") + F.make_dt_interval(mins=F.lit(gap_minutes))).alias("session_end"),
        F.count(F.lit(1)).alias("gps_events"),
    ).drop("session_number")


def idle_days(gps: DataFrame) -> DataFrame:
    """Per vehicle and day: idle minutes (time from an IDLE ping to the next ping) and stops
    (engine leaving ON). Time counts for the day the idling started on."""
    linked = linked_pings(gps)
    idle = linked.where("was_idle").groupBy(
        "vehicle_id", C.date_key(F.col("previous.event_timestamp")).alias("date_key"),
    ).agg(F.sum("gap_minutes").alias("idle_minutes"))
    stops = linked.groupBy("vehicle_id", C.date_key("event_timestamp").alias("date_key")).agg(
        F.count_if("is_stop").alias("stop_count"), F.sum("fuel_burned").alias("fuel_used"),
    )
    return stops.join(idle, ["vehicle_id", "date_key"], "left").withColumn(
        "idle_minutes", F.coalesce("idle_minutes", F.lit(0.0)),
    )


def route_performance(gps: DataFrame, deliveries: DataFrame, rates: Rates = RATES) -> DataFrame:
    """Per vehicle and day with pings: distance, stops, efficiency, punctuality and cost.

    ``gps`` is cleaned; ``deliveries`` holds all statuses of the day (deduplicated), since
    planned stops are the distinct orders assigned to the vehicle.
    Efficiency is a weighted mean of on-time share and moving share, both 0 to 100.
    """
    keys = ["vehicle_id", "date_key"]
    driven = gps.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("gps_events"),
        F.count_if(C.is_moving()).alias("moving_events"),
        (F.max("odometer_miles") - F.min("odometer_miles")).alias("total_distance_miles"),
        ((F.unix_micros(F.max("event_timestamp")) - F.unix_micros(F.min("event_timestamp"))) / 60e6)
        .alias("total_duration_minutes"),
    )
    orders = deliveries.groupBy(*keys, "order_id").agg(
        F.count_if(C.has_status("DELIVERED")).alias("completed"),
        F.count_if(C.has_status("FAILED_ATTEMPT")).alias("failed"),
        F.count_if(C.is_terminal()).alias("finished"),
        F.count_if(C.is_terminal() & C.is_on_time()).alias("on_time"),
    )
    stops = orders.groupBy(*keys).agg(
        F.count("order_id").alias("planned_stops"),
        F.sum("completed").alias("completed_stops"),
        F.sum("failed").alias("failed_stops"),
        C.percentage(F.sum("on_time"), F.sum("finished")).alias("on_time_percentage"),
    )
    burned = F.col("fuel_used") * rates.tank_gallons
    joined = driven.join(idle_days(gps), keys, "left").join(stops, keys, "left")
    moving = C.percentage("moving_events", "gps_events")
    return joined.withColumns({
        "planned_stops": F.coalesce("planned_stops", F.lit(0)),
        "completed_stops": F.coalesce("completed_stops", F.lit(0)),
        "failed_stops": F.coalesce("failed_stops", F.lit(0)),
        "moving_percentage": moving,
        "route_efficiency_score":
            F.col("on_time_percentage") * rates.on_time_weight + moving * rates.moving_weight,
        "avg_stop_duration_minutes": F.try_divide("idle_minutes", "stop_count"),
        "gallons": burned,
        "total_fuel_cost": burned * rates.fuel_price,
    }).withColumns({
        "cost_per_delivery": F.try_divide("total_fuel_cost", "completed_stops"),
        "cost_per_mile": F.try_divide("total_fuel_cost", "total_distance_miles"),
    }).drop("fuel_used")


def extended_summary(
    summary: DataFrame, routes: DataFrame, deliveries: DataFrame, vehicles: DataFrame, drivers: DataFrame,
    rates: Rates = RATES,
) -> DataFrame:
    """Daily summary with fleet totals, failures, miles, fuel, cost and utilization."""
    daily_routes = routes.groupBy("date_key").agg(
        F.sum("total_distance_miles").alias("total_miles_driven"),
        F.sum("gallons").alias("total_fuel_consumed"),
        F.sum("total_fuel_cost").alias("total_fuel_cost"),
        F.avg("route_efficiency_score").alias("avg_route_efficiency"),
    )
    failed = deliveries.groupBy("date_key").agg(F.count_if(C.has_status("FAILED_ATTEMPT")).alias("failed_deliveries"))
    miles = F.col("total_miles_driven")
    return (
        summary.join(daily_routes, "date_key", "left").join(failed, "date_key", "left")
        .withColumns({
            "total_vehicles": vehicles.agg(F.count(F.lit(1)).alias("n")).scalar(),
            "total_drivers": drivers.agg(F.count(F.lit(1)).alias("n")).scalar(),
            "avg_mpg": F.try_divide("total_miles_driven", "total_fuel_consumed"),
            "total_operational_cost": F.col("total_fuel_cost") + miles * rates.operating_cost_per_mile,
        })
        .withColumns({
            "cost_per_delivery": F.try_divide("total_operational_cost", "successful_deliveries"),
            "cost_per_mile": F.try_divide("total_operational_cost", "total_miles_driven"),
            "fleet_utilization_pct": C.percentage("active_vehicles", "total_vehicles"),
        })
    )


def headline_kpis(extended: DataFrame, deliveries: DataFrame) -> DataFrame:
    """One row: mean delay, delayed share, route efficiency, cost per mile, utilization."""
    late = deliveries.agg(
        F.avg("delay_minutes").alias("avg_delay_minutes"),
        C.percentage(F.count_if(F.col("delay_minutes") > 0), F.count("delay_minutes")).alias("delayed_pct"),
    )
    fleet = extended.agg(
        F.avg("avg_route_efficiency").alias("route_efficiency_score"),
        F.try_divide(F.sum("total_operational_cost"), F.sum("total_miles_driven")).alias("cost_per_mile"),
        F.avg("fleet_utilization_pct").alias("fleet_utilization_pct"),
    )
    figures = fleet.select(F.struct("*")).scalar()
    return late.withColumn("_fleet", figures).select("*", "_fleet.*").drop("_fleet")


def vehicle_hours(gps: DataFrame) -> DataFrame:
    """Per vehicle and hour window: pings, mean speed, moving and idle pings, efficiency score.

    Same in batch and, with a watermark set, in a stream.
    """
    return gps.groupBy(F.window("event_timestamp", "1 hour"), "vehicle_id").agg(
        F.count(F.lit(1)).alias("gps_events"),
        F.avg("speed_mph").alias("avg_speed"),
        F.count_if(C.is_moving()).alias("moving_time_events"),
        F.count_if(F.col("engine_status") == "IDLE").alias("idle_time_events"),
    ).withColumn("efficiency_score", C.as_decimal(C.percentage("moving_time_events", "gps_events")))


def vehicle_hour_deliveries(deliveries: DataFrame) -> DataFrame:
    """Per vehicle and hour window: deliveries made and their mean delay."""
    return deliveries.where(C.has_status("DELIVERED")).groupBy(
        F.window("event_timestamp", "1 hour"), "vehicle_id",
    ).agg(F.count(F.lit(1)).alias("deliveries"), F.avg("delay_minutes").alias("avg_delay_minutes"))


def route_hours(gps: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Hourly driving beside hourly deliveries of the same vehicle; aggregates first, joins after."""
    return vehicle_hours(gps).join(vehicle_hour_deliveries(deliveries), ["window", "vehicle_id"])


def flatten_window(df: DataFrame) -> DataFrame:
    """Replace the window struct by window_start and window_end."""
    return df.withColumns({
        "window_start": F.col("window.start"), "window_end": F.col("window.end"),
    }).drop("window")
