"""Vehicle-day, daily, hourly and ad-hoc aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from roadgauge import schemas as S
from roadgauge.functions import columns as C


def _rows() -> Column:
    return F.count(F.lit(1))


def vehicle_days(gps: DataFrame) -> DataFrame:
    """Per vehicle and day: time span, speeds, fuel range, idle and moving pings."""
    return (
        gps.groupBy("vehicle_id", "date_key")
        .agg(
            _rows().alias("gps_events"),
            F.min("event_timestamp").alias("start_time"),
            F.max("event_timestamp").alias("end_time"),
            F.avg("speed_mph").alias("avg_speed_mph"),
            F.max("speed_mph").alias("max_speed_mph"),
            F.min("fuel_level").alias("min_fuel_level"),
            F.max("fuel_level").alias("max_fuel_level"),
            F.count_if(F.col("engine_status") == "IDLE").alias("idle_events"),
            F.count_if(C.is_moving()).alias("moving_events"),
        )
        .withColumns({
            # whole seconds, as the epoch casts of the stored tables
            "duration_minutes": (F.unix_timestamp("end_time") - F.unix_timestamp("start_time")) / 60,
            "fuel_consumed": F.col("max_fuel_level") - F.col("min_fuel_level"),
            "idle_time_pct": C.percentage("idle_events", "gps_events"),
        })
    )


def daily_gps(gps: DataFrame, exact: bool = False) -> DataFrame:
    """Per day: pings, active vehicles, mean speed and fuel.

    The exact form first groups by vehicle as well, so distinct counting runs on one row per
    vehicle and day and the raw rows are aggregated on the map side only.
    """
    if not exact:
        return gps.groupBy("date_key").agg(
            _rows().alias("total_gps_events"),
            F.approx_count_distinct("vehicle_id").alias("active_vehicles"),
            F.avg("speed_mph").alias("avg_speed"),
            F.avg("fuel_level").alias("avg_fuel_level"),
        )
    per_vehicle = gps.groupBy("date_key", "vehicle_id").agg(
        _rows().alias("n"),
        F.sum("speed_mph").alias("speed"), F.count("speed_mph").alias("speeds"),
        F.sum("fuel_level").alias("fuel"), F.count("fuel_level").alias("fuels"),
    )
    return per_vehicle.groupBy("date_key").agg(
        F.sum("n").alias("total_gps_events"),
        F.count("vehicle_id").alias("active_vehicles"),
        F.try_divide(F.sum("speed"), F.sum("speeds")).alias("avg_speed"),
        F.try_divide(F.sum("fuel"), F.sum("fuels")).alias("avg_fuel_level"),
    )


def daily_deliveries(deliveries: DataFrame, exact: bool = False) -> DataFrame:
    """Per day: totals, successes, on-time, mean delay, active drivers and vehicles."""
    if not exact:
        return deliveries.groupBy("date_key").agg(
            _rows().alias("total_deliveries"),
            F.count_if("is_successful").alias("successful_deliveries"),
            F.count_if("is_on_time").alias("on_time_deliveries"),
            F.avg("delay_minutes").alias("avg_delay_minutes"),
            F.approx_count_distinct("driver_id").alias("active_drivers"),
            F.approx_count_distinct("vehicle_id").alias("delivery_vehicles"),
        )
    pairs = deliveries.groupBy("date_key", "driver_id", "vehicle_id").agg(
        _rows().alias("n"),
        F.count_if("is_successful").alias("ok"),
        F.count_if("is_on_time").alias("on_time"),
        F.sum("delay_minutes").alias("delay"), F.count("delay_minutes").alias("delays"),
    )
    return pairs.groupBy("date_key").agg(
        F.sum("n").alias("total_deliveries"),
        F.sum("ok").alias("successful_deliveries"),
        F.sum("on_time").alias("on_time_deliveries"),
        F.try_divide(F.sum("delay"), F.sum("delays")).alias("avg_delay_minutes"),
        F.countDistinct("driver_id").alias("active_drivers"),
        F.countDistinct("vehicle_id").alias("delivery_vehicles"),
    )


def daily_summary(gps: DataFrame, deliveries: DataFrame, exact: bool = False) -> DataFrame:
    """Both daily summaries side by side; a day in only one of them keeps nulls for the other."""
    both = daily_gps(gps, exact).join(daily_deliveries(deliveries, exact), "date_key", "full")
    return both.withColumns({
        "summary_date": F.to_date(F.col("date_key").cast("string"), "yyyyMMdd"),
        "on_time_delivery_pct": C.as_decimal(C.percentage("on_time_deliveries", "total_deliveries")),
        "delivery_success_rate": C.as_decimal(C.percentage("successful_deliveries", "total_deliveries")),
    })


def vehicle_day_rollup(gps: DataFrame) -> DataFrame:
    """Per vehicle and year/month/day: speeds, fuel and miles by odometer."""
    return gps.groupBy("vehicle_id", "year", "month", "day").agg(
        _rows().alias("gps_events"),
        F.avg("speed_mph").alias("avg_speed"),
        F.max("speed_mph").alias("max_speed"),
        F.avg("fuel_level").alias("avg_fuel_level"),
        F.max("odometer").alias("max_odometer"),
        F.min("odometer").alias("min_odometer"),
    ).withColumn("miles_driven", F.col("max_odometer") - F.col("min_odometer"))


def delivery_day_rollup(deliveries: DataFrame) -> DataFrame:
    """Per vehicle, year/month/day and status: distance, time (nulls skipped) and tips."""
    return deliveries.groupBy("vehicle_id", "year", "month", "day", "status").agg(
        _rows().alias("deliveries"),
        F.avg("distance_miles").alias("avg_distance"),
        F.avg("delivery_time_minutes").alias("avg_delivery_time"),
        F.sum("tip_amount").alias("total_tips"),
    )


def count_all(df: DataFrame, name: str = "total_records") -> DataFrame:
    return df.agg(_rows().alias(name))


def count_by_day(df: DataFrame) -> DataFrame:
    return df.groupBy("year", "month", "day").agg(_rows().alias("records")).orderBy("year", "month", "day")


def one_day_speed(df: DataFrame, year: int, month: int, day: int) -> DataFrame:
    """Rows and mean speed of one day; the equality tests prune partitions."""
    chosen = (F.col("year") == year) & (F.col("month") == month) & (F.col("day") == day)
    return df.where(chosen).agg(_rows().alias("records"), F.avg("speed_mph").alias("avg_speed"))


def status_summary(deliveries: DataFrame) -> DataFrame:
    return deliveries.groupBy("status").agg(
        _rows().alias("count"), F.avg("distance_miles").alias("avg_distance"),
    )


def vehicle_activity(gps: DataFrame) -> DataFrame:
    return gps.groupBy("vehicle_id").agg(_rows().alias("gps_events"), F.avg("speed_mph").alias("avg_speed"))


def top_vehicles(gps: DataFrame, k: int = 10) -> DataFrame:
    """Most active vehicles; the id breaks ties."""
    return vehicle_activity(gps).orderBy(F.desc_nulls_last("gps_events"), F.asc("vehicle_id")).limit(k)


def daily_delivery_performance(deliveries: DataFrame, since: str | None = None) -> DataFrame:
    """Per event_date: total, on-time, rounded mean delay and on-time share."""
    rows = deliveries if since is None else deliveries.where(F.col("event_date") >= since)
    return rows.groupBy("event_date").agg(
        _rows().alias("total_deliveries"),
        F.count_if("is_on_time").alias("on_time"),
        C.settled_round(F.avg("delay_minutes")).alias("avg_delay"),
        F.round(C.share(F.count_if("is_on_time"), _rows()), 2).alias("on_time_pct"),
    ).orderBy("event_date")


def hourly_utilization(gps: DataFrame, day: str | None = None) -> DataFrame:
    """Per hour: distinct vehicles, mean speed and moving pings, from one row per vehicle-hour."""
    rows = gps if day is None else gps.where(F.col("event_date") == day)
    per_vehicle = rows.groupBy(F.date_trunc("hour", "event_timestamp").alias("hour"), "vehicle_id").agg(
        F.sum("speed_mph").alias("speed"), F.count("speed_mph").alias("speeds"),
        F.count_if("is_moving").alias("moving"),
    )
    return per_vehicle.groupBy("hour").agg(
        F.count("vehicle_id").alias("active_vehicles"),
        C.settled_round(F.try_divide(F.sum("speed"), F.sum("speeds"))).alias("avg_speed"),
        F.sum("moving").alias("moving_count"),
    ).orderBy("hour")


def delivery_counters(deliveries: DataFrame) -> DataFrame:
    """Per date: delivered, their delay and on-time count, and failed attempts."""
    done, failed = C.has_status("DELIVERED"), C.has_status("FAILED_ATTEMPT")
    late = F.coalesce("delay_minutes", F.lit(0))
    return (
        deliveries.where(done | failed)
        .groupBy(C.event_date("event_timestamp").alias("event_date"))
        .agg(
            F.count_if(done).alias("total_deliveries"),
            F.sum(F.when(done, late).otherwise(0)).alias("total_delay_minutes"),
            F.count_if(done & (late <= 0)).alias("on_time_count"),
            F.count_if(failed).alias("failed_attempts"),
            F.max("event_timestamp").alias("last_updated"),
        )
    )


def driver_day_counters(deliveries: DataFrame) -> DataFrame:
    """Per named driver and date: deliveries made and their total delay."""
    named = F.col("driver_id").isNotNull() & (F.col("driver_id") != "")
    return (
        deliveries.where(named & C.has_status("DELIVERED"))
        .groupBy("driver_id", C.event_date("event_timestamp").alias("event_date"))
        .agg(
            _rows().alias("deliveries_completed"),
            F.sum(F.coalesce("delay_minutes", F.lit(0))).alias("total_delay"),
            F.max("event_timestamp").alias("last_updated"),
        )
    )


def fleet_day_counters(gps: DataFrame) -> DataFrame:
    """Per date: pings and distinct vehicles."""
    per_vehicle = gps.groupBy(C.event_date("event_timestamp").alias("event_date"), "vehicle_id").agg(
        _rows().alias("n"), F.max("event_timestamp").alias("seen"),
    )
    return per_vehicle.groupBy("event_date").agg(
        F.sum("n").alias("total_events"),
        F.count("vehicle_id").alias("active_vehicles"),
        F.max("seen").alias("last_updated"),
    )


def high_watermark(df: DataFrame, ts: str = "event_timestamp") -> DataFrame:
    return df.agg(F.max(ts).alias("high_watermark"))


def status_breakdown(latest: DataFrame, column: str = "engine_status") -> DataFrame:
    return latest.groupBy(column).agg(_rows().alias("vehicles"))


def low_fuel(latest: DataFrame) -> DataFrame:
    return latest.agg(F.count_if(F.col("fuel_level") < S.LOW_FUEL).alias("low_fuel_vehicles"))


def beside_mean(daily: DataFrame, value: str, day: str = "date_key") -> DataFrame:
    """Each day's value beside the mean over all days, as a scalar subquery."""
    mean = daily.agg(F.avg(value).alias("m")).scalar()
    return daily.select(day, value, mean.alias(f"mean_{value}"))


def period_change(series: DataFrame, order: str, values: list[str]) -> DataFrame:
    """Change of each value against the preceding period, absolute and in percent.

    The series is an aggregate with one row per day or hour, so its single ordered window
    holds a few thousand rows however large the raw data is.
    """
    window = Window.orderBy(order)
    columns = {}
    for value in values:
        before = F.lag(value).over(window)
        columns[f"{value}_change"] = F.col(value) - before
        columns[f"{value}_change_pct"] = C.percentage(F.col(value) - before, before)
    return series.withColumns(columns)
