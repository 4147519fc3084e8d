"""Fleet status, delivery performance, driver leaderboard, latest state, alerts and KPI report."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roadgauge import schemas as S
from roadgauge.functions import columns as C


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the greatest order columns per key, remaining columns breaking ties.

    An aggregate, so each map task sends one row per key.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in order + rest])


def latest_positions(gps: DataFrame) -> DataFrame:
    """Newest ping per vehicle; of copies, the one processed last if that is known."""
    order = [c for c in ("event_timestamp", "processed_at") if c in gps.columns]
    return latest_per_key(gps, ["vehicle_id"], order)


def latest_statuses(deliveries: DataFrame) -> DataFrame:
    """Newest event per delivery and status."""
    return latest_per_key(deliveries, ["delivery_id", "event_type"], ["event_timestamp"])


def unexpired(df: DataFrame, as_of, hours: int, ts: str = "event_timestamp") -> DataFrame:
    """Rows younger than their time to live at ``as_of``."""
    return df.where(F.col(ts) > F.lit(as_of).cast("timestamp") - F.make_dt_interval(hours=F.lit(hours)))


def current_drivers(deliveries: DataFrame) -> DataFrame:
    """Driver of each vehicle's newest delivery event."""
    newest = F.max(F.struct("event_timestamp", "driver_id"))
    return deliveries.where("driver_id is not null").groupBy("vehicle_id").agg(newest.alias("_n")).select(
        "vehicle_id", F.col("_n.driver_id").alias("driver_id"),
    )


def latest_day(dates: DataFrame, as_of) -> DataFrame:
    """Greatest date_key not after ``as_of``; one row, used as a scalar subquery."""
    return dates.where(F.col("full_date") <= F.lit(as_of).cast("date")).agg(F.max("date_key").alias("date_key"))


def fleet_status(
    vehicles: DataFrame, gps: DataFrame, deliveries: DataFrame, drivers: DataFrame, dates: DataFrame, as_of,
) -> DataFrame:
    """Every current vehicle with its last ping of the latest day and its current driver."""
    today = gps.where(F.col("date_key") == latest_day(dates, as_of).scalar())
    position = latest_positions(today).select(
        "vehicle_id", "latitude", "longitude", "speed_mph", "engine_status", "fuel_level",
        F.col("event_timestamp").alias("last_update"),
    )
    named = current_drivers(deliveries).join(drivers.select("driver_id", "driver_name"), "driver_id", "left")
    return vehicles.join(position, "vehicle_id", "left").join(
        named.select("vehicle_id", "driver_name"), "vehicle_id", "left",
    )


def recent(rows: DataFrame, as_of, days: int, ts: str = "event_timestamp") -> DataFrame:
    """Rows of the last ``days``, bounded at the scan: by event_date too, where the table is partitioned by it.

    A lower bound on the event time changes no keep-latest dedup for the days within it, so it can come first.
    """
    first = F.date_sub(F.lit(as_of).cast("date"), days)
    bounded = rows.where(F.col(ts) >= first.cast("timestamp"))
    return bounded.where(F.col("event_date") >= first.cast("string")) if "event_date" in rows.columns else bounded


def delivery_performance(deliveries: DataFrame, dates: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Per date of the last ``days``: totals, successes, on-time and shares.

    Facts are aggregated per date_key before the join, so the join moves one row per day.
    """
    bounds = deliveries.groupBy("date_key").agg(
        F.count(F.lit(1)).alias("total_deliveries"),
        F.count_if("is_successful").alias("successful_deliveries"),
        F.count_if("is_on_time").alias("on_time_deliveries"),
        F.avg("delay_minutes").alias("avg_delay_minutes"),
    )
    recent = dates.where(C.since_days("full_date", as_of, days)).select("date_key", "full_date", "day_name")
    return bounds.join(recent, "date_key").select(
        "full_date", "day_name", "total_deliveries", "successful_deliveries", "on_time_deliveries",
        "avg_delay_minutes",
        F.round(C.share("on_time_deliveries", "total_deliveries"), 2).alias("on_time_pct"),
        F.round(C.share("successful_deliveries", "total_deliveries"), 2).alias("success_rate"),
    ).orderBy("full_date")


def driver_leaderboard(deliveries: DataFrame, drivers: DataFrame, dates: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Drivers of the last ``days``, best on-time share first."""
    recent = dates.where(C.since_days("full_date", as_of, days)).select("date_key")
    per_driver = deliveries.join(recent, "date_key", "left_semi").groupBy("driver_id").agg(
        F.count(F.lit(1)).alias("total_deliveries"),
        F.count_if("is_on_time").alias("on_time_deliveries"),
        C.settled_round(F.avg("delay_minutes")).alias("avg_delay"),
    )
    return per_driver.join(drivers.select("driver_id", "driver_name"), "driver_id").withColumn(
        "on_time_pct", F.round(C.share("on_time_deliveries", "total_deliveries"), 2),
    ).orderBy(F.desc_nulls_last("on_time_pct"), F.desc_nulls_last("total_deliveries"), F.asc("driver_id"))


def top_drivers(leaderboard: DataFrame, k: int = 5) -> DataFrame:
    return leaderboard.orderBy(
        F.desc_nulls_last("on_time_pct"), F.desc_nulls_last("total_deliveries"), F.asc("driver_id"),
    ).limit(k)


# Alert types, subjects and message texts, as their receivers know them.
def alerts(deliveries: DataFrame) -> DataFrame:
    """One row per alert; an event can raise a delay and a failure alert."""
    has = deliveries.columns
    notes = F.coalesce("notes", F.lit("Unknown")) if "notes" in has else F.lit("Unknown")
    place = [F.col(c) if c in has else F.lit(None).cast("double") for c in ("latitude", "longitude")]
    delay = F.struct(
        F.lit("DELAY").alias("alert_type"),
        F.concat(F.lit("Delivery Delay Alert - "), "delivery_id").alias("subject"),
        F.format_string(
            "Delivery %s is delayed by %d minutes. Order ID: %s. Customer: %s. Driver: %s. Vehicle: %s."
            " Current Status: %s.",
            "delivery_id", "delay_minutes", "order_id", "customer_id", "driver_id", "vehicle_id", "event_type",
        ).alias("message"),
    )
    failure = F.struct(
        F.lit("FAILED_ATTEMPT").alias("alert_type"),
        F.concat(F.lit("Failed Delivery - "), "delivery_id").alias("subject"),
        F.format_string(
            "Delivery attempt failed for %s. Order ID: %s. Customer: %s. Location: %s, %s. Reason: %s.",
            F.col("delivery_id"), F.col("order_id"), F.col("customer_id"),
            *[F.coalesce(c.cast("string"), F.lit("unknown")) for c in place], notes,
        ).alias("message"),
    )
    raised = F.array_compact(F.array(
        F.when(C.is_delay_alert(), delay), F.when(C.has_status("FAILED_ATTEMPT"), failure),
    ))
    hit = C.is_delay_alert() | C.has_status("FAILED_ATTEMPT")
    return deliveries.where(hit).select(
        "delivery_id", "event_type", "event_timestamp", "delay_minutes",
        place[0].alias("latitude"), place[1].alias("longitude"),
        F.explode(raised).alias("alert"),
    ).select("*", "alert.*").drop("alert")


def repeated_failures(deliveries: DataFrame, least: int = S.REPEATED_FAILURES) -> DataFrame:
    """Driver-days with at least ``least`` failed attempts."""
    return (
        deliveries.where(C.has_status("FAILED_ATTEMPT"))
        .groupBy("driver_id", C.event_date("event_timestamp").alias("event_date"))
        .agg(F.count(F.lit(1)).alias("failed_attempts"))
        .where(F.col("failed_attempts") >= least)
    )


def kpi_report(summary: DataFrame, total_vehicles: DataFrame) -> DataFrame:
    """Six figures per day for the daily report document."""
    return summary.select(
        F.col("summary_date").alias("report_date"),
        "total_gps_events", "active_vehicles", "total_deliveries", "on_time_delivery_pct",
        "avg_delay_minutes",
        C.percentage("active_vehicles", total_vehicles.agg(F.count(F.lit(1)).alias("n")).scalar())
        .alias("fleet_utilization_pct"),
    )
