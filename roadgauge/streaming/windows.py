"""Sliding and tumbling event-time metrics.

The approximate forms run in batch and in streams: their state per window is a fixed-size
sketch. The exact forms are for batch. They first reduce the raw rows to one row per slide
step and vehicle (or value) and only then spread those rows over the windows covering the
step, so raw rows are never multiplied.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from roadgauge import schemas as S
from roadgauge.functions import columns as C
from roadgauge.operators import trips


@dataclass(frozen=True)
class Slide:
    """Window length, slide and watermark delay in minutes."""

    length: int
    step: int
    delay: int

    def window(self, ts: str = "event_timestamp") -> Column:
        return F.window(ts, f"{self.length} minutes", f"{self.step} minutes")

    @property
    def watermark(self) -> str:
        return f"{self.delay} minutes"


# Window, slide and watermark of the two metric streams, and the hourly one's delay.
FLEET = Slide(5, 1, 1)
DELIVERY = Slide(15, 5, 2)
VEHICLE_WATERMARK = "1 minutes"
# end of fixed values


def flat(df: DataFrame) -> DataFrame:
    """Lift the window; event_date is the start's date, so no window splits at midnight."""
    return trips.flatten_window(df).withColumn("event_date", C.event_date("window_start"))


def fleet_ratios(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "moving_events_per_vehicle_pct": C.as_decimal(C.percentage("moving_events", "active_vehicles"), 12, 2),
        "fleet_utilization_pct": C.as_decimal(C.percentage("moving_vehicles", "active_vehicles")),
    })


def fleet_metrics(gps: DataFrame, slide: Slide = FLEET) -> DataFrame:
    """Per window: pings, vehicles, speeds, fuel, moving and idle counts, utilization."""
    moving, idle = C.is_moving(), F.col("engine_status") == "IDLE"
    return fleet_ratios(flat(
        gps.withWatermark("event_timestamp", slide.watermark).groupBy(slide.window()).agg(
            F.count(F.lit(1)).alias("total_events"),
            F.approx_count_distinct("vehicle_id").alias("active_vehicles"),
            F.avg("speed_mph").alias("avg_speed"),
            F.percentile_approx("speed_mph", 0.5).alias("median_speed"),
            F.avg("fuel_level").alias("avg_fuel_level"),
            F.count_if(C.fuel_status() == "CRITICAL").alias("critical_fuel_count"),
            F.count_if(moving).alias("moving_events"),
            F.count_if(idle).alias("idle_events"),
            F.approx_count_distinct(F.when(moving, F.col("vehicle_id"))).alias("moving_vehicles"),
            F.approx_count_distinct(F.when(idle, F.col("vehicle_id"))).alias("idle_vehicles"),
        )
    ))


def kpi_ratios(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "on_time_percentage": C.as_decimal(C.percentage("on_time_deliveries", "total_deliveries")),
        "deliveries_per_driver": C.as_decimal(F.try_divide("total_deliveries", "active_drivers")),
    })


def delivery_kpis(deliveries: DataFrame, slide: Slide = DELIVERY) -> DataFrame:
    """Per window over delivered events: totals, delays, on-time share, drivers, vehicles, weight."""
    done = deliveries.where(C.has_status("DELIVERED")).withWatermark("event_timestamp", slide.watermark)
    return kpi_ratios(flat(
        done.groupBy(slide.window()).agg(
            F.count(F.lit(1)).alias("total_deliveries"),
            F.avg("delay_minutes").alias("avg_delay_minutes"),
            F.percentile_approx("delay_minutes", 0.5).alias("median_delay"),
            F.percentile_approx("delay_minutes", 0.95).alias("p95_delay"),
            F.count_if(C.delay_category() == "ON_TIME").alias("on_time_deliveries"),
            F.approx_count_distinct("driver_id").alias("active_drivers"),
            F.approx_count_distinct("vehicle_id").alias("active_vehicles"),
            F.avg("package_weight_lbs").alias("avg_package_weight"),
        )
    ))


# --- exact batch forms -------------------------------------------------------------------

def _step(slide: Slide) -> Column:
    return F.window("event_timestamp", f"{slide.step} minutes").start.alias("step")


def _spread(df: DataFrame, slide: Slide) -> DataFrame:
    """Repeat each step row for every window that covers the step."""
    first = F.col("step") - F.make_dt_interval(mins=F.lit(slide.length - slide.step))
    starts = F.sequence(first, "step", F.make_dt_interval(mins=F.lit(slide.step)))
    return df.withColumn("window_start", F.explode(starts)).drop("step")


def exact_percentiles(df: DataFrame, slide: Slide, value: str, shares: dict[str, float], width: float = 1.0) -> DataFrame:
    """Smallest value with at least the given share of the window's values at or below it.

    Works on counts per distinct value. Values lie in buckets of the given width; a running sum over a window's buckets
    finds those that hold a share, and only these buckets' values are ranked, each bucket on its own. So a task holds a
    window's bucket counts, or one bucket's values, and never a whole window.
    """
    counts = _spread(
        df.where(F.col(value).isNotNull()).groupBy(_step(slide), value).agg(F.count(F.lit(1)).alias("n")), slide,
    ).groupBy("window_start", value).agg(F.sum("n").alias("n"))
    # NaN is the greatest double
    number = F.col(value).cast("double")
    bucket = F.when(F.isnan(number), F.lit((1 << 63) - 1)).otherwise(F.floor(number / width))
    counts = counts.withColumn("bucket", bucket)
    within = Window.partitionBy("window_start")
    upto = within.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    buckets = counts.groupBy("window_start", "bucket").agg(F.sum("n").alias("size")).withColumns({
        "reached": F.sum("size").over(upto), "total": F.sum("size").over(within)})
    before = F.col("reached") - F.col("size")
    holds = [(before < F.col("total") * share) & (F.col("reached") >= F.col("total") * share) for share in shares.values()]
    any_share = holds[0]
    for other in holds[1:]:
        any_share = any_share | other
    held = buckets.where(any_share).select("window_start", "bucket", "total", before.alias("before"))
    inside = Window.partitionBy("window_start", "bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.join(held, ["window_start", "bucket"]).withColumn("rank", F.col("before") + F.sum("n").over(inside))
    return ranked.groupBy("window_start").agg(*[
        F.min(F.when(F.col("rank") >= F.col("total") * share, F.col(value))).alias(name)
        for name, share in shares.items()
    ])


def _closed(df: DataFrame, slide: Slide) -> DataFrame:
    end = F.col("window_start") + F.make_dt_interval(mins=F.lit(slide.length))
    return df.withColumns({"window_end": end, "event_date": C.event_date("window_start")})


def fleet_metrics_exact(gps: DataFrame, slide: Slide = FLEET) -> DataFrame:
    moving, idle = C.is_moving(), F.col("engine_status") == "IDLE"
    cells = _spread(
        gps.groupBy(_step(slide), "vehicle_id").agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("speed_mph").alias("speed"), F.count("speed_mph").alias("speeds"),
            F.sum("fuel_level").alias("fuel"), F.count("fuel_level").alias("fuels"),
            F.count_if(C.fuel_status() == "CRITICAL").alias("critical"),
            F.count_if(moving).alias("moving"), F.count_if(idle).alias("idle"),
        ), slide,
    )
    measures = ("n", "speed", "speeds", "fuel", "fuels", "critical", "moving", "idle")
    per_vehicle = cells.groupBy("window_start", "vehicle_id").agg(*[F.sum(m).alias(m) for m in measures])
    per_window = per_vehicle.groupBy("window_start").agg(
        F.sum("n").alias("total_events"),
        F.count("vehicle_id").alias("active_vehicles"),
        F.try_divide(F.sum("speed"), F.sum("speeds")).alias("avg_speed"),
        F.try_divide(F.sum("fuel"), F.sum("fuels")).alias("avg_fuel_level"),
        F.sum("critical").alias("critical_fuel_count"),
        F.sum("moving").alias("moving_events"),
        F.sum("idle").alias("idle_events"),
        F.count_if(F.col("moving") > 0).alias("moving_vehicles"),
        F.count_if(F.col("idle") > 0).alias("idle_vehicles"),
    )
    median = exact_percentiles(gps, slide, "speed_mph", {"median_speed": 0.5})
    return fleet_ratios(_closed(per_window.join(median, "window_start", "left"), slide))


def delivery_kpis_exact(deliveries: DataFrame, slide: Slide = DELIVERY) -> DataFrame:
    done = deliveries.where(C.has_status("DELIVERED"))
    cells = _spread(
        done.groupBy(_step(slide), "driver_id", "vehicle_id").agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("delay_minutes").alias("delay"), F.count("delay_minutes").alias("delays"),
            F.count_if(C.delay_category() == "ON_TIME").alias("on_time"),
            F.sum("package_weight_lbs").alias("weight"), F.count("package_weight_lbs").alias("weights"),
        ), slide,
    )
    per_window = cells.groupBy("window_start").agg(
        F.sum("n").alias("total_deliveries"),
        F.try_divide(F.sum("delay"), F.sum("delays")).alias("avg_delay_minutes"),
        F.sum("on_time").alias("on_time_deliveries"),
        F.countDistinct("driver_id").alias("active_drivers"),
        F.countDistinct("vehicle_id").alias("active_vehicles"),
        F.try_divide(F.sum("weight"), F.sum("weights")).alias("avg_package_weight"),
    )
    delays = exact_percentiles(done, slide, "delay_minutes", {"median_delay": 0.5, "p95_delay": 0.95})
    return kpi_ratios(_closed(per_window.join(delays, "window_start", "left"), slide))


# --- streams -----------------------------------------------------------------------------

def vehicle_hours(gps: DataFrame) -> DataFrame:
    """Hourly efficiency per vehicle as a stream."""
    return trips.vehicle_hours(gps.withWatermark("event_timestamp", VEHICLE_WATERMARK))


def route_hours(gps: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Hourly driving joined to hourly deliveries of the vehicle, both windowed; append mode."""
    return trips.flatten_window(trips.route_hours(
        gps.withWatermark("event_timestamp", VEHICLE_WATERMARK),
        deliveries.withWatermark("event_timestamp", DELIVERY.watermark),
    ))


def first_copies(gps: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Drop repeated event ids that arrive within the delay; keeps the first copy, not the latest."""
    return gps.withWatermark("event_timestamp", delay).dropDuplicatesWithinWatermark(["event_id"])


def latest_copies(gps: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Of the copies of a ping the one processed last, once the watermark has passed the ping's time; then its state goes.

    Copies share id and event time. The state is one row per ping, as the maximum is kept and not the copies.
    """
    rest = [c for c in gps.columns if c not in ("event_id", "event_timestamp", "processed_at")]
    best = gps.withWatermark("event_timestamp", delay).groupBy("event_id", "event_timestamp").agg(
        F.max(F.struct("processed_at", *rest)).alias("_best"))
    return best.select("event_id", "event_timestamp", *[F.col(f"_best.{c}").alias(c) for c in ("processed_at", *rest)])


def session_trips(gps: DataFrame, gap_minutes: int = S.RATES.trip_gap_minutes, delay: str = "10 minutes") -> DataFrame:
    """Trips split by a pause of ``gap_minutes``."""
    sessions = gps.withWatermark("event_timestamp", delay).groupBy(
        F.session_window("event_timestamp", f"{gap_minutes} minutes").alias("session"), "vehicle_id",
    ).agg(F.count(F.lit(1)).alias("gps_events"))
    return sessions.select(
        "vehicle_id", F.col("session.start").alias("session_start"), F.col("session.end").alias("session_end"),
        "gps_events",
    )
