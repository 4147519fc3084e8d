"""Running counters and latest state kept by micro-batches.

Each micro-batch writes only its own small aggregate, below its date and batch id. Reading
combines the batches of a date. Nothing is read and written back, so a repeated batch cannot
count twice and no micro-batch grows with the history. Every ``tidy`` batches those that are committed are
compacted, so that the number of files per date stays bounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from roadgauge.functions import columns as C
from roadgauge.operators import reports, rollups, vehicle_sets
from roadgauge.sources import files
from roadgauge.streaming import compaction, sinks


def _keep(
    df: DataFrame, aggregate, path: str, checkpoint: str, interval: str | None, combine=None, tidy: int | None = None,
) -> StreamingQuery:
    def write(batch: DataFrame, number: int) -> None:
        sinks.replace_batch(aggregate(batch), number, path, ["event_date"])
        _tidy(batch.sparkSession, path, combine, number, tidy)

    return sinks.by_batch(df, write, checkpoint, interval=interval)


def _tidy(spark: SparkSession, path: str, combine, number: int, tidy: int | None) -> None:
    """Batches before the running one are committed and are never written again."""
    if tidy and number and number % tidy == 0:
        compaction.compact(spark, path, combine, number - 1, most=tidy - 1)


def _deliveries_combined(rows: DataFrame) -> DataFrame:
    sums = ("total_deliveries", "total_delay_minutes", "on_time_count", "failed_attempts")
    return rows.groupBy("event_date").agg(*[F.sum(c).alias(c) for c in sums], F.max("last_updated").alias("last_updated"))


def _drivers_combined(rows: DataFrame) -> DataFrame:
    return rows.groupBy("driver_id", "event_date").agg(
        F.sum("deliveries_completed").alias("deliveries_completed"),
        F.sum("total_delay").alias("total_delay"),
        F.max("last_updated").alias("last_updated"),
    )


def keep_delivery_counters(
    deliveries: DataFrame, path: str, checkpoint: str, interval: str | None = None, tidy: int | None = None,
):
    return _keep(deliveries, rollups.delivery_counters, path, checkpoint, interval, _deliveries_combined, tidy)


def read_delivery_counters(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    return _deliveries_combined(compaction.read(spark, path, since))


def keep_driver_counters(
    deliveries: DataFrame, path: str, checkpoint: str, interval: str | None = None, tidy: int | None = None,
):
    return _keep(deliveries, rollups.driver_day_counters, path, checkpoint, interval, _drivers_combined, tidy)


def read_driver_counters(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    return _drivers_combined(compaction.read(spark, path, since))


HOURLY = ["event_date", "hour"]


def _sets_combined(rows: DataFrame) -> DataFrame:
    return vehicle_sets.merged(rows, HOURLY)


def keep_fleet_counters(
    gps: DataFrame, path: str, checkpoint: str, interval: str | None = None, tidy: int | None = None,
):
    """Kept as sets of vehicles per hour: one row per batch, hour and block of vehicle numbers, so vehicles are counted exactly.

    A vehicle gets its number in the first batch that has it; numbers are written below their batch, too, so a
    repeated batch gives the same ones.
    """
    numbers, sets = f"{path}/numbers", f"{path}/sets"

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        # numbered first, and aggregated with the numbers after
        batch.persist()
        try:
            known = None
            if files.exists(spark, numbers):
                known = spark.read.parquet(numbers).where(F.col("batch_id") != number)
            sinks.replace_batch(vehicle_sets.numbered(batch, known), number, numbers)
            named = batch.join(spark.read.parquet(numbers).select("vehicle_id", "vehicle_number"), "vehicle_id", "left")
            hourly = named.withColumns({
                "event_date": C.event_date("event_timestamp"), "hour": F.date_trunc("hour", "event_timestamp"),
                "is_moving": C.is_moving()})
            sinks.replace_batch(vehicle_sets.vehicle_sets(hourly, HOURLY), number, sets, ["event_date"])
        finally:
            batch.unpersist()
        _tidy(spark, sets, _sets_combined, number, tidy)

    return sinks.by_batch(gps, write, checkpoint, interval=interval)


def read_fleet_counters(spark: SparkSession, path: str, since: str | None = None, by: str = "event_date") -> DataFrame:
    """Per date, or per ``hour``: pings, exact distinct vehicles, their estimate, moving pings, latest time."""
    return vehicle_sets.counts(compaction.read(spark, f"{path}/sets", since), [by])


def _positions_combined(rows: DataFrame) -> DataFrame:
    """The newest ping of each vehicle and date."""
    order = [c for c in ("event_timestamp", "processed_at") if c in rows.columns]
    return reports.latest_per_key(rows, ["vehicle_id", "event_date"], order)


def keep_positions(gps: DataFrame, path: str, checkpoint: str, interval: str | None = None, tidy: int | None = None):
    """Newest ping per vehicle and micro-batch."""
    def aggregate(batch: DataFrame) -> DataFrame:
        return reports.latest_positions(batch).withColumn("event_date", C.event_date("event_timestamp"))

    return _keep(gps, aggregate, path, checkpoint, interval, _positions_combined, tidy)


def read_positions(spark: SparkSession, path: str, as_of=None, hours: int = 24) -> DataFrame:
    """Newest ping per vehicle by event time, whatever order batches came in. With ``as_of``
    only pings younger than ``hours``, reading only the dates that can hold them."""
    rows = compaction.read(spark, path)
    if as_of is not None:
        oldest = F.lit(as_of).cast("timestamp") - F.make_dt_interval(hours=F.lit(hours))
        rows = reports.unexpired(rows.where(F.col("event_date") >= F.to_date(oldest).cast("string")), as_of, hours)
    return reports.latest_positions(rows.drop("event_date"))


def keep_alerts(deliveries: DataFrame, path: str, checkpoint: str, interval: str | None = None):
    def aggregate(batch: DataFrame) -> DataFrame:
        return reports.alerts(batch).withColumn("event_date", C.event_date("event_timestamp"))

    return _keep(deliveries, aggregate, path, checkpoint, interval)
