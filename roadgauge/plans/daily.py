"""The daily batch job."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadgauge.functions import columns as C, geo
from roadgauge.operators import quality, rollups
from roadgauge.sinks import tables
from roadgauge.sources import catalog, files


@dataclass(frozen=True)
class Lake:
    """Folders of the layers below one root."""

    root: str

    def path(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"


def process_gps(raw: DataFrame, fuel_scale: float = 1.0) -> DataFrame:
    return C.enrich_gps(quality.clean_gps(raw, fuel_scale)).withColumn("geohash", geo.geohash())


def process_deliveries(raw: DataFrame) -> DataFrame:
    return C.enrich_deliveries(quality.clean_deliveries(raw))


def run_daily(
    spark: SparkSession, lake: Lake, day: str, exact: bool = False,
    load: Callable[[str, DataFrame], None] | None = None, now=None,
) -> dict[str, DataFrame]:
    """Extract, clean, write, aggregate and optionally load one day. Safe to repeat.

    Processed rows are written first and read back for the aggregates, so the deduplication
    shuffle runs once, and a lost executor costs no more than its own tasks. Every output has the types its catalog
    table declares. ``now`` is stamped as load time, by default the current time.
    """
    paths = {name: lake.path("raw", name) for name in ("gps", "deliveries")}
    raw = {name: files.scan_date(spark, path, day) for name, path in paths.items()}
    quality.require_available(raw, day)
    done = {
        "gps": process_gps(raw["gps"].drop("event_date")),
        "deliveries": process_deliveries(raw["deliveries"].drop("event_date")),
    }
    stored = {"gps": "fact_gps_events", "deliveries": "fact_deliveries", "vehicle_trips": "fact_vehicle_trips",
              "daily_summary": "agg_daily_summary"}
    for name, df in done.items():
        tables.write_event_dates(catalog.conform(C.with_lineage(df, at=now), stored[name]), lake.path("processed", name))
    facts = {name: files.scan_date(spark, lake.path("processed", name), day) for name in done}
    results = {
        "vehicle_trips": rollups.vehicle_days(facts["gps"]).withColumn("trip_date", C.day_of("date_key")),
        "daily_summary": C.with_lineage(rollups.daily_summary(facts["gps"], facts["deliveries"], exact), "created_at", now),
    }
    key = int(day.replace("-", ""))
    for name, df in results.items():
        layer = "processed" if name == "vehicle_trips" else "aggregated"
        path = lake.path(layer, name)
        tables.write_partitions(catalog.conform(df, stored[name]), path, ["date_key"])
        facts[name] = files.scan(spark, path).where(F.col("date_key") == key)
    quality.require_output(facts["gps"], facts["daily_summary"], day)
    if load is not None:
        for name, df in facts.items():
            load(name, df)
    return facts
