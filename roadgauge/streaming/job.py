"""The streaming job: enrichment, fleet metrics, delivery enrichment and delivery KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from roadgauge.functions import columns as C
from roadgauge.sources import catalog
from roadgauge.streaming import sinks, windows


def start(gps: DataFrame, deliveries: DataFrame, root: str, interval: str | None = "30 seconds") -> list[StreamingQuery]:
    """Start the four queries, each with its own checkpoint and output folder."""
    outputs = {
        "processed/gps": C.enrich_gps(gps),
        "aggregated/hourly_metrics": catalog.conform(windows.fleet_metrics(gps), "agg_hourly_metrics"),
        "processed/deliveries": C.enrich_deliveries(deliveries),
        "aggregated/delivery_kpis": windows.delivery_kpis(deliveries),
    }
    return [
        sinks.to_parquet(df, f"{root}/{name}", f"{root}/checkpoints/{name}", name=name.replace("/", "_"), interval=interval)
        for name, df in outputs.items()
    ]
