"""Sliding windows that late rows correct: nothing is dropped for being older than a watermark.

Every micro-batch stores the panes of its own rows, and then the windows that these panes touch, merged anew from all stored panes. A
late row therefore replaces the closed windows it belongs to, and its own copy goes to a side table. What is read back is
the newest revision of each window. Panes and windows are compacted like other batch outputs; no state is kept in the query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from roadgauge.functions import columns as C
from roadgauge.sources import files
from roadgauge.streaming import compaction, panes, sinks
from roadgauge.streaming.windows import FLEET, Slide

SUMS = ("events", "speed", "speeds", "fuel", "fuels", "critical", "moving", "idle")
SETS = ("vehicles", "movers", "idlers")


def _panes_combined(rows: DataFrame) -> DataFrame:
    return rows.groupBy("event_date", "step").agg(
        *[F.sum(c).alias(c) for c in SUMS], *[F.hll_union_agg(c).alias(c) for c in SETS],
        F.kll_merge_agg_double("speed_sketch").alias("speed_sketch"), F.max("latest").alias("latest"))


def _newest(rows: DataFrame) -> DataFrame:
    """The newest revision of each window."""
    rest = [c for c in rows.columns if c not in ("event_date", "window_start")]
    best = rows.groupBy("event_date", "window_start").agg(F.max_by(F.struct(*rest), "revision").alias("_best"))
    return best.select("event_date", "window_start", *[F.col(f"_best.{c}").alias(c) for c in rest])


def _starts(slide: Slide):
    """The windows that cover a pane."""
    step = F.col("step.start")
    return F.explode(F.sequence(
        step - F.make_dt_interval(mins=F.lit(slide.length - slide.step)), step, F.make_dt_interval(mins=F.lit(slide.step))))


def keep_fleet_windows(
    gps: DataFrame, path: str, checkpoint: str, slide: Slide = FLEET, interval: str | None = None, tidy: int | None = None,
) -> StreamingQuery:
    """Panes, windows and late rows below ``path``. A row is late if a row more than the slide's delay newer came in an earlier batch."""
    stored, made, late = f"{path}/panes", f"{path}/windows", f"{path}/late"

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            if files.exists(spark, stored) and number:
                seen = compaction.read(spark, stored, until=number - 1).agg(F.max("latest")).first()[0]
                limit = F.lit(seen) - F.make_dt_interval(mins=F.lit(slide.delay))
                sinks.replace_batch(batch.where(F.col("event_timestamp") < limit), number, late)
            rows = panes.fleet_panes(batch, slide)
            latest = batch.groupBy(F.window("event_timestamp", f"{slide.step} minutes").alias("step")).agg(
                F.max("event_timestamp").alias("latest"))
            own = rows.join(latest, "step").withColumn("event_date", C.event_date("step.start"))
            sinks.replace_batch(own, number, stored, ["event_date"])
        finally:
            batch.unpersist()
        touched = spark.read.parquet(stored).where(F.col("batch_id") == number).select(_starts(slide).alias("window_start")).distinct()
        bounds = touched.agg(F.min("window_start"), F.max("window_start")).first()
        if bounds[0] is None:
            return
        near = compaction.read(spark, stored, until=number).where(
            F.col("event_date").between(F.lit(bounds[0].date().isoformat()), F.date_add(F.lit(bounds[1].date()), 2).cast("string")))
        spread = _panes_combined(near).withColumn("window_start", _starts(slide)).join(touched, "window_start", "left_semi")
        windows_ = panes.merged_fleet(spread.groupBy("window_start")).withColumns({
            "window_end": F.col("window_start") + F.make_dt_interval(mins=F.lit(slide.length)),
            "event_date": C.event_date("window_start"), "revision": F.lit(number)})
        sinks.replace_batch(windows_, number, made, ["event_date"])
        if tidy and number and number % tidy == 0:
            compaction.compact(spark, stored, _panes_combined, number - 1, most=tidy - 1)
            compaction.compact(spark, made, _newest, number - 1, most=tidy - 1)

    return sinks.by_batch(gps, write, checkpoint, interval=interval)


def read_fleet_windows(spark: SparkSession, path: str) -> DataFrame:
    return _newest(compaction.read(spark, f"{path}/windows")).drop("revision")


def read_late(spark: SparkSession, path: str) -> DataFrame | None:
    """Rows that came late, with the batch that brought them; None if no batch could have any."""
    return spark.read.parquet(f"{path}/late") if files.exists(spark, f"{path}/late") else None
