"""Deduplication, the GPS quality gate, lifecycle checks and completeness reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from roadgauge import schemas as S
from roadgauge.functions import columns as C


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in the given order.

    The rn = 1 filter makes Spark keep one row per key in each map task before the shuffle,
    so many copies of one key never meet in one task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def latest_gps(df: DataFrame) -> DataFrame:
    """Latest processed copy of each ping; remaining columns break ties."""
    ties = [c for c in df.columns if c not in ("event_id", "processed_at")]
    return keep_first(df, ["event_id"], [F.desc("processed_at"), *[F.desc(c) for c in ties]])


def latest_deliveries(df: DataFrame) -> DataFrame:
    """Latest event per delivery and status, then by the remaining columns ascending."""
    first = [c for c in ("vehicle_id", "driver_id", "package_weight_lbs") if c in df.columns]
    rest = [c for c in df.columns if c not in ("delivery_id", "event_type", "event_timestamp", *first)]
    return keep_first(
        df, ["delivery_id", "event_type"],
        [F.desc("event_timestamp"), *[F.asc(c) for c in first + rest]],
    )


def clean_gps(df: DataFrame, fuel_scale: float = 1.0) -> DataFrame:
    """Deduplicate, then gate, then add keys.

    The gate must stay after the deduplication: filtering first could bring back an older
    valid copy of a ping whose latest copy is invalid.
    """
    ts = F.col("event_timestamp")
    return latest_gps(df).where(C.gps_valid(fuel_scale)).withColumns({
        "date_key": C.date_key(ts),
        "time_key": C.time_key(ts),
    })


def gps_rejects(df: DataFrame, fuel_scale: float = 1.0) -> DataFrame:
    """The rows the gate drops, with the failed rules."""
    return latest_gps(df).withColumn("reject_reason", C.gps_faults(fuel_scale)).where("reject_reason != ''")


def clean_deliveries(df: DataFrame) -> DataFrame:
    """Latest event per delivery and status, final statuses only, with keys and flags.

    The status is part of the deduplication key, so filtering on it first gives the same
    rows and shuffles fewer.
    """
    return flagged(latest_deliveries(df.where(C.is_terminal())))


def flagged(latest: DataFrame) -> DataFrame:
    """Time keys and flags of deduplicated delivery events."""
    ts = F.col("event_timestamp")
    return latest.withColumns({
        "date_key": C.date_key(ts),
        "time_key": C.time_key(ts),
        "is_on_time": C.is_on_time(),
        "is_successful": C.has_status("DELIVERED"),
    })


def lifecycle_violations(df: DataFrame, key: str = "delivery_id", order: list[str] | None = None) -> DataFrame:
    """Consecutive statuses of a key that the lifecycle does not allow. A key has a handful of events: a plain window does."""
    order = order or ["event_timestamp", "event_type"]
    allowed = [f"{a}>{b}" for a, following in S.LIFECYCLE.items() for b in following]
    within = Window.partitionBy(key).orderBy(*order)
    linked = df.withColumn("previous_status", F.lag("event_type").over(within))
    return linked.where(F.col("previous_status").isNotNull()).where(
        ~F.concat_ws(">", "previous_status", "event_type").isin(allowed))


def daily_availability(gps: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Rows per day in both feeds and whether both have any."""
    counts = [
        df.groupBy(C.event_date("event_timestamp").alias("event_date")).agg(F.count(F.lit(1)).alias(name))
        for df, name in ((gps, "gps_rows"), (deliveries, "delivery_rows"))
    ]
    return (
        counts[0].join(counts[1], "event_date", "full")
        .select(
            "event_date",
            F.coalesce("gps_rows", F.lit(0)).alias("gps_rows"),
            F.coalesce("delivery_rows", F.lit(0)).alias("delivery_rows"),
        )
        .withColumn("is_available", (F.col("gps_rows") > 0) & (F.col("delivery_rows") > 0))
    )


def require_available(frames: dict[str, DataFrame], day: str) -> None:
    """Raise unless each frame has a row on the day; reads one row of the day's partition."""
    missing = [name for name, df in frames.items() if df.where(F.col("event_date") == day).isEmpty()]
    if missing:
        raise ValueError(f"no {', '.join(missing)} data for {day}")


def completeness(expected: DataFrame, actual: DataFrame, columns: list[str], day: str = "event_date") -> DataFrame:
    """Per day: rows expected and written, and the null share of the given columns."""
    measures = [
        F.try_divide(F.count_if(F.col(c).isNull()), F.count(F.lit(1))).alias(f"{c}_null_rate") for c in columns
    ]
    want = expected.groupBy(day).agg(F.count(F.lit(1)).alias("expected_rows"))
    have = actual.groupBy(day).agg(F.count(F.lit(1)).alias("actual_rows"), *measures)
    joined = want.join(have, day, "full")
    return joined.withColumns({
        "expected_rows": F.coalesce("expected_rows", F.lit(0)),
        "actual_rows": F.coalesce("actual_rows", F.lit(0)),
    }).withColumn("is_complete", F.col("expected_rows") == F.col("actual_rows"))


def require_output(gps: DataFrame, summary: DataFrame, day: str) -> None:
    """Raise unless the processed GPS table and the daily aggregate hold the day."""
    missing = []
    if gps.where(F.col("event_date") == day).isEmpty():
        missing.append("processed GPS")
    if summary.where(F.col("date_key") == int(day.replace("-", ""))).isEmpty():
        missing.append("daily aggregate")
    if missing:
        raise ValueError(f"no {' and no '.join(missing)} output for {day}")
