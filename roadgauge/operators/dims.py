"""Date, time, vehicle, driver, customer and location dimensions and fact key lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from roadgauge.functions import columns as C, geo
from roadgauge.operators import timeline


def dim_date(spark: SparkSession, first: str, last: str, holidays: DataFrame | None = None) -> DataFrame:
    """One row per day of the span. ``holidays`` is a table of full_date values."""
    span = spark.range(1).select(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date")).alias("days"))
    return date_columns(span.select(F.explode("days").alias("full_date")), holidays)


def dim_date_of(df: DataFrame, ts: str = "event_timestamp", holidays: DataFrame | None = None) -> DataFrame:
    """Every day from the first to the last event of a table."""
    span = df.agg(F.to_date(F.min(ts)).alias("first"), F.to_date(F.max(ts)).alias("last"))
    days = span.select(F.explode(F.sequence("first", "last")).alias("full_date"))
    return date_columns(days, holidays)


def date_columns(days: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    d = F.col("full_date")
    out = days.select(
        C.date_key(d).alias("date_key"),
        d,
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.day(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("week_of_year"),
        F.month(d).alias("month_num"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        (F.weekday(d) >= 5).alias("is_weekend"),
    )
    if holidays is None:
        return out.withColumn("is_holiday", F.lit(False))
    marked = holidays.select("full_date").distinct().withColumn("_h", F.lit(True))
    return out.join(marked, "full_date", "left").withColumn("is_holiday", F.coalesce("_h", F.lit(False))).drop("_h")


def dim_time(spark: SparkSession) -> DataFrame:
    """The 1,440 minutes of a day. Morning 5-11, afternoon 12-16, evening 17-20, else night."""
    h = F.col("hour")
    return spark.range(1440).select(
        F.floor(F.col("id") / 60).cast("int").alias("hour"), (F.col("id") % 60).cast("int").alias("minute"),
    ).select(
        (h * 100 + F.col("minute")).alias("time_key"), "hour", "minute",
        ((h + 11) % 12 + 1).alias("hour_12"),
        F.when(h < 12, "AM").otherwise("PM").alias("am_pm"),
        F.when(h.between(5, 11), "Morning").when(h.between(12, 16), "Afternoon")
        .when(h.between(17, 20), "Evening").otherwise("Night").alias("time_of_day"),
        h.between(9, 17).alias("is_business_hours"),
    )


def surrogate_key(*columns: str) -> Column:
    """Hash of business key and start time: stable across runs and needs no global counter."""
    return F.xxhash64(*columns)


def versioned_dim(history: DataFrame, key: str, name: str) -> DataFrame:
    """A history table with its surrogate key."""
    return history.withColumn(name, surrogate_key(key, "effective_start"))


def dim_location(gps: DataFrame, precision: int = 5) -> DataFrame:
    """One row per geohash cell seen, with the middle of the cell."""
    lat, lon = geo.cell_centre(precision=precision)
    return gps.select(
        geo.geohash(precision=precision).alias("geohash"), lat.alias("latitude"), lon.alias("longitude"),
    ).distinct()


def lookup_key(facts: DataFrame, dim: DataFrame, key: str, name: str, ts: str = "event_timestamp") -> DataFrame:
    """Add the key of the dimension version valid at the fact's time; null if there is none.

    Versions and facts are stacked per key and the last version is carried forward, slice by slice of time. So a fact meets one
    version however many its key has, and a key with very many facts is spread over tasks.
    """
    columns = facts.columns
    versions = dim.select(
        key, F.col("effective_start").alias(ts), F.struct(F.col(name).alias("key"), "effective_end").alias("_version"), F.lit(0).alias("_feed"))
    stacked = versions.unionByName(facts.withColumn("_feed", F.lit(1)), allowMissingColumns=True)
    filled = timeline.with_last_known(stacked, key, [ts, "_feed"], "_version", "_valid", unit="day")
    valid = F.col("_valid.effective_end").isNull() | (F.col(ts) < F.col("_valid.effective_end"))
    return filled.where("_feed = 1").select(*columns, F.when(valid, F.col("_valid.key")).alias(name))
