"""Ordered per-key operators that stay balanced when one key holds much of the data.

A plain window partitioned by vehicle would sort a busy vehicle's whole history in one task.
Here a key's rows are windowed per time slice, and what must cross a slice border is carried
by a table of one row per key and slice. Results equal the plain window's. The row table is
shuffled once, by (key, slice); the carry joins on the same columns.

An input with costly lineage should be a written table, since rows and carry both read it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from roadgauge.session import stage

SLICE = "hour"
_SLICE = "_slice"
_KEY = "_key"


def _sliced(df: DataFrame, key: str | list[str], ts: str, unit: str) -> DataFrame:
    """Add the slice and the key as one struct; a frame that kept them stays partitioned by them and is not shuffled again.

    Structs with null fields are equal to each other, so rows of a null key belong together as in a plain window.
    """
    if _SLICE in df.columns:
        return df
    keys = [key] if isinstance(key, str) else list(key)
    return df.withColumns({_SLICE: F.date_trunc(unit, ts), _KEY: F.struct(*keys)})


def _tidy(df: DataFrame, keep_slice: bool, *helpers: str) -> DataFrame:
    return df.drop(*helpers) if keep_slice else df.drop(*helpers, _SLICE, _KEY)


def with_previous(
    df: DataFrame, key: str | list[str], order: list[str], columns: list[str], name: str = "previous",
    unit: str = SLICE, keep_slice: bool = False,
) -> DataFrame:
    """Add a struct of the given columns from the key's preceding row; null fields on its first.

    ``order`` starts with the timestamp and must order a key's rows fully. With ``keep_slice``
    a following operator on the same key and order needs no further shuffle of the rows.
    """
    fields = list(dict.fromkeys(order + columns))
    rows = _sliced(df, key, order[0], unit)
    within = Window.partitionBy(_KEY, _SLICE).orderBy(*order)
    last = rows.groupBy(_KEY, _SLICE).agg(F.max(F.struct(*fields)).alias("_last"))
    carry = last.select(
        _KEY, _SLICE, F.lag("_last").over(Window.partitionBy(_KEY).orderBy(_SLICE)).alias("_carry"),
    )
    joined = rows.withColumn("_here", F.lag(F.struct(*fields)).over(within)).join(carry, [_KEY, _SLICE], "left")
    return _tidy(joined.withColumn(name, F.coalesce("_here", "_carry")), keep_slice, "_here", "_carry")


def with_next(
    df: DataFrame, key: str | list[str], order: list[str], columns: list[str], name: str = "following",
    unit: str = SLICE, keep_slice: bool = False,
) -> DataFrame:
    """Mirror of :func:`with_previous`."""
    fields = list(dict.fromkeys(order + columns))
    rows = _sliced(df, key, order[0], unit)
    within = Window.partitionBy(_KEY, _SLICE).orderBy(*order)
    first = rows.groupBy(_KEY, _SLICE).agg(F.min(F.struct(*fields)).alias("_first"))
    carry = first.select(
        _KEY, _SLICE, F.lead("_first").over(Window.partitionBy(_KEY).orderBy(_SLICE)).alias("_carry"),
    )
    joined = rows.withColumn("_here", F.lead(F.struct(*fields)).over(within)).join(carry, [_KEY, _SLICE], "left")
    return _tidy(joined.withColumn(name, F.coalesce("_here", "_carry")), keep_slice, "_here", "_carry")


def with_running_total(
    df: DataFrame, key: str | list[str], order: list[str], value: Column, name: str, unit: str = SLICE,
    keep_slice: bool = False,
) -> DataFrame:
    """Sum of ``value`` over the key's rows up to and including this one."""
    rows = _sliced(df, key, order[0], unit).withColumn("_value", value)
    upto = Window.partitionBy(_KEY, _SLICE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(_KEY).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        rows.groupBy(_KEY, _SLICE).agg(F.sum("_value").alias("_sum"))
        .select(_KEY, _SLICE, F.sum("_sum").over(before).alias("_carry"))
    )
    joined = rows.withColumn("_here", F.sum("_value").over(upto)).join(carry, [_KEY, _SLICE], "left")
    return _tidy(joined.withColumn(name, F.col("_here") + F.coalesce("_carry", F.lit(0))), keep_slice, "_here", "_carry", "_value")


def with_last_known(
    df: DataFrame, key: str | list[str], order: list[str], column: str, name: str, unit: str = SLICE,
    keep_slice: bool = False,
) -> DataFrame:
    """Latest non-null value of a column over the key's rows up to and including this one."""
    rows = _sliced(df, key, order[0], unit)
    upto = Window.partitionBy(_KEY, _SLICE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(_KEY).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    known = F.struct(*dict.fromkeys([*order, column]))
    carry = (
        rows.groupBy(_KEY, _SLICE)
        .agg(F.max(F.when(F.col(column).isNotNull(), known)).alias("_last"))
        .select(_KEY, _SLICE, F.last("_last", ignorenulls=True).over(before).alias("_carry"))
    )
    joined = rows.withColumn("_here", F.last(column, ignorenulls=True).over(upto)).join(carry, [_KEY, _SLICE], "left")
    return _tidy(joined.withColumn(name, F.coalesce("_here", F.col("_carry")[column])), keep_slice, "_here", "_carry")


def with_driver_as_of(pings: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Add the driver of the vehicle's latest delivery event at or before each ping.

    Both feeds are stacked and the last driver is carried forward, so there is no range join.
    At equal times deliveries come first; of several deliveries at one time the highest
    driver id counts.
    """
    columns = pings.columns
    stacked = (
        deliveries.where("driver_id is not null")
        .select("vehicle_id", "event_timestamp", "driver_id", F.lit(0).alias("_feed"))
        .unionByName(pings.withColumn("_feed", F.lit(1)), allowMissingColumns=True)
    )
    # read twice below
    filled = with_last_known(
        stage(stacked, "stacked-feeds"), "vehicle_id", ["event_timestamp", "_feed", "driver_id"], "driver_id", "driver_as_of",
    )
    return filled.where("_feed = 1").select(*columns, F.col("driver_as_of").alias("driver_id"))
