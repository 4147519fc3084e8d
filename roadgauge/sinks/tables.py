"""Partitioned table writes and warehouse loads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F


def write_partitions(df: DataFrame, path: str, by: list[str], sort: list[str] | None = None,
                     files_per_partition: int | None = None, dealt: bool = False, mode: str = "overwrite") -> None:
    """Replace exactly the partitions the frame has rows for, or add to them with mode "append".

    With ``files_per_partition`` rows are spread over that many tasks per partition value
    first: few files per day, and a heavy day still has many writers. Without it each task
    writes what it holds, and AQE's rebalance keeps file sizes even. ``dealt``: the rows come evenly from a shuffle or a
    scan; each task writes a file per partition value, and the rows are not shuffled for it.
    """
    if dealt:
        out = df
    elif files_per_partition is None:
        out = df.hint("rebalance", *[F.col(c) for c in by])
    else:
        # a hash of the row, so a repeated task sends every row where it went before
        salt = F.pmod(F.xxhash64(*df.columns), F.lit(files_per_partition))
        out = df.repartition(*[F.col(c) for c in by], salt)
    if sort:
        out = out.sortWithinPartitions(*by, *sort)
    out.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def write_event_dates(df: DataFrame, path: str) -> None:
    write_partitions(df, path, ["event_date"])


def write_day_rollup(df: DataFrame, path: str) -> None:
    write_partitions(df, path, ["year", "month", "day"])


def write_json_report(report: DataFrame, path: str, day: str = "report_date") -> None:
    """One JSON document per day in the day's folder."""
    (
        report.withColumn("day", F.col(day).cast("string"))
        .repartition("day")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").json(path)
    )


def _identifier(table: str) -> str:
    if not all(part.isidentifier() for part in table.split(".")):
        raise ValueError(f"not a plain identifier: {table}")
    return table


def warehouse_delete_sql(table: str, keys: list[int]) -> str:
    """Statement that makes a repeated load of the same days idempotent."""
    return f"delete from {_identifier(table)} where date_key in ({', '.join(str(int(k)) for k in keys)})"


def warehouse_swap_sql(table: str, staging: str, columns: list[str], keys: list[int]) -> str:
    """One batch that replaces the days by the staged rows, or changes nothing."""
    names = ", ".join(_identifier(c) for c in columns)
    return (
        f"begin; {warehouse_delete_sql(table, keys)}; insert into {table} ({names}) select {names} from {_identifier(staging)};"
        f" delete from {staging}; commit"
    )


def load_warehouse(
    df: DataFrame, url: str, table: str, properties: dict[str, str], execute: Callable[[str], None],
    keys: list[int], batch_size: int = 10_000, connections: int = 32,
) -> None:
    """Replace the days ``keys`` of a warehouse table by the rows, all of which must belong to them.

    Rows go to ``<table>_staging`` first, which must exist with the same columns; then one batch of statements swaps them in.
    ``execute`` runs statements on the warehouse (its client library is not part of Spark). ``connections`` bounds
    parallel inserts.
    """
    outside = df.where(~F.coalesce(F.col("date_key").isin(keys), F.lit(False))).limit(1).count()
    if outside:
        raise ValueError(f"rows for {table} lie outside the days {keys}")
    staging = f"{table}_staging"
    execute(f"delete from {_identifier(staging)}")
    (
        df.write.format("jdbc").options(**properties)
        .option("url", url).option("dbtable", staging)
        .option("batchsize", str(batch_size)).option("numPartitions", str(connections))
        .mode("append").save()
    )
    execute(warehouse_swap_sql(table, staging, df.columns, keys))


# Measures and names the warehouse fact tables expect.
def to_fact_gps(gps: DataFrame) -> DataFrame:
    """Columns of the warehouse GPS fact; keys come from dimension lookups done before."""
    return gps.selectExpr(
        "cast(event_id as string) as event_id", "date_key", "time_key", "vehicle_key", "location_key",
        "cast(latitude as decimal(10,6)) as latitude", "cast(longitude as decimal(10,6)) as longitude",
        "try_cast(speed_mph as decimal(5,2)) as speed_mph", "heading", "engine_status",
        "cast(fuel_level as decimal(5,3)) as fuel_level",
        "cast(odometer_miles as decimal(12,2)) as odometer_miles", "event_timestamp",
    )


def to_fact_deliveries(deliveries: DataFrame) -> DataFrame:
    """Columns of the warehouse delivery fact."""
    return deliveries.selectExpr(
        "delivery_id", "order_id", "date_key", "time_key", "vehicle_key", "driver_key", "customer_key",
        "delay_minutes", "cast(package_weight_lbs as decimal(10,2)) as package_weight_lbs",
        "event_type as delivery_status", "is_on_time", "is_successful", "attempt_number",
        "event_timestamp as created_at",
    )


def to_fact_trips(trips: DataFrame) -> DataFrame:
    """Columns of the warehouse trip fact."""
    return trips.selectExpr(
        "trip_id", "date_key", "vehicle_key", "start_time", "end_time",
        "cast(round(duration_minutes) as int) as duration_minutes",
        "cast(distance_miles as decimal(10,2)) as distance_miles",
        "cast(gallons as decimal(10,2)) as fuel_consumed_gallons",
        "try_cast(avg_speed_mph as decimal(5,2)) as avg_speed_mph",
        "try_cast(max_speed_mph as decimal(5,2)) as max_speed_mph",
        "cast(round(idle_minutes) as int) as idle_time_minutes", "stop_count",
        "cast(fuel_cost as decimal(10,2)) as fuel_cost", "try_cast(cost_per_mile as decimal(10,4)) as cost_per_mile",
    )
