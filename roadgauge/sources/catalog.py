"""Catalog tables over the lake folders and their partition upkeep."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DecimalType, StructType

# Table columns of the lake layers, and the partition column.
TABLES = {
    "raw_gps_events": (
        """
        `event_id` string, `vehicle_id` string, `timestamp` string, `latitude` double, `longitude` double,
        `speed_mph` double, `heading` int, `fuel_level` double, `engine_status` string, `odometer_miles` double,
        `event_date` string""",
        "event_date",
    ),
    "raw_delivery_events": (
        """
        `event_id` string, `delivery_id` string, `order_id` string, `vehicle_id` string, `driver_id` string,
        `event_type` string, `timestamp` string, `latitude` double, `longitude` double, `customer_id` string,
        `package_weight_lbs` double, `estimated_delivery_time` string, `actual_delivery_time` string,
        `delay_minutes` int, `notes` string, `event_date` string""",
        "event_date",
    ),
    "fact_gps_events": (
        """
        `event_id` string, `vehicle_id` string, `event_timestamp` timestamp, `latitude` double, `longitude`
        double, `speed_mph` double, `heading` int, `fuel_level` double, `engine_status` string, `odometer_miles`
        double, `date_key` int, `time_key` int, `speed_category` string, `fuel_status` string, `is_moving`
        boolean, `geohash` string, `processed_at` timestamp, `event_date` string""",
        "event_date",
    ),
    "fact_deliveries": (
        """
        `event_id` string, `delivery_id` string, `order_id` string, `vehicle_id` string, `driver_id` string,
        `event_type` string, `event_timestamp` timestamp, `latitude` double, `longitude` double, `customer_id`
        string, `package_weight_lbs` double, `delay_minutes` int, `date_key` int, `time_key` int, `is_on_time`
        boolean, `is_successful` boolean, `delay_category` string, `package_size` string, `processed_at`
        timestamp, `event_date` string""",
        "event_date",
    ),
    "agg_daily_summary": (
        """
        `summary_date` date, `total_gps_events` bigint, `active_vehicles` int, `avg_speed` double,
        `avg_fuel_level` double, `total_deliveries` int, `successful_deliveries` int, `on_time_deliveries` int,
        `avg_delay_minutes` double, `active_drivers` int, `on_time_delivery_pct` decimal(5,2),
        `delivery_success_rate` decimal(5,2), `created_at` timestamp, `date_key` int""",
        "date_key",
    ),
    "agg_hourly_metrics": (
        """
        `window_start` timestamp, `window_end` timestamp, `total_events` bigint, `active_vehicles` int,
        `avg_speed` double, `median_speed` double, `avg_fuel_level` double, `critical_fuel_count` int,
        `moving_vehicles` int, `idle_vehicles` int, `fleet_utilization_pct` decimal(5,2), `event_date` string""",
        "event_date",
    ),
    "fact_vehicle_trips": (
        """
        `vehicle_id` string, `trip_date` date, `gps_events` int, `start_time` timestamp, `end_time` timestamp,
        `avg_speed_mph` double, `max_speed_mph` double, `min_fuel_level` double, `max_fuel_level` double,
        `idle_events` int, `moving_events` int, `duration_minutes` double, `fuel_consumed` double,
        `idle_time_pct` double, `date_key` int""",
        "date_key",
    ),
    "dim_vehicles": (
        """
        `vehicle_id` string, `vehicle_type` string, `make` string, `model` string, `year` int, `license_plate`
        string, `capacity_lbs` double, `fuel_type` string, `home_depot` string, `status` string,
        `effective_start` timestamp, `effective_end` timestamp, `is_current` boolean""",
        None,
    ),
    "dim_drivers": (
        """
        `driver_id` string, `driver_name` string, `license_number` string, `hire_date` date, `home_depot`
        string, `status` string, `rating` double, `effective_start` timestamp, `effective_end` timestamp,
        `is_current` boolean""",
        None,
    ),
    "dim_date": (
        """
        `date_key` int, `full_date` date, `day_of_week` int, `day_name` string, `day_of_month` int,
        `day_of_year` int, `week_of_year` int, `month_num` int, `month_name` string, `quarter` int, `year` int,
        `is_weekend` boolean, `is_holiday` boolean""",
        None,
    ),
}
FOLDERS = {
    "raw_gps_events": "raw/gps",
    "raw_delivery_events": "raw/deliveries",
    "fact_gps_events": "processed/gps",
    "fact_deliveries": "processed/deliveries",
    "agg_daily_summary": "aggregated/daily_summary",
    "agg_hourly_metrics": "aggregated/hourly_metrics",
    "fact_vehicle_trips": "processed/vehicle_trips",
    "dim_vehicles": "dimensions/vehicles",
    "dim_drivers": "dimensions/drivers",
    "dim_date": "dimensions/date",
}
# end of fixed values


def create_table_sql(name: str, root: str, database: str) -> str:
    columns, partition = TABLES[name]
    by = "" if partition is None else f" partitioned by ({partition})"
    return (
        f"create table if not exists {database}.{name} ({columns.strip()}) using parquet{by}"
        f" location '{root.rstrip('/')}/{FOLDERS[name]}'"
    )


def declared(name: str) -> StructType:
    """Columns of a table, the partition column last."""
    return StructType.fromDDL(TABLES[name][0].strip())


def conform(df: DataFrame, name: str) -> DataFrame:
    """The frame as the table declares it: declared columns in declared types, null if absent, and then any others.

    A decimal that does not fit is null; any other value that does not fit its type is an error.
    """
    def cast(field):
        if field.name not in df.columns:
            return F.lit(None).cast(field.dataType)
        fits_or_null = isinstance(field.dataType, DecimalType)
        return (F.col(field.name).try_cast if fits_or_null else F.col(field.name).cast)(field.dataType)

    fields = declared(name).fields
    known = {field.name for field in fields}
    return df.select(*[cast(f).alias(f.name) for f in fields], *[c for c in df.columns if c not in known])


def create_tables(spark: SparkSession, root: str, database: str = "telemetry") -> list[str]:
    """Create the database and its external tables; existing ones are kept."""
    spark.sql(f"create database if not exists {database}")
    for name in TABLES:
        spark.sql(create_table_sql(name, root, database))
    return list(TABLES)


def repair(spark: SparkSession, table: str) -> None:
    """Register partition folders written outside the catalog."""
    spark.sql(f"msck repair table {table}")


def add_partition(spark: SparkSession, table: str, column: str, value) -> None:
    """Register one partition, which is cheaper than a repair."""
    literal = value if isinstance(value, int) else f"'{value}'"
    spark.sql(f"alter table {table} add if not exists partition ({column}={literal})")

