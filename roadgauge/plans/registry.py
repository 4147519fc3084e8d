"""Registered queries: a name, a Spark function over the sample tables, and check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from roadgauge.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECK_SQL: dict[str, str] = {}

STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def comparable(df: DataFrame) -> DataFrame:
    """Same rows in types that compare across engines: wide integers, rounded doubles, text times."""
    def shown(field: T.StructField):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(field.dataType, (T.DecimalType, T.DoubleType, T.FloatType)):
            # two steps: sums of doubles differ in their last bits, which must not decide a half
            c = F.round(F.round(c.cast("double"), 9), 6)
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, STAMP)
        elif isinstance(field.dataType, T.DateType):
            c = c.cast("string")
        return c.alias(field.name)

    return df.select([shown(field) for field in df.schema.fields])


def query(name: str, sql: str | None = None):
    """Register a function of (spark, folder) under a name."""
    def register(function: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            configure(spark)
            return comparable(function(spark, folder))

        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            CHECK_SQL[name] = sql
        return function

    return register


# --- pieces of check SQL -----------------------------------------------------------------

def rd(expr: str, name: str | None = None) -> str:
    return f"cast(round(cast(round({expr}, 9) as decimal(38, 9)), 6) as double) as {name or expr}"


def n(expr: str, name: str | None = None) -> str:
    return f"cast({expr} as bigint) as {name or expr}"


def at(expr: str, name: str | None = None) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f') as {name or expr}"


def close_count(near: str, exact: str):
    """Whether an approximate distinct count is as near as its sketch allows.

    The sketch has 512 registers and a standard error of 5 percent; three of those are
    allowed. Below 20 values the error is whole collisions instead: ten values share a
    register three times in about one of ten thousand sketches, so up to three may be missing.
    """
    return F.abs(F.col(near) - F.col(exact)) <= F.greatest(F.col(exact) * 0.15, F.lit(3.0))


_CTE: dict[str, tuple[str, tuple[str, ...]]] = {
    "gps_base": ("""
        select event_id, concat('V', lpad(cast(user_id % 100 + 1 as varchar), 4, '0')) as vehicle_id,
            ts as event_timestamp,
            case when event_id % 97 = 0 then 95.0e0 else 25.0e0 + (event_id * 7919 % 23000) / 1000.0e0 end as latitude,
            case when event_id % 83 = 0 then 181.0e0
                else -125.0e0 + (event_id * 104729 % 55000) / 1000.0e0 end as longitude,
            case when event_id % 89 = 0 then -1.0e0 when event_type in ('error', 'signup') then 0.0e0
                else least(value, 85.0e0) end as speed_mph,
            cast(event_id * 37 % 360 as int) as heading,
            case when event_id % 79 = 0 then 1.5e0
                else cast(json_extract_string(props, '$.k') as int) / 100.0e0 end as fuel_level,
            case event_type when 'error' then 'OFF' when 'signup' then 'IDLE' else 'ON' end as engine_status,
            10000.0e0 + event_id / 10.0e0 as odometer_miles
        from events""", ()),
    "gps": ("""
        select *, event_timestamp + interval 5 second as processed_at from gps_base
        union all
        select event_id, vehicle_id, event_timestamp, latitude, longitude,
            case when speed_mph > 0 then speed_mph + 1.0e0 else speed_mph end, heading, fuel_level,
            engine_status, odometer_miles, event_timestamp + interval 65 second
        from gps_base where event_id % 10 = 0""", ("gps_base",)),
    "deliveries": ("""
        select concat('DEL-', cast(l_orderkey as varchar), '-', cast(l_linenumber as varchar)) as delivery_id,
            concat('ORD-', cast(l_orderkey as varchar)) as order_id,
            concat('V', lpad(cast(l_partkey % 100 + 1 as varchar), 4, '0')) as vehicle_id,
            concat('D', lpad(cast(l_suppkey as varchar), 4, '0')) as driver_id,
            concat('CUST-', lpad(cast(o_custkey as varchar), 5, '0')) as customer_id,
            case when l_returnflag = 'R' and l_linestatus = 'F' then 'FAILED_ATTEMPT'
                when l_returnflag = 'R' then 'RETURNED'
                when l_returnflag = 'N' and l_linestatus = 'F' then 'OUT_FOR_DELIVERY' else 'DELIVERED' end as event_type,
            timestamp '2023-12-31 00:00:00'
                + to_seconds((l_orderkey * 7919 + l_linenumber * 3607 + l_partkey * 61) % 2505600) as event_timestamp,
            case when l_partkey % 53 = 0 then null
                else cast((l_partkey * 13 + l_linenumber * 7 + l_suppkey) % 121 as int) - 40 end as delay_minutes,
            l_quantity * 0.5e0 as package_weight_lbs, l_extendedprice as declared_value,
            l_quantity as distance_miles, l_discount * 100 as tip_amount
        from lineitem join orders on l_orderkey = o_orderkey""", ()),
    "gps_latest": ("""
        select *, cast(strftime(event_timestamp, '%Y-%m-%d') as varchar) as event_date,
            cast(strftime(event_timestamp, '%Y%m%d') as bigint) as date_key
        from gps qualify row_number() over (partition by event_id order by processed_at desc) = 1""", ("gps",)),
    "gps_clean": ("""
        select * from gps_latest where latitude between -90 and 90 and longitude between -180 and 180
            and speed_mph >= 0 and fuel_level between 0 and 1""", ("gps_latest",)),
    "del_latest": ("""
        select *, cast(strftime(event_timestamp, '%Y-%m-%d') as varchar) as event_date,
            cast(strftime(event_timestamp, '%Y%m%d') as bigint) as date_key
        from deliveries
        qualify row_number() over (partition by delivery_id, event_type
            order by event_timestamp desc, vehicle_id, driver_id, package_weight_lbs, order_id, customer_id,
                delay_minutes nulls first, declared_value, distance_miles, tip_amount) = 1""", ("deliveries",)),
    "del_clean": ("""
        select *, delay_minutes <= 0 as is_on_time, event_type = 'DELIVERED' as is_successful
        from del_latest where event_type in ('DELIVERED', 'FAILED_ATTEMPT', 'RETURNED')""", ("del_latest",)),
    "vehicles": ("""
        select vehicle_id, case cast(substr(vehicle_id, 2) as int) % 3
            when 0 then 'VAN' when 1 then 'TRUCK' else 'CAR' end as vehicle_type
        from (select vehicle_id from gps union select vehicle_id from deliveries)""", ("gps", "deliveries")),
    "drivers": ("""
        select concat('D', lpad(cast(s_suppkey as varchar), 4, '0')) as driver_id, s_name as driver_name,
            s_nationkey as home_depot from supplier""", ()),
    "daily_gps": ("""
        select date_key, count(*) as total_gps_events, count(distinct vehicle_id) as active_vehicles,
            avg(speed_mph) as avg_speed, avg(fuel_level) as avg_fuel_level
        from gps_clean group by date_key""", ("gps_clean",)),
    "daily_del": ("""
        select date_key, count(*) as total_deliveries,
            count(*) filter (is_successful) as successful_deliveries,
            count(*) filter (is_on_time) as on_time_deliveries,
            avg(delay_minutes) as avg_delay_minutes, count(distinct driver_id) as active_drivers,
            count(distinct vehicle_id) as delivery_vehicles
        from del_clean group by date_key""", ("del_clean",)),
    "summary": ("""
        select date_key, total_gps_events, active_vehicles, avg_speed, avg_fuel_level, total_deliveries,
            successful_deliveries, on_time_deliveries, avg_delay_minutes, active_drivers, delivery_vehicles,
            strftime(strptime(cast(date_key as varchar), '%Y%m%d'), '%Y-%m-%d') as summary_date,
            round(on_time_deliveries / total_deliveries::double * 100, 2) as on_time_delivery_pct,
            round(successful_deliveries / total_deliveries::double * 100, 2) as delivery_success_rate
        from daily_gps full join daily_del using (date_key)""", ("daily_gps", "daily_del")),
}


def define(name: str, sql: str, *needs: str) -> None:
    """Add a named subquery other check SQL can use."""
    _CTE[name] = (sql, needs)


def check(body: str, *needs: str) -> str:
    """The body preceded by the subqueries it needs."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for other in _CTE[name][1]:
            visit(other)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        visit(name)
    clauses = ", ".join(f"{name} as ({_CTE[name][0].strip()})" for name in ordered)
    return f"with {clauses} {body.strip()}" if clauses else body.strip()
