"""Registered queries: sources, derived columns, filters, deduplication."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadgauge import schemas as S
from roadgauge.functions import columns as C, geo
from roadgauge.operators import quality
from roadgauge.plans.registry import at, check, n, query, rd
from roadgauge.session import scratch_dir
from roadgauge.sinks import tables
from roadgauge.sources import files, records, sample


def landed_gps(spark: SparkSession, folder: str) -> str:
    """Pings written by event_date."""
    path = scratch_dir(spark, "landed-gps")
    tables.write_event_dates(sample.event_day(sample.gps(spark, folder)), path)
    return path


def landed_rollup_gps(spark: SparkSession, folder: str) -> str:
    """Pings written by year, month and day."""
    path = scratch_dir(spark, "landed-rollup")
    tables.write_day_rollup(sample.rollup_gps(spark, folder), path)
    return path


PING = f"event_id, vehicle_id, {at('processed_at')}, {rd('speed_mph')}"
PING_COLUMNS = ["event_id", "vehicle_id", "processed_at", "speed_mph"]


@query("s1_scan_date", check(
    f"select {PING}, '2024-01-15' as event_date from gps where cast(event_timestamp as date) = date '2024-01-15'", "gps"))
def s1(spark, folder):
    return files.scan_date(spark, landed_gps(spark, folder), "2024-01-15").select(
        *PING_COLUMNS, F.col("event_date").cast("string").alias("event_date"))


@query("s2_scan_day_partitions", check(
    f"select {PING}, year(event_timestamp) as year, month(event_timestamp) as month, day(event_timestamp) as day from gps",
    "gps"))
def s2(spark, folder):
    return files.scan(spark, landed_rollup_gps(spark, folder)).select(*PING_COLUMNS, "year", "month", "day")


@query("s3_scan_time_range", check(
    f"""select {PING} from gps where event_timestamp > timestamp '2024-01-10 06:30:00'
        and event_timestamp < timestamp '2024-01-12 18:45:00'""", "gps"))
def s3(spark, folder):
    low, high = datetime(2024, 1, 10, 6, 30), datetime(2024, 1, 12, 18, 45)
    return files.scan_range(spark, landed_gps(spark, folder), "event_timestamp", low, high).select(*PING_COLUMNS)


@query("s4_scan_newer_partitions", check(
    f"select {PING} from gps where cast(event_timestamp as date) > date '2024-01-13'", "gps"))
def s4(spark, folder):
    return files.scan_newer_partitions(spark, landed_rollup_gps(spark, folder), date(2024, 1, 13)).select(*PING_COLUMNS)


def wrapped_gps(spark: SparkSession, folder: str) -> DataFrame:
    """Pings as base64-wrapped JSON; every 101st is cut short and so malformed."""
    pings = sample.gps(spark, folder).select(
        F.col("event_id").cast("string").alias("event_id"), "vehicle_id",
        F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        "latitude", "longitude", "speed_mph", "heading", "fuel_level", "engine_status", "odometer_miles",
    )
    text = F.to_json(F.struct(*pings.columns))
    cut = F.when(F.col("event_id").cast("bigint") % 101 == 0, F.expr("substring(text, 1, 20)")).otherwise(F.col("text"))
    return pings.withColumn("text", text).select(F.base64(F.encode(cut, "UTF-8")).alias("payload"))


@query("s8_wrapped_records", check(
    f"""select cast(event_id as varchar) as event_id, vehicle_id, {rd('latitude')}, {rd('speed_mph')}, heading,
        engine_status, {at('event_timestamp')} from gps where event_id % 101 <> 0""", "gps"))
def s8(spark, folder):
    parsed = records.unwrap(wrapped_gps(spark, folder), "payload", S.GPS_EVENT)
    return records.good(parsed, S.GPS_EVENT).select(
        "event_id", "vehicle_id", "latitude", "speed_mph", "heading", "engine_status", "event_timestamp")


@query("s9_bad_record_split", check(
    """select case when event_id % 101 = 0 then 'malformed JSON' else 'good' end as outcome, count(*) as records
        from gps group by 1""", "gps"))
def s9(spark, folder):
    parsed = records.unwrap(wrapped_gps(spark, folder), "payload", S.GPS_EVENT)
    return parsed.groupBy(F.coalesce("error", F.lit("good")).alias("outcome")).agg(F.count(F.lit(1)).alias("records"))


# --- derived columns ---------------------------------------------------------------------

def gps_columns(name: str, sql: str, **columns) -> None:
    """Register columns over every ping; they are made when the query runs."""
    @query(name, check(f"select event_id, {at('processed_at')}, {sql} from gps", "gps"))
    def run(spark, folder):
        return sample.gps(spark, folder).select("event_id", "processed_at", *[make().alias(a) for a, make in columns.items()])


def delivery_columns(name: str, sql: str, **columns) -> None:
    """Register columns over every delivery event; they are made when the query runs."""
    @query(name, check(f"select delivery_id, {at('event_timestamp')}, vehicle_id, driver_id, {sql} from deliveries", "deliveries"))
    def run(spark, folder):
        return sample.deliveries(spark, folder).select(
            "delivery_id", "event_timestamp", "vehicle_id", "driver_id", *[make().alias(a) for a, make in columns.items()])


T = "event_timestamp"
gps_columns("p2_date_key", n(f"strftime({T}, '%Y%m%d')", "date_key"), date_key=lambda: C.date_key(T))
gps_columns("p3_time_key", n(f"hour({T}) * 100 + minute({T})", "time_key"), time_key=lambda: C.time_key(T))
gps_columns("p4_event_date_hour", f"strftime({T}, '%Y-%m-%d') as event_date, hour({T}) as event_hour",
            event_date=lambda: C.event_date(T), event_hour=lambda: C.event_hour(T))
gps_columns("p5_day_number", f"dayofweek({T}) + 1 as day_of_week", day_of_week=lambda: C.day_number(T))
gps_columns("p6_day_name_weekend", f"dayname({T}) as day_name, isodow({T}) >= 6 as is_weekend",
            day_name=lambda: C.day_name(T), is_weekend=lambda: C.is_weekend(T))
delivery_columns("p7_business_hours", f"hour({T}) between 9 and 17 as is_business_hours",
                 is_business_hours=lambda: C.is_business_hours(T))

SPEED_SQL = """case when speed_mph = 0 then 'STOPPED' when speed_mph < 25 then 'SLOW' when speed_mph < 45 then 'NORMAL'
    when speed_mph < 65 then 'FAST' else 'VERY_FAST' end"""
FUEL_SQL = """case when fuel_level < 0.1e0 then 'CRITICAL' when fuel_level < 0.25e0 then 'LOW'
    when fuel_level < 0.5e0 then 'MEDIUM' else 'GOOD' end"""
DELAY_SQL = """case when delay_minutes <= 0 then 'ON_TIME' when delay_minutes <= 15 then 'SLIGHT_DELAY'
    when delay_minutes <= 30 then 'MODERATE_DELAY' when delay_minutes <= 60 then 'SIGNIFICANT_DELAY'
    else 'SEVERE_DELAY' end"""
SIZE_SQL = """case when package_weight_lbs < 1 then 'SMALL' when package_weight_lbs < 5 then 'MEDIUM'
    when package_weight_lbs < 20 then 'LARGE' else 'EXTRA_LARGE' end"""

gps_columns("p8_speed_category", f"{SPEED_SQL} as speed_category", speed_category=lambda: C.speed_category())
gps_columns("p9_fuel_status", f"{FUEL_SQL} as fuel_status", fuel_status=lambda: C.fuel_status())
delivery_columns(
    "p10_delay_category",
    f"""{DELAY_SQL} as delay_category,
        case when delay_minutes is null then 'ON_TIME' else {DELAY_SQL} end as delay_category_default,
        case when delay_minutes is null then 'UNKNOWN' else {DELAY_SQL} end as delay_category_unknown""",
    delay_category=lambda: C.delay_category(), delay_category_default=lambda: C.delay_category(null_policy="default"),
    delay_category_unknown=lambda: C.delay_category(null_policy="unknown"))
delivery_columns("p11_package_size", f"{SIZE_SQL} as package_size", package_size=lambda: C.package_size())
delivery_columns(
    "p12_status_flags",
    """event_type = 'DELIVERED' as is_delivered, event_type = 'FAILED_ATTEMPT' as is_failed,
        event_type = 'RETURNED' as is_returned""",
    is_delivered=lambda: C.has_status("DELIVERED"), is_failed=lambda: C.has_status("FAILED_ATTEMPT"), is_returned=lambda: C.has_status("RETURNED"))
gps_columns("p13_is_moving", "engine_status = 'ON' as is_moving", is_moving=lambda: C.is_moving())
delivery_columns("p14_is_on_time", "delay_minutes <= 0 as is_on_time", is_on_time=lambda: C.is_on_time())
gps_columns("p16_coord_prefix", "concat(substr(cast(latitude as varchar), 1, 5), substr(cast(longitude as varchar), 1, 6)) as coord_prefix",
            coord_prefix=lambda: C.coord_prefix())


def bisected(precision: int, source: str, keep: str) -> str:
    """Geohash by halving the ranges bit by bit, one nested subquery per bit pair."""
    inner = f"select {keep}, latitude, longitude, -90e0 as la, 90e0 as lb, -180e0 as oa, 180e0 as ob, '' as bits from {source}"
    total, level = 5 * precision, 0
    while 2 * level < total:
        both = 2 * level + 1 < total
        lat_bit = "|| case when latitude >= (la + lb) / 2 then '1' else '0' end" if both else ""
        inner = f"""select {keep}, latitude, longitude,
            case when latitude >= (la + lb) / 2 then (la + lb) / 2 else la end as la,
            case when latitude >= (la + lb) / 2 then lb else (la + lb) / 2 end as lb,
            case when longitude >= (oa + ob) / 2 then (oa + ob) / 2 else oa end as oa,
            case when longitude >= (oa + ob) / 2 then ob else (oa + ob) / 2 end as ob,
            bits || case when longitude >= (oa + ob) / 2 then '1' else '0' end {lat_bit} as bits from ({inner})"""
        level += 1
    chars = " || ".join(
        "substr('{}', 1 + {}, 1)".format(S.GEOHASH_ALPHABET, " + ".join(
            f"{16 >> i} * cast(substr(bits, {start + i + 1}, 1) as int)" for i in range(5)))
        for start in range(0, total, 5))
    return f"select {keep}, {chars} as geohash from ({inner})"


@query("p17_geohash", check(
    f"select event_id, {at('processed_at')}, geohash from ({bisected(6, 'gps', 'event_id, processed_at')})", "gps"))
def p17(spark, folder):
    return sample.gps(spark, folder).select("event_id", "processed_at", geo.geohash().alias("geohash"))


@query("p19_default_values", check(
    f"""select delivery_id, {at('event_timestamp')}, vehicle_id, driver_id, {n('coalesce(delay_minutes, 0)', 'delay_minutes')},
        {rd('coalesce(package_weight_lbs, 0)', 'package_weight_lbs')}, 'Unknown' as notes from deliveries""", "deliveries"))
def p19(spark, folder):
    rows = sample.deliveries(spark, folder).withColumn("notes", F.lit(None).cast("string"))
    return C.with_defaults(rows).select(
        "delivery_id", "event_timestamp", "vehicle_id", "driver_id", "delay_minutes", "package_weight_lbs", "notes")


# --- filters -----------------------------------------------------------------------------

@query("f1_gps_quality_gate", check(
    f"""select {PING} from gps where latitude between -90 and 90 and longitude between -180 and 180
        and speed_mph >= 0 and fuel_level between 0 and 1""", "gps"))
def f1(spark, folder):
    return sample.gps(spark, folder).where(C.gps_valid()).select(*PING_COLUMNS)


@query("f1_gps_rejects", check(
    """select event_id, concat_ws(',', case when not latitude between -90 and 90 then 'latitude' end,
            case when not longitude between -180 and 180 then 'longitude' end,
            case when not speed_mph >= 0 then 'speed' end,
            case when not fuel_level between 0 and 1 then 'fuel' end) as reject_reason
        from gps_latest where event_id not in (select event_id from gps_clean)""", "gps_clean"))
def f1_rejects(spark, folder):
    return quality.gps_rejects(sample.gps(spark, folder)).select("event_id", "reject_reason")


DELIVERY = f"delivery_id, {at('event_timestamp')}, vehicle_id, driver_id, event_type"
DELIVERY_COLUMNS = ["delivery_id", "event_timestamp", "vehicle_id", "driver_id", "event_type"]


@query("f2_terminal_status", check(
    f"select {DELIVERY} from deliveries where event_type in ('DELIVERED', 'FAILED_ATTEMPT', 'RETURNED')", "deliveries"))
def f2(spark, folder):
    return sample.deliveries(spark, folder).where(C.is_terminal()).select(*DELIVERY_COLUMNS)


@query("f3_delivered_only", check(f"select {DELIVERY} from deliveries where event_type = 'DELIVERED'", "deliveries"))
def f3(spark, folder):
    return sample.deliveries(spark, folder).where(C.has_status("DELIVERED")).select(*DELIVERY_COLUMNS)


@query("f4_half_open_range", check(
    f"""select {DELIVERY} from deliveries where event_timestamp >= timestamp '2024-01-05 00:00:00'
        and event_timestamp < timestamp '2024-01-09 12:00:00'""", "deliveries"))
def f4(spark, folder):
    rows = sample.deliveries(spark, folder)
    return rows.where(C.in_range("event_timestamp", datetime(2024, 1, 5), datetime(2024, 1, 9, 12))).select(*DELIVERY_COLUMNS)


@query("f5_partition_predicate", check(
    f"select {PING} from gps where strftime(event_timestamp, '%Y-%m-%d') >= '2024-01-20'", "gps"))
def f5(spark, folder):
    rows = files.scan(spark, landed_gps(spark, folder))
    return rows.where(F.col("event_date") >= F.lit("2024-01-20")).select(*PING_COLUMNS)


@query("f6_relative_dates", check(
    f"""select {DELIVERY} from deliveries
        where cast(event_timestamp as date) >= date '2024-01-28' - 7""", "deliveries"))
def f6(spark, folder):
    rows = sample.deliveries(spark, folder).where(C.since_days(F.to_date("event_timestamp"), "2024-01-28", 7))
    return rows.select(*DELIVERY_COLUMNS)


# --- deduplication -----------------------------------------------------------------------

@query("w1_keep_latest_gps", check(f"select {PING} from gps_latest", "gps_latest"))
def w1(spark, folder):
    return quality.latest_gps(sample.gps(spark, folder)).select(*PING_COLUMNS)


@query("w2_keep_latest_deliveries", check(f"select {DELIVERY}, {n('delay_minutes')} from del_latest", "del_latest"))
def w2(spark, folder):
    return quality.latest_deliveries(sample.deliveries(spark, folder)).select(*DELIVERY_COLUMNS, "delay_minutes")


ENRICHED_GPS = f"""event_id, {at('processed_at')}, strftime({T}, '%Y-%m-%d') as event_date, hour({T}) as event_hour,
    dayofweek({T}) + 1 as day_of_week, dayname({T}) as day_name, isodow({T}) >= 6 as is_weekend,
    {SPEED_SQL} as speed_category, {FUEL_SQL} as fuel_status, engine_status = 'ON' as is_moving"""


@query("x1_enrich_gps_batch", check(f"select {ENRICHED_GPS} from gps", "gps"))
def x1(spark, folder):
    return C.enrich_gps(sample.gps(spark, folder)).select(
        "event_id", "processed_at", "event_date", "event_hour", "day_of_week", "day_name", "is_weekend",
        "speed_category", "fuel_status", "is_moving")


@query("x2_enrich_deliveries_batch", check(
    f"""select {DELIVERY}, strftime({T}, '%Y-%m-%d') as event_date, hour({T}) as event_hour, dayname({T}) as day_name,
        isodow({T}) >= 6 as is_weekend, hour({T}) between 9 and 17 as is_business_hours,
        {DELAY_SQL} as delay_category, {SIZE_SQL} as package_size, event_type = 'DELIVERED' as is_delivered,
        event_type = 'FAILED_ATTEMPT' as is_failed, event_type = 'RETURNED' as is_returned from deliveries""", "deliveries"))
def x2(spark, folder):
    return C.enrich_deliveries(sample.deliveries(spark, folder)).select(
        *DELIVERY_COLUMNS, "event_date", "event_hour", "day_name", "is_weekend", "is_business_hours",
        "delay_category", "package_size", "is_delivered", "is_failed", "is_returned")
