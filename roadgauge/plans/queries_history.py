"""Registered queries: writes read back, merges, history tables, dimensions, incremental jobs."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadgauge.functions import columns as C, geo
from roadgauge.operators import dims, merge, quality, rollups, trips
from roadgauge.plans import daily, incremental
from roadgauge.plans.queries_records import DELIVERY, DELIVERY_COLUMNS, DELAY_SQL, ENRICHED_GPS, SIZE_SQL, bisected
from roadgauge.plans.queries_summaries import SUMMARY, dates, del_clean, gps_clean
from roadgauge.plans.registry import at, check, define, n, query, rd
from roadgauge.session import free_shuffles, scratch_dir, stage
from roadgauge.sinks import tables, versioned
from roadgauge.sources import files, sample

CUT = datetime(2024, 1, 15)


# --- writes ------------------------------------------------------------------------------

@query("k1_partitioned_write", check(f"select {ENRICHED_GPS} from gps_clean", "gps_clean"))
def k1(spark, folder):
    """Written twice: the second run replaces the same days and changes nothing."""
    path = scratch_dir(spark, "k1")
    for _ in range(2):
        tables.write_event_dates(C.enrich_gps(gps_clean(spark, folder)), path)
    return files.scan(spark, path).select(
        "event_id", "processed_at", F.col("event_date").cast("string").alias("event_date"), "event_hour",
        "day_of_week", "day_name", "is_weekend", "speed_category", "fuel_status", "is_moving")


@query("k6_day_rollup_write", check(
    f"""select vehicle_id, year(event_timestamp) as year, month(event_timestamp) as month, day(event_timestamp) as day,
        count(*) as gps_events, {rd('max(odometer_miles) - min(odometer_miles)', 'miles_driven')}
        from gps group by 1, 2, 3, 4""", "gps"))
def k6(spark, folder):
    path = scratch_dir(spark, "k6")
    tables.write_day_rollup(rollups.vehicle_day_rollup(sample.rollup_gps(spark, folder)), path)
    return files.scan(spark, path).select("vehicle_id", "year", "month", "day", "gps_events", "miles_driven")


# --- merge -------------------------------------------------------------------------------

def merge_sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Target: pings before the cut. Source: later ones, and every seventh earlier one faster by 1."""
    pings = sample.event_day(quality.latest_gps(sample.gps(spark, folder)))
    before = F.col("event_timestamp") < F.lit(CUT)
    changed = pings.where(before & (F.col("event_id") % 7 == 0)).withColumn("speed_mph", F.col("speed_mph") + 1)
    return pings.where(before), pings.where(~before).unionByName(changed)


PING = f"event_id, vehicle_id, {at('event_timestamp')}, {rd('speed_mph')}, event_date"
PING_COLUMNS = ["event_id", "vehicle_id", "event_timestamp", "speed_mph", "event_date"]
define("merge_target", "select * from gps_latest where event_timestamp < timestamp '2024-01-15 00:00:00'", "gps_latest")
define("merge_source", """
    select * from gps_latest where event_timestamp >= timestamp '2024-01-15 00:00:00'
    union all select * replace (speed_mph + 1 as speed_mph) from merge_target where event_id % 7 = 0""", "merge_target")
define("merge_result", """
    select * from merge_source
    union all select * from merge_target where event_id not in (select event_id from merge_source)""", "merge_source")


@query("c3_upsert_merge", check(f"select {PING}, event_id in (select event_id from merge_source) as was_touched from merge_result", "merge_result"))
def c3(spark, folder):
    target, source = merge_sides(spark, folder)
    merged = merge.upsert(target, source, ["event_id"], "event_timestamp")
    return merged.select(*PING_COLUMNS, F.col("loaded_at").isNotNull().alias("was_touched"))


@query("j2_updated_target_rows", check(
    f"select {PING} from merge_target where event_id in (select event_id from merge_source)", "merge_source"))
def j2(spark, folder):
    target, source = merge_sides(spark, folder)
    return merge.updated(target, source, ["event_id"]).select(*PING_COLUMNS)


@query("j3_unchanged_target_rows", check(
    f"select {PING} from merge_target where event_id not in (select event_id from merge_source)", "merge_source"))
def j3(spark, folder):
    target, source = merge_sides(spark, folder)
    return merge.unchanged(target, source, ["event_id"]).select(*PING_COLUMNS)


@query("j4_source_wins", check(
    f"""select t.event_id, {rd('coalesce(s.speed_mph, t.speed_mph)', 'speed_mph')}
        from merge_target t left join merge_source s using (event_id)""", "merge_source"))
def j4(spark, folder):
    target, source = merge_sides(spark, folder)
    merged = merge.upsert(target, merge.updated(source, target, ["event_id"]), ["event_id"], "event_timestamp")
    return merged.select("event_id", "speed_mph")


@query("j5_new_source_rows", check(
    f"select {PING} from merge_source where event_id not in (select event_id from merge_target)", "merge_source"))
def j5(spark, folder):
    target, source = merge_sides(spark, folder)
    return merge.inserted(target, source, ["event_id"]).select(*PING_COLUMNS)


@query("u1_union_by_name", check(
    """select event_id, vehicle_id, null as delivery_id from gps union all by name
        select vehicle_id, delivery_id, null::bigint as event_id from deliveries""", "gps", "deliveries"))
def u1(spark, folder):
    left = sample.gps(spark, folder).select("event_id", "vehicle_id")
    right = sample.deliveries(spark, folder).select("delivery_id", "vehicle_id")
    return left.unionByName(right, allowMissingColumns=True)


@query("k5_versioned_merge", check(
    f"""select {PING}, note from (
            select * replace (event_timestamp + gap as event_timestamp, strftime(event_timestamp + gap, '%Y-%m-%d') as event_date),
                case when event_id % 11 = 0 then 'moved' end as note
            from (select *, case when event_id % 11 = 0 then interval 3 day else interval 0 day end as gap from merge_result))""",
    "merge_result"))
def k5(spark, folder):
    """Three merges into a versioned table: the second rewrites only the days it touches, the third moves keys to other days and
    brings a column."""
    root = scratch_dir(spark, "k5")
    for side in merge_sides(spark, folder):
        versioned.merge_into(spark, root, side, ["event_id"])
    moved = versioned.read(spark, root).where("event_id % 11 = 0").drop("loaded_at").withColumns({
        "event_timestamp": F.col("event_timestamp") + F.expr("interval 3 days"), "note": F.lit("moved")})
    versioned.merge_into(spark, root, sample.event_day(moved.drop("event_date")), ["event_id"])
    return versioned.read(spark, root).select(*PING_COLUMNS, "note")


def landed(spark: SparkSession, df: DataFrame, label: str) -> str:
    path = scratch_dir(spark, label)
    arrive(sample.event_day(df), path)
    return path


def arrivals(spark: SparkSession, df: DataFrame, second, label: str) -> tuple[str, DataFrame]:
    """A landing folder with a first arrival, and the rows that arrive later, some of them for old days."""
    rows, later = sample.event_day(df), F.coalesce(second, F.lit(False))
    return landed(spark, rows.where(~later), label), rows.where(later)


def arrive(rows: DataFrame, path: str) -> None:
    """Each task that derives rows lands a file per date."""
    with free_shuffles(rows.sparkSession):
        tables.write_partitions(rows, path, ["event_date"], dealt=True, mode="append")


@query("c7_incremental_gps", check(f"select {PING} from gps_latest", "gps_latest"))
def c7_gps(spark, folder):
    """Raw pings with their copies. Later copies, and rows of every day, arrive after the first run; a third run has nothing new."""
    late = (F.col("event_id") % 7 == 0) | (F.col("processed_at") > F.col("event_timestamp") + F.expr("interval 60 seconds"))
    source, rest = arrivals(spark, sample.gps(spark, folder), late, "c7-gps")
    target = scratch_dir(spark, "c7-gps-out")
    incremental.run_feed(spark, incremental.GPS, source, target, datetime(2024, 1, 20))
    arrive(rest, source)
    for now in (datetime(2024, 2, 10), datetime(2024, 2, 11)):
        incremental.run_feed(spark, incremental.GPS, source, target, now)
    return versioned.read(spark, target).select(*PING_COLUMNS)


define("del_last_copy", """
    select *, cast(strftime(event_timestamp, '%Y-%m-%d') as varchar) as event_date from deliveries
    qualify row_number() over (partition by delivery_id, event_type order by event_timestamp desc, order_id desc,
        vehicle_id desc, driver_id desc, customer_id desc, delay_minutes desc nulls last, package_weight_lbs desc,
        declared_value desc, distance_miles desc, tip_amount desc) = 1""", "deliveries")


@query("c7_incremental_deliveries", check(
    f"select {DELIVERY}, event_date, delay_minutes <= 0 as is_on_time from del_last_copy", "del_last_copy"))
def c7_deliveries(spark, folder):
    """Raw delivery events; a third of the deliveries, of all days, arrive after the first run."""
    source, rest = arrivals(spark, sample.deliveries(spark, folder), F.crc32(F.col("delivery_id").cast("binary")) % 3 == 0, "c7-del")
    target = scratch_dir(spark, "c7-del-out")
    incremental.run_feed(spark, incremental.DELIVERIES, source, target, datetime(2024, 1, 10, 12))
    arrive(rest, source)
    incremental.run_feed(spark, incremental.DELIVERIES, source, target, datetime(2024, 2, 10))
    return versioned.read(spark, target).select(*DELIVERY_COLUMNS, "event_date", "is_on_time")


@query("c7_incremental_stale_copies", check(f"select {PING} from gps_latest", "gps_latest"))
def c7_stale(spark, folder):
    """The earlier copies arrive last, after the ones processed later are stored; then all are read again in the overlap."""
    stale = (F.col("event_id") % 10 == 0) & (F.col("processed_at") < F.col("event_timestamp") + F.expr("interval 60 seconds"))
    source, rest = arrivals(spark, sample.gps(spark, folder), stale, "c7-stale")
    target = scratch_dir(spark, "c7-stale-out")
    incremental.run_feed(spark, incremental.GPS, source, target, datetime(2024, 2, 10))
    arrive(rest, source)
    for now in (datetime(2024, 2, 11), datetime(2024, 2, 12)):
        incremental.run_feed(spark, incremental.GPS, source, target, now)
    return versioned.read(spark, target).select(*PING_COLUMNS)


@query("c7_moved_deliveries", check(
    f"""select {DELIVERY}, strftime(event_timestamp, '%Y-%m-%d') as event_date, delay_minutes <= 0 as is_on_time
        from (select * replace (case when cast(substr(order_id, 5) as bigint) % 5 = 0 then event_timestamp + interval 3 day
            else event_timestamp end as event_timestamp) from del_last_copy)""", "del_last_copy"))
def c7_moved(spark, folder):
    """A second arrival moves the events of every fifth order to a later day, and brings stale events of others for earlier days.

    The index of key to date finds the stored rows of both."""
    rows = sample.deliveries(spark, folder)
    source, _ = arrivals(spark, rows, F.lit(False), "c7-moved")
    target = scratch_dir(spark, "c7-moved-out")
    incremental.run_feed(spark, incremental.DELIVERIES, source, target, datetime(2024, 2, 10))
    order = F.substring("order_id", 5, 20).cast("long") % 5
    days = F.when(order == 0, 3).otherwise(-3)
    moved = rows.where(order < 2).withColumn("event_timestamp", F.col("event_timestamp") + F.make_dt_interval(days=days))
    arrive(sample.event_day(moved), source)
    incremental.run_feed(spark, incremental.DELIVERIES, source, target, datetime(2024, 2, 11))
    return versioned.read(spark, target).select(*DELIVERY_COLUMNS, "event_date", "is_on_time")


# --- history -----------------------------------------------------------------------------

TRACKED = ["driver_name", "home_depot"]


def driver_feed(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Drivers as first seen, and two weeks later: every fifth moved depot, three new ones."""
    first = sample.drivers(spark, folder)
    moved = F.substring("driver_id", 2, 9).cast("int") % 5 == 0
    second = first.withColumn("home_depot", F.when(moved, (F.col("home_depot") + 1) % 25).otherwise(F.col("home_depot")))
    added = first.where(F.col("driver_id").isin("D0000", "D0001", "D0002")).withColumn(
        "driver_id", F.concat(F.lit("N"), F.col("driver_id")))
    return (
        first.withColumn("updated_at", F.lit("2023-12-01 00:00:00").cast("timestamp")),
        second.unionByName(added).withColumn("updated_at", F.lit("2024-01-14 12:00:00").cast("timestamp")),
    )


def driver_history(spark: SparkSession, folder: str) -> DataFrame:
    first, second = driver_feed(spark, folder)
    history = stage(merge.scd2(None, first, ["driver_id"], "updated_at", TRACKED), "drivers")
    return merge.scd2(history, second, ["driver_id"], "updated_at", TRACKED)


define("driver_v2", """
    select driver_id, driver_name, case when cast(substr(driver_id, 2) as int) % 5 = 0 then (home_depot + 1) % 25
        else home_depot end as home_depot from drivers
    union all select concat('N', driver_id), driver_name, home_depot from drivers where driver_id in ('D0000', 'D0001', 'D0002')""",
    "drivers")
define("driver_history", """
    select d.driver_id, d.driver_name, d.home_depot, timestamp '2023-12-01 00:00:00' as effective_start,
        case when v.home_depot <> d.home_depot then timestamp '2024-01-14 12:00:00' end as effective_end
    from drivers d join driver_v2 v using (driver_id)
    union all
    select v.driver_id, v.driver_name, v.home_depot, timestamp '2024-01-14 12:00:00', null
    from driver_v2 v left join drivers d using (driver_id) where d.driver_id is null or d.home_depot <> v.home_depot""",
    "drivers", "driver_v2")
HISTORY = f"driver_id, driver_name, {n('home_depot')}, {at('effective_start')}, {at('effective_end')}, effective_end is null as is_current"


@query("p18_first_load_typed_nulls", check(
    f"""select driver_id, driver_name, {n('home_depot')}, '2023-12-01 00:00:00.000000' as effective_start,
        cast(null as varchar) as effective_end, true as is_current from drivers""", "drivers"))
def p18(spark, folder):
    return merge.scd2(None, driver_feed(spark, folder)[0], ["driver_id"], "updated_at", TRACKED)


@query("c4_history_table", check(f"select {HISTORY} from driver_history", "driver_history"))
def c4(spark, folder):
    return driver_history(spark, folder)


@query("c4_history_table_repeated", check(f"select {HISTORY} from driver_history", "driver_history"))
def c4_repeated(spark, folder):
    """The same batch once more adds nothing."""
    second = driver_feed(spark, folder)[1]
    history = stage(driver_history(spark, folder), "drivers")
    return merge.scd2(history, second, ["driver_id"], "updated_at", TRACKED)


@query("f7_current_versions", check(f"select {HISTORY} from driver_history where effective_end is null", "driver_history"))
def f7(spark, folder):
    return merge.current_versions(driver_history(spark, folder))


@query("c5_changed_rows", check(
    f"""select v.driver_id, v.driver_name, {n('v.home_depot', 'home_depot')},
        case when d.driver_id is null then 'insert' else 'update' end as change
        from driver_v2 v left join drivers d using (driver_id)
        where d.driver_id is null or d.home_depot <> v.home_depot or d.driver_name <> v.driver_name""", "driver_v2"))
def c5(spark, folder):
    first, second = driver_feed(spark, folder)
    return merge.changed(first, second.drop("updated_at"), ["driver_id"], TRACKED)


@query("j10_surrogate_key_lookup", check(
    f"""select {DELIVERY}, {n('h.home_depot', 'home_depot')} from deliveries left join
        (select driver_id as k, home_depot, effective_start, effective_end from driver_history) h
        on driver_id = h.k and event_timestamp >= h.effective_start
            and (h.effective_end is null or event_timestamp < h.effective_end)""", "deliveries", "driver_history"))
def j10(spark, folder):
    """The key is looked up by time, then resolved to the version's depot."""
    dim = dims.versioned_dim(stage(driver_history(spark, folder), "drivers"), "driver_id", "driver_key")
    keyed = dims.lookup_key(sample.deliveries(spark, folder), dim, "driver_id", "driver_key")
    return keyed.join(dim.select("driver_key", "home_depot"), "driver_key", "left").select(*DELIVERY_COLUMNS, "home_depot")


# --- dimensions --------------------------------------------------------------------------

@query("d1_dim_date", check(
    """select cast(strftime(d, '%Y%m%d') as bigint) as date_key, strftime(d, '%Y-%m-%d') as full_date,
        dayofweek(d) + 1 as day_of_week, dayname(d) as day_name, day(d) as day_of_month, dayofyear(d) as day_of_year,
        weekofyear(d) as week_of_year, month(d) as month_num, monthname(d) as month_name, quarter(d) as quarter,
        year(d) as year, isodow(d) >= 6 as is_weekend, d in (select distinct date_trunc('month', full_date) from dates) as is_holiday
        from (select full_date::timestamp as d from dates)""", "dates"))
def d1(spark, folder):
    """Calendar of the feeds' time span, with the first of each month as a sample holiday."""
    days = dates(spark, folder)
    first_days = days.select(F.trunc("full_date", "month").alias("full_date"))
    return dims.date_columns(days.select("full_date"), first_days)


@query("d2_dim_time", check(
    """select m.time_key, hour, minute, hour_12, am_pm, time_of_day, is_business_hours, count(event_id) as pings from (
            select h * 100 + m as time_key, h as hour, m as minute, case when h % 12 = 0 then 12 else h % 12 end as hour_12,
                case when h < 12 then 'AM' else 'PM' end as am_pm,
                case when h >= 5 and h < 12 then 'Morning' when h >= 12 and h < 17 then 'Afternoon'
                    when h >= 17 and h < 21 then 'Evening' else 'Night' end as time_of_day,
                h between 9 and 17 as is_business_hours
            from (select unnest(range(24)) as h) a, (select unnest(range(60)) as m) b) m
        left join gps on hour(event_timestamp) * 100 + minute(event_timestamp) = m.time_key
        group by all""", "gps"))
def d2(spark, folder):
    """Every minute of the day with the pings that fall into it."""
    pings = sample.gps(spark, folder).groupBy(C.time_key("event_timestamp").alias("time_key")).agg(
        F.count(F.lit(1)).alias("pings"))
    return dims.dim_time(spark).join(pings, "time_key", "left").fillna(0, ["pings"])


@query("d3_dim_driver", check(f"select {HISTORY}, true as key_is_unique from driver_history", "driver_history"))
def d3(spark, folder):
    dim = dims.versioned_dim(stage(driver_history(spark, folder), "drivers"), "driver_id", "driver_key")
    copies = dim.groupBy("driver_key").agg(F.count(F.lit(1)).alias("n"))
    return dim.join(copies, "driver_key").withColumn("key_is_unique", F.col("n") == 1).drop("n", "driver_key")


define("vehicle_v2", """
    select vehicle_id, case when cast(substr(vehicle_id, 2) as int) % 4 = 0 then 'ELECTRIC' else vehicle_type end as vehicle_type
    from vehicles where cast(substr(vehicle_id, 2) as int) % 2 = 0""", "vehicles")
define("vehicle_history", """
    select o.vehicle_id, o.vehicle_type, timestamp '2023-12-01 00:00:00' as effective_start,
        case when v.vehicle_type <> o.vehicle_type then timestamp '2024-01-14 12:00:00' end as effective_end
    from vehicles o left join vehicle_v2 v using (vehicle_id)
    union all
    select vehicle_id, v.vehicle_type, timestamp '2024-01-14 12:00:00', null
    from vehicle_v2 v join vehicles o using (vehicle_id) where v.vehicle_type <> o.vehicle_type""", "vehicles", "vehicle_v2")


@query("d3_dim_vehicle", check(
    f"""select vehicle_id, vehicle_type, {at('effective_start')}, {at('effective_end')}, effective_end is null as is_current,
        count(*) over (partition by vehicle_id) as versions from vehicle_history""", "vehicle_history"))
def d3_vehicle(spark, folder):
    """Half of the vehicles are reported again, every second of these with another type; the others keep their version."""
    number = F.substring("vehicle_id", 2, 9).cast("int")
    first = stage(sample.vehicles(spark, folder), "vehicles")
    second = first.where(number % 2 == 0).withColumn(
        "vehicle_type", F.when(number % 4 == 0, "ELECTRIC").otherwise(F.col("vehicle_type")))
    history = stage(merge.scd2(None, first.withColumn("updated_at", F.lit("2023-12-01").cast("timestamp")), ["vehicle_id"], "updated_at"), "vehicles-1")
    both = merge.scd2(history, second.withColumn("updated_at", F.lit("2024-01-14 12:00:00").cast("timestamp")), ["vehicle_id"], "updated_at")
    dim = dims.versioned_dim(both, "vehicle_id", "vehicle_key")
    per_vehicle = dim.groupBy("vehicle_id").agg(F.countDistinct("vehicle_key").alias("versions"))
    return dim.join(per_vehicle, "vehicle_id").drop("vehicle_key")


@query("d4_dim_customer", check(
    f"""select concat('CUST-', lpad(cast(c_custkey as varchar), 5, '0')) as customer_id, c_name as customer_name,
        case when c_nationkey = 3 then 'BUSINESS' else c_mktsegment end as customer_type, {n('c_nationkey', 'region_code')}
        from customer"""))
def d4(spark, folder):
    """Merged over an older load; the newer row wins."""
    base = sample.customers(spark, folder)
    stamped = base.withColumn("updated_at", F.lit("2024-01-01").cast("timestamp"))
    newer = base.where("region_code = 3").withColumn("customer_type", F.lit("BUSINESS")).withColumn(
        "updated_at", F.lit("2024-01-02").cast("timestamp"))
    return merge.upsert(stamped, newer, ["customer_id"], "updated_at").drop("updated_at", "loaded_at")


@query("d5_dim_location", check(
    f"""select geohash, count(*) as pings, max(abs(latitude - centre_latitude)) <= 180 / pow(2, 13) as latitude_is_near,
        max(abs(longitude - centre_longitude)) <= 360 / pow(2, 14) as longitude_is_near
        from (select *, latitude as centre_latitude, longitude as centre_longitude from ({bisected(5, 'gps_clean', 'event_id')})
            join (select event_id, latitude, longitude from gps_clean) using (event_id)) group by geohash""", "gps_clean"))
def d5(spark, folder):
    """Cells with their pings, and whether no ping is further from the centre than half a cell."""
    pings = gps_clean(spark, folder)
    located = pings.select("latitude", "longitude", geo.geohash(precision=5).alias("geohash"))
    centres = dims.dim_location(pings).withColumnsRenamed({"latitude": "centre_latitude", "longitude": "centre_longitude"})
    return located.join(centres, "geohash").groupBy("geohash").agg(
        F.count(F.lit(1)).alias("pings"),
        (F.max(F.abs(F.col("latitude") - F.col("centre_latitude"))) <= 180 / 2 ** 13).alias("latitude_is_near"),
        (F.max(F.abs(F.col("longitude") - F.col("centre_longitude"))) <= 360 / 2 ** 14).alias("longitude_is_near"),
    )


# --- the daily job -----------------------------------------------------------------------

# a day's job deduplicates what lies in its own partition
define("day_deliveries", """
    select *, 20240115::bigint as date_key, delay_minutes <= 0 as is_on_time from deliveries
    where cast(event_timestamp as date) = date '2024-01-15' and event_type in ('DELIVERED', 'FAILED_ATTEMPT', 'RETURNED')
    qualify row_number() over (partition by delivery_id, event_type
        order by event_timestamp desc, vehicle_id, driver_id, package_weight_lbs, order_id, customer_id,
            delay_minutes nulls first, declared_value, distance_miles, tip_amount) = 1""", "deliveries")


@query("c12_daily_job", check(
    f"""select {SUMMARY} from (select * from daily_gps where date_key = 20240115)
        full join (select date_key, count(*) as total_deliveries,
                count(*) filter (event_type = 'DELIVERED') as successful_deliveries,
                count(*) filter (is_on_time) as on_time_deliveries, avg(delay_minutes) as avg_delay_minutes,
                count(distinct driver_id) as active_drivers, count(distinct vehicle_id) as delivery_vehicles,
                '2024-01-15' as summary_date,
                round(count(*) filter (is_on_time) / count(*)::double * 100, 2) as on_time_delivery_pct,
                round(count(*) filter (event_type = 'DELIVERED') / count(*)::double * 100, 2) as delivery_success_rate
            from day_deliveries group by date_key) using (date_key)""", "daily_gps", "day_deliveries"))
def c12(spark, folder):
    """Land both feeds, run one day's job, read its stored summary."""
    lake = daily.Lake(scratch_dir(spark, "lake"))
    tables.write_event_dates(sample.event_day(sample.gps(spark, folder)), lake.path("raw", "gps"))
    tables.write_event_dates(sample.event_day(sample.deliveries(spark, folder)), lake.path("raw", "deliveries"))
    return daily.run_daily(spark, lake, "2024-01-15", exact=True)["daily_summary"].drop("created_at")


define("del_of_day", """
    select *, delay_minutes <= 0 as is_on_time, event_type = 'DELIVERED' as is_successful, 20240115 as date_key from (
        select * from deliveries where strftime(event_timestamp, '%Y%m%d') = '20240115'
        qualify row_number() over (partition by delivery_id, event_type
            order by event_timestamp desc, vehicle_id, driver_id, package_weight_lbs, order_id, customer_id,
                delay_minutes nulls first, declared_value, distance_miles, tip_amount) = 1)
    where event_type in ('DELIVERED', 'FAILED_ATTEMPT', 'RETURNED')""", "deliveries")


@query("c12_daily_job_deliveries", check(
    f"""select {DELIVERY}, {DELAY_SQL} as delay_category, {SIZE_SQL} as package_size, is_on_time, is_successful,
        {n('date_key')}, {n('hour(event_timestamp) * 100 + minute(event_timestamp)', 'time_key')}
        from del_of_day""", "del_of_day"))
def c12_deliveries(spark, folder):
    """The day's job over raw landings: it sees the copies of its own day."""
    lake = daily.Lake(scratch_dir(spark, "lake"))
    tables.write_event_dates(sample.event_day(sample.gps(spark, folder)), lake.path("raw", "gps"))
    tables.write_event_dates(sample.event_day(sample.deliveries(spark, folder)), lake.path("raw", "deliveries"))
    return daily.run_daily(spark, lake, "2024-01-15")["deliveries"].select(
        *DELIVERY_COLUMNS, "delay_category", "package_size", "is_on_time", "is_successful", "date_key", "time_key")


@query("w5_attempts_on_facts", check(
    f"""select delivery_id, event_type, attempt_number, count(*) as events from (
            select delivery_id, event_type, row_number() over (partition by delivery_id
                order by event_timestamp, event_type, vehicle_id, driver_id) as attempt_number
            from deliveries where event_type in ('DELIVERED', 'FAILED_ATTEMPT', 'RETURNED')) group by 1, 2, 3""", "deliveries"))
def w5_facts(spark, folder):
    tasks = sample.delivery_tasks(spark, folder)
    return trips.attempt_numbers(sample.deliveries(spark, folder, tasks), tasks=tasks).groupBy(
        "delivery_id", "event_type", "attempt_number").agg(F.count(F.lit(1)).alias("events"))
