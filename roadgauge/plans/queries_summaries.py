"""Registered queries: aggregates, joins, reports and ordered windows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from roadgauge.functions import columns as C
from roadgauge.operators import dims, places, quality, reports, rollups, timeline, trips, vehicle_sets
from roadgauge.plans.queries_records import landed_rollup_gps
from roadgauge.plans.registry import at, check, close_count, define, n, query, rd
from roadgauge.schemas import RATES
from roadgauge.session import stage
from roadgauge.sources import files, sample

AS_OF = "2024-01-28"


def half(expr: str, name: str) -> str:
    """SQL for two decimals, halves rounded up."""
    return f"cast(round(cast(round({expr}, 9) as decimal(38, 9)), 2) as double) as {name}"


def gps_clean(spark, folder):
    return quality.clean_gps(sample.gps(spark, folder))


def gps_facts(spark, folder):
    """Cleaned pings as a written table, for operators that read them several times."""
    return stage(gps_clean(spark, folder), "gps-facts")


def del_clean(spark, folder):
    return quality.clean_deliveries(sample.deliveries(spark, folder))


def del_latest(spark, folder):
    return quality.latest_deliveries(sample.deliveries(spark, folder)).withColumn(
        "date_key", C.date_key("event_timestamp"))


def dates(spark, folder):
    """Calendar covering both feeds."""
    both = sample.gps(spark, folder).select("event_timestamp").union(
        sample.deliveries(spark, folder).select("event_timestamp"))
    return dims.dim_date_of(both)


def calendar(spark):
    """The stored date dimension: a fixed span, so no fact is read for it."""
    return dims.dim_date(spark, "2023-01-01", "2025-12-31")


define("span", """
    select min(cast(event_timestamp as date)) as first, max(cast(event_timestamp as date)) as last
    from (select event_timestamp from gps union all select event_timestamp from deliveries)""", "gps", "deliveries")
define("dates", """
    select cast(d as date) as full_date, cast(strftime(d, '%Y%m%d') as bigint) as date_key, dayname(d) as day_name
    from (select unnest(generate_series(first::timestamp, last::timestamp, interval 1 day)) as d from span)""", "span")


# --- daily and vehicle-day aggregates ----------------------------------------------------

@query("a1_vehicle_day_trips", check(
    f"""select vehicle_id, date_key, count(*) as gps_events, {at('min(event_timestamp)', 'start_time')},
        {at('max(event_timestamp)', 'end_time')}, {rd('avg(speed_mph)', 'avg_speed_mph')},
        {rd('max(speed_mph)', 'max_speed_mph')}, {rd('min(fuel_level)', 'min_fuel_level')},
        {rd('max(fuel_level)', 'max_fuel_level')}, count(*) filter (engine_status = 'IDLE') as idle_events,
        count(*) filter (engine_status = 'ON') as moving_events,
        {rd("date_diff('second', date_trunc('second', min(event_timestamp)), date_trunc('second', max(event_timestamp))) / 60.0e0",
            'duration_minutes')},
        {rd('max(fuel_level) - min(fuel_level)', 'fuel_consumed')},
        {rd("count(*) filter (engine_status = 'IDLE') * 100.0e0 / count(*)", 'idle_time_pct')}
        from gps_clean group by vehicle_id, date_key""", "gps_clean"))
def a1(spark, folder):
    return rollups.vehicle_days(gps_clean(spark, folder))


@query("a2_daily_gps_summary", check(
    f"""select date_key, total_gps_events, active_vehicles, {rd('avg_speed')}, {rd('avg_fuel_level')},
        true as approx_within_bound from daily_gps""", "daily_gps"))
def a2(spark, folder):
    return within_bound(rollups.daily_gps, gps_clean(spark, folder), ["active_vehicles"])


@query("a3_daily_delivery_summary", check(
    f"""select date_key, total_deliveries, successful_deliveries, on_time_deliveries, {rd('avg_delay_minutes')},
        active_drivers, delivery_vehicles, true as approx_within_bound from daily_del""", "daily_del"))
def a3(spark, folder):
    return within_bound(rollups.daily_deliveries, del_clean(spark, folder), ["active_drivers", "delivery_vehicles"])


def within_bound(summary, rows, counts: list[str], key: str = "date_key"):
    """Exact summary, and whether each approximate count is as near as its sketch allows."""
    near = summary(rows).select(key, *[F.col(c).alias(f"_{c}") for c in counts])
    exact = summary(rows, exact=True)
    tests = [close_count(f"_{c}", c) for c in counts]
    flag = tests[0]
    for test in tests[1:]:
        flag = flag & test
    return exact.join(near, key).withColumn("approx_within_bound", flag).drop(*[f"_{c}" for c in counts])


SUMMARY = f"""date_key, total_gps_events, active_vehicles, {rd('avg_speed')}, {rd('avg_fuel_level')}, total_deliveries,
    successful_deliveries, on_time_deliveries, {rd('avg_delay_minutes')}, active_drivers, delivery_vehicles,
    summary_date, on_time_delivery_pct, delivery_success_rate"""


def summary(spark, folder):
    return rollups.daily_summary(gps_clean(spark, folder), del_clean(spark, folder), exact=True)


@query("a4_daily_fleet_summary", check(f"select {SUMMARY} from summary", "summary"))
def a4(spark, folder):
    return summary(spark, folder)


@query("j1_full_outer_by_day", check(
    """select date_key, g, d from (select date_key, count(*) as g from gps_clean group by 1)
        full join (select date_key, count(*) as d from del_clean group by 1) using (date_key)""", "gps_clean", "del_clean"))
def j1(spark, folder):
    left = gps_clean(spark, folder).groupBy("date_key").agg(F.count(F.lit(1)).alias("g"))
    right = del_clean(spark, folder).groupBy("date_key").agg(F.count(F.lit(1)).alias("d"))
    return left.join(right, "date_key", "full")


DAY = "year(event_timestamp) as year, month(event_timestamp) as month, day(event_timestamp) as day"
BY_DAY = "year(event_timestamp), month(event_timestamp), day(event_timestamp)"


@query("a5_vehicle_day_rollup", check(
    f"""select vehicle_id, {DAY}, count(*) as gps_events, {rd('avg(speed_mph)', 'avg_speed')},
        {rd('max(speed_mph)', 'max_speed')}, {rd('avg(fuel_level)', 'avg_fuel_level')},
        {rd('max(odometer_miles)', 'max_odometer')}, {rd('min(odometer_miles)', 'min_odometer')},
        {rd('max(odometer_miles) - min(odometer_miles)', 'miles_driven')} from gps group by vehicle_id, {BY_DAY}""", "gps"))
def a5(spark, folder):
    return rollups.vehicle_day_rollup(sample.rollup_gps(spark, folder))


@query("a6_delivery_day_rollup", check(
    f"""select vehicle_id, {DAY}, event_type as status, count(*) as deliveries,
        {rd('avg(distance_miles)', 'avg_distance')}, {rd('avg(delay_minutes + 60)', 'avg_delivery_time')},
        {rd('sum(tip_amount)', 'total_tips')} from deliveries group by vehicle_id, {BY_DAY}, event_type""", "deliveries"))
def a6(spark, folder):
    return rollups.delivery_day_rollup(sample.rollup_deliveries(spark, folder))


@query("a7_count_all", check("select count(*) as total_records from gps", "gps"))
def a7(spark, folder):
    return rollups.count_all(sample.gps(spark, folder))


@query("a8_count_by_day", check(f"select {DAY}, count(*) as records from gps group by {BY_DAY}", "gps"))
def a8(spark, folder):
    return rollups.count_by_day(sample.rollup_gps(spark, folder))


@query("a9_one_day_speed", check(
    f"""select count(*) as records, {rd('avg(speed_mph)', 'avg_speed')} from gps
        where cast(event_timestamp as date) = date '2024-01-15'""", "gps"))
def a9(spark, folder):
    return rollups.one_day_speed(files.scan(spark, landed_rollup_gps(spark, folder)), 2024, 1, 15)


@query("a10_status_summary", check(
    f"""select event_type as status, count(*) as count, {rd('avg(distance_miles)', 'avg_distance')}
        from deliveries group by event_type""", "deliveries"))
def a10(spark, folder):
    return rollups.status_summary(sample.rollup_deliveries(spark, folder))


@query("a11_vehicle_activity", check(
    f"select vehicle_id, count(*) as gps_events, {rd('avg(speed_mph)', 'avg_speed')} from gps group by vehicle_id", "gps"))
def a11(spark, folder):
    return rollups.vehicle_activity(sample.gps(spark, folder))


@query("t3_top_vehicles", check(
    f"""select vehicle_id, count(*) as gps_events, {rd('avg(speed_mph)', 'avg_speed')} from gps
        group by vehicle_id order by gps_events desc, vehicle_id limit 10""", "gps"))
def t3(spark, folder):
    return rollups.top_vehicles(sample.gps(spark, folder))


A12_SQL = f"""select event_date, count(*) as total_deliveries, count(*) filter (is_on_time) as on_time,
    {half('avg(delay_minutes)', 'avg_delay')},
    {half('100.0e0 * count(*) filter (is_on_time) / count(*)', 'on_time_pct')}
    from del_clean where event_date >= '2024-01-01' group by event_date"""


@query("a12_daily_delivery_performance", check(A12_SQL, "del_clean"))
def a12(spark, folder):
    return rollups.daily_delivery_performance(sample.event_day(del_clean(spark, folder)), "2024-01-01")


@query("t1_order_by_date", check(A12_SQL.replace(" where event_date >= '2024-01-01'", ""), "del_clean"))
def t1(spark, folder):
    return rollups.daily_delivery_performance(sample.event_day(del_clean(spark, folder))).orderBy("event_date")


@query("a13_hourly_utilization", check(
    f"""select {at("date_trunc('hour', event_timestamp)", 'hour')}, count(distinct vehicle_id) as active_vehicles,
        {half('avg(speed_mph)', 'avg_speed')}, count(*) filter (engine_status = 'ON') as moving_count
        from gps_clean group by date_trunc('hour', event_timestamp)""", "gps_clean"))
def a13(spark, folder):
    return rollups.hourly_utilization(gps_clean(spark, folder).withColumn("is_moving", C.is_moving()))


# --- reports -----------------------------------------------------------------------------

@query("a14_delivery_performance", check(
    f"""select strftime(full_date, '%Y-%m-%d') as full_date, day_name, count(*) as total_deliveries,
        count(*) filter (is_successful) as successful_deliveries, count(*) filter (is_on_time) as on_time_deliveries,
        {rd('avg(delay_minutes)', 'avg_delay_minutes')},
        {half('count(*) filter (is_on_time) * 100.0e0 / count(*)', 'on_time_pct')},
        {half('count(*) filter (is_successful) * 100.0e0 / count(*)', 'success_rate')}
        from del_clean join dates using (date_key) where full_date >= date '{AS_OF}' - 30
        group by full_date, day_name""", "del_clean", "dates"))
def a14(spark, folder):
    rows = reports.recent(sample.deliveries(spark, folder), AS_OF, 30)
    return reports.delivery_performance(quality.clean_deliveries(rows), calendar(spark), AS_OF)


LEADERS = f"""select driver_id, driver_name, count(*) as total_deliveries,
    count(*) filter (is_on_time) as on_time_deliveries, {half('avg(delay_minutes)', 'avg_delay')},
    {half('count(*) filter (is_on_time) * 100.0e0 / count(*)', 'on_time_pct')}
    from drivers join del_clean using (driver_id) join dates using (date_key)
    where full_date >= date '{AS_OF}' - 7 group by driver_id, driver_name"""


def leaderboard(spark, folder):
    return reports.driver_leaderboard(
        quality.clean_deliveries(reports.recent(sample.deliveries(spark, folder), AS_OF, 7)),
        sample.drivers(spark, folder), calendar(spark), AS_OF)


@query("a15_driver_leaderboard", check(LEADERS, "drivers", "del_clean", "dates"))
def a15(spark, folder):
    return leaderboard(spark, folder)


@query("t2_top_drivers", check(
    f"{LEADERS} order by on_time_pct desc nulls last, total_deliveries desc, driver_id limit 5",
    "drivers", "del_clean", "dates"))
def t2(spark, folder):
    return reports.top_drivers(leaderboard(spark, folder))


define("positions", """
    select * from gps_clean where date_key = (select max(date_key) from dates where full_date <= date '2024-01-28')
    qualify row_number() over (partition by vehicle_id order by event_timestamp desc, processed_at desc, event_id desc) = 1""",
    "gps_clean", "dates")
define("current_driver", """
    select vehicle_id, driver_name from (
        select vehicle_id, driver_id from deliveries
        qualify row_number() over (partition by vehicle_id order by event_timestamp desc, driver_id desc) = 1)
    left join drivers using (driver_id)""", "deliveries", "drivers")


def clean_day(spark, folder):
    """The pings of the report's day, bounded before the dedup: copies of a ping share its time."""
    return quality.clean_gps(reports.recent(sample.gps(spark, folder), AS_OF, 0))


@query("a16_current_fleet_status", check(
    f"""select vehicle_id, vehicle_type, driver_name, {rd('latitude')}, {rd('longitude')}, {rd('speed_mph')},
        engine_status, {rd('fuel_level')}, {at('event_timestamp', 'last_update')}
        from vehicles left join positions using (vehicle_id) left join current_driver using (vehicle_id)""",
    "vehicles", "positions", "current_driver"))
def a16(spark, folder):
    return reports.fleet_status(
        sample.vehicles(spark, folder), clean_day(spark, folder), sample.deliveries(spark, folder),
        sample.drivers(spark, folder), calendar(spark), AS_OF)


@query("j7_left_join_latest_row", check(
    f"select vehicle_id, vehicle_type, {at('event_timestamp', 'last_update')} from vehicles left join positions using (vehicle_id)",
    "vehicles", "positions"))
def j7(spark, folder):
    today = clean_day(spark, folder).where(F.col("date_key") == reports.latest_day(calendar(spark), AS_OF).scalar())
    latest = reports.latest_positions(today).select("vehicle_id", F.col("event_timestamp").alias("last_update"))
    return sample.vehicles(spark, folder).join(latest, "vehicle_id", "left")


@query("j8_scalar_subquery_day", check(
    f"""select event_id, {rd('speed_mph')} from gps_clean
        where date_key = (select max(date_key) from dates where full_date <= date '{AS_OF}')""", "gps_clean", "dates"))
def j8(spark, folder):
    day = reports.latest_day(calendar(spark), AS_OF).scalar()
    return clean_day(spark, folder).where(F.col("date_key") == day).select("event_id", "speed_mph")


@query("j6_star_join", check(
    f"""select day_name, customer_type, count(*) as deliveries, {rd('sum(declared_value)', 'declared_value')}
        from del_clean join dates using (date_key)
        join (select concat('CUST-', lpad(cast(c_custkey as varchar), 5, '0')) as customer_id, c_mktsegment as customer_type
            from customer) using (customer_id) group by day_name, customer_type""", "del_clean", "dates"))
def j6(spark, folder):
    return (
        del_clean(spark, folder)
        .join(calendar(spark).select("date_key", "day_name"), "date_key")
        .join(sample.customers(spark, folder).select("customer_id", "customer_type"), "customer_id")
        .groupBy("day_name", "customer_type")
        .agg(F.count(F.lit(1)).alias("deliveries"), F.sum("declared_value").alias("declared_value"))
    )


HOURS = """select vehicle_id, date_trunc('hour', event_timestamp) as window_start, count(*) as gps_events,
    avg(speed_mph) as avg_speed, count(*) filter (engine_status = 'ON') as moving_time_events,
    count(*) filter (engine_status = 'IDLE') as idle_time_events,
    round(count(*) filter (engine_status = 'ON') * 100.0e0 / count(*), 2) as efficiency_score
    from gps_clean group by 1, 2"""
define("hours", HOURS, "gps_clean")


@query("j9_route_hours", check(
    f"""select vehicle_id, {at('window_start')}, {at("window_start + interval 1 hour", 'window_end')}, gps_events,
        {rd('avg_speed')}, moving_time_events, idle_time_events, efficiency_score, deliveries, {rd('avg_delay_minutes')}
        from hours join (select vehicle_id, date_trunc('hour', event_timestamp) as window_start, count(*) as deliveries,
            avg(delay_minutes) as avg_delay_minutes from del_clean where event_type = 'DELIVERED' group by 1, 2)
        using (vehicle_id, window_start)""", "hours", "del_clean"))
def j9(spark, folder):
    return trips.flatten_window(trips.route_hours(gps_clean(spark, folder), del_clean(spark, folder)))


@query("x5_vehicle_hours_batch", check(
    f"""select vehicle_id, {at('window_start')}, {at("window_start + interval 1 hour", 'window_end')}, gps_events,
        {rd('avg_speed')}, moving_time_events, idle_time_events, efficiency_score from hours""", "hours"))
def x5(spark, folder):
    return trips.flatten_window(trips.vehicle_hours(gps_clean(spark, folder)))


@query("p1_flatten_window", check(
    f"""select {at("date_trunc('hour', event_timestamp)", 'window_start')},
        {at("date_trunc('hour', event_timestamp) + interval 1 hour", 'window_end')}, count(*) as gps_events
        from gps group by date_trunc('hour', event_timestamp)""", "gps"))
def p1(spark, folder):
    hourly = sample.gps(spark, folder).groupBy(F.window("event_timestamp", "1 hour")).agg(F.count(F.lit(1)).alias("gps_events"))
    return trips.flatten_window(hourly)


@query("j11_driver_as_of", check(
    f"""select event_id, {at('event_timestamp')}, p.vehicle_id, d.driver_id from gps_latest p
        asof left join (select vehicle_id, event_timestamp as t, max(driver_id) as driver_id from deliveries group by 1, 2) d
        on p.vehicle_id = d.vehicle_id and p.event_timestamp >= d.t""", "gps_latest", "deliveries"))
def j11(spark, folder):
    pings = quality.latest_gps(sample.gps(spark, folder))
    return timeline.with_driver_as_of(pings, sample.deliveries(spark, folder)).select(
        "event_id", "event_timestamp", "vehicle_id", "driver_id")


# --- counters, latest state, alerts ------------------------------------------------------

@query("a17_delivery_counters", check(
    f"""select strftime(event_timestamp, '%Y-%m-%d') as event_date,
        count(*) filter (event_type = 'DELIVERED') as total_deliveries,
        {n("coalesce(sum(coalesce(delay_minutes, 0)) filter (event_type = 'DELIVERED'), 0)", 'total_delay_minutes')},
        count(*) filter (event_type = 'DELIVERED' and coalesce(delay_minutes, 0) <= 0) as on_time_count,
        count(*) filter (event_type = 'FAILED_ATTEMPT') as failed_attempts, {at('max(event_timestamp)', 'last_updated')}
        from deliveries where event_type in ('DELIVERED', 'FAILED_ATTEMPT') group by 1""", "deliveries"))
def a17(spark, folder):
    return rollups.delivery_counters(sample.deliveries(spark, folder))


@query("a18_driver_day_counters", check(
    f"""select driver_id, strftime(event_timestamp, '%Y-%m-%d') as event_date, count(*) as deliveries_completed,
        {n('sum(coalesce(delay_minutes, 0))', 'total_delay')}, {at('max(event_timestamp)', 'last_updated')}
        from deliveries where event_type = 'DELIVERED' and driver_id <> '' group by 1, 2""", "deliveries"))
def a18(spark, folder):
    return rollups.driver_day_counters(sample.deliveries(spark, folder))


@query("a19_fleet_day_counters", check(
    f"""select strftime(event_timestamp, '%Y-%m-%d') as event_date, count(*) as total_events,
        count(distinct vehicle_id) as active_vehicles, {at('max(event_timestamp)', 'last_updated')} from gps group by 1""", "gps"))
def a19(spark, folder):
    return rollups.fleet_day_counters(sample.gps(spark, folder))


def stored_sets(spark, folder):
    """Vehicle sets per date and hour, as a job stores them."""
    rows = sample.gps(spark, folder)
    named = rows.join(vehicle_sets.numbered(rows), "vehicle_id", "left").withColumns({
        "event_date": C.event_date("event_timestamp"), "hour": F.date_trunc("hour", "event_timestamp"), "is_moving": C.is_moving()})
    return stage(vehicle_sets.vehicle_sets(named, ["event_date", "hour"]), "vehicle-sets")


@query("a19_fleet_days_from_sets", check(
    f"""select strftime(event_timestamp, '%Y-%m-%d') as event_date, count(*) as total_events,
        count(distinct vehicle_id) as active_vehicles, true as estimate_within_bound, {at('max(event_timestamp)', 'last_updated')}
        from gps group by 1""", "gps"))
def a19_sets(spark, folder):
    """Days merged from hours; the sketch's estimate lies within 5 % of the exact count."""
    days = vehicle_sets.counts(stored_sets(spark, folder), ["event_date"])
    close = F.abs(F.col("estimated_vehicles") - F.col("active_vehicles")) <= F.greatest(0.05 * F.col("active_vehicles"), F.lit(1))
    return days.select("event_date", "total_events", "active_vehicles", close.alias("estimate_within_bound"), "last_updated")


@query("a13_vehicles_of_spans_from_sets", check(
    f"""select {at("date_trunc('week', event_timestamp)", 'week')}, count(*) as total_events, count(distinct vehicle_id) as active_vehicles,
        count(*) filter (engine_status = 'ON') as moving_count from gps group by 1""", "gps"))
def a13_sets(spark, folder):
    """Weeks, which no stored row is made for, merged from the sets of hours."""
    weeks = stored_sets(spark, folder).withColumn("week", F.date_trunc("week", "hour"))
    return vehicle_sets.counts(weeks, ["week"]).select("week", "total_events", "active_vehicles", "moving_count")


@query("a20_high_watermark", check(f"select {at('max(event_timestamp)', 'high_watermark')} from gps", "gps"))
def a20(spark, folder):
    return rollups.high_watermark(sample.gps(spark, folder))


define("newest", """
    select * from gps qualify row_number() over (partition by vehicle_id
        order by event_timestamp desc, processed_at desc, event_id desc) = 1""", "gps")


@query("a21_status_breakdown", check(
    """select engine_status, count(*) as vehicles, (select count(*) filter (fuel_level < 0.25e0) from newest) as low_fuel_vehicles
        from newest group by engine_status""", "newest"))
def a21(spark, folder):
    latest = reports.latest_positions(sample.gps(spark, folder))
    return rollups.status_breakdown(latest).withColumn("low_fuel_vehicles", rollups.low_fuel(latest).scalar())


@query("k8_latest_positions", check(
    f"""select vehicle_id, event_id, {at('event_timestamp')}, {rd('latitude')}, {rd('longitude')}, {rd('speed_mph')},
        engine_status, {rd('fuel_level')} from newest
        where event_timestamp > timestamp '2024-01-30 12:00:00' - interval 24 hour""", "newest"))
def k8(spark, folder):
    latest = reports.latest_positions(sample.gps(spark, folder))
    return reports.unexpired(latest, "2024-01-30 12:00:00", 24).select(
        "vehicle_id", "event_id", "event_timestamp", "latitude", "longitude", "speed_mph", "engine_status", "fuel_level")


@query("w3_latest_per_vehicle", check(
    f"select vehicle_id, event_id, {at('event_timestamp')}, {rd('speed_mph')} from newest", "newest"))
def w3(spark, folder):
    return reports.latest_positions(sample.gps(spark, folder)).select(
        "vehicle_id", "event_id", "event_timestamp", "speed_mph")


@query("k8_latest_statuses", check(
    f"""select delivery_id, event_type, {at('max(event_timestamp)', 'event_timestamp')} from deliveries
        group by 1, 2 having max(event_timestamp) > timestamp '2024-01-29 00:00:00' - interval 168 hour""", "deliveries"))
def k8_statuses(spark, folder):
    latest = reports.latest_statuses(sample.deliveries(spark, folder))
    return reports.unexpired(latest, "2024-01-29 00:00:00", 168).select("delivery_id", "event_type", "event_timestamp")


ALERTS = f"""
    select delivery_id, event_type, {at('event_timestamp')}, {n('delay_minutes')}, 'DELAY' as alert_type,
        concat('Delivery Delay Alert - ', delivery_id) as subject,
        concat('Delivery ', delivery_id, ' is delayed by ', delay_minutes, ' minutes. Order ID: ', order_id,
            '. Customer: ', customer_id, '. Driver: ', driver_id, '. Vehicle: ', vehicle_id,
            '. Current Status: ', event_type, '.') as message
    from deliveries where delay_minutes > 30
    union all
    select delivery_id, event_type, {at('event_timestamp')}, {n('delay_minutes')}, 'FAILED_ATTEMPT',
        concat('Failed Delivery - ', delivery_id),
        concat('Delivery attempt failed for ', delivery_id, '. Order ID: ', order_id, '. Customer: ', customer_id,
            '. Location: unknown, unknown. Reason: Unknown.')
    from deliveries where event_type = 'FAILED_ATTEMPT'"""


@query("k10_alerts", check(ALERTS, "deliveries"))
def k10(spark, folder):
    return reports.alerts(sample.deliveries(spark, folder)).drop("latitude", "longitude")


@query("f8_alert_predicates", check(
    f"""select delivery_id, {at('event_timestamp')}, coalesce(delay_minutes > 30, false) as is_delay_alert,
        event_type = 'FAILED_ATTEMPT' as is_failure_alert
        from deliveries where delay_minutes > 30 or event_type = 'FAILED_ATTEMPT'""", "deliveries"))
def f8(spark, folder):
    rows = sample.deliveries(spark, folder).where(C.is_delay_alert() | C.has_status("FAILED_ATTEMPT"))
    return rows.select(
        "delivery_id", "event_timestamp", F.coalesce(C.is_delay_alert(), F.lit(False)).alias("is_delay_alert"),
        C.has_status("FAILED_ATTEMPT").alias("is_failure_alert"))


@query("f9_repeated_failures", check(
    """select driver_id, strftime(event_timestamp, '%Y-%m-%d') as event_date, count(*) as failed_attempts
        from deliveries where event_type = 'FAILED_ATTEMPT' group by 1, 2 having count(*) >= 3""", "deliveries"))
def f9(spark, folder):
    return reports.repeated_failures(sample.deliveries(spark, folder))


@query("k9_daily_kpi_report", check(
    f"""select summary_date as report_date, total_gps_events, active_vehicles, total_deliveries, on_time_delivery_pct,
        {rd('avg_delay_minutes')}, {rd('active_vehicles * 100.0e0 / (select count(*) from vehicles)', 'fleet_utilization_pct')}
        from summary""", "summary", "vehicles"))
def k9(spark, folder):
    return reports.kpi_report(summary(spark, folder), sample.vehicles(spark, folder))


@query("a22_cost_beside_mean", check(
    f"select date_key, total_deliveries, {rd('(select avg(total_deliveries) from daily_del)', 'mean_total_deliveries')} from daily_del",
    "daily_del"))
def a22(spark, folder):
    return rollups.beside_mean(rollups.daily_deliveries(del_clean(spark, folder), exact=True), "total_deliveries")


@query("w4_period_change", check(
    f"""select date_key, total_deliveries, {rd('avg_delay_minutes')},
        total_deliveries - lag(total_deliveries) over w as total_deliveries_change,
        {rd('(total_deliveries - lag(total_deliveries) over w) * 100.0e0 / lag(total_deliveries) over w', 'total_deliveries_change_pct')},
        {rd('avg_delay_minutes - lag(avg_delay_minutes) over w', 'avg_delay_minutes_change')},
        {rd('(avg_delay_minutes - lag(avg_delay_minutes) over w) * 100.0e0 / nullif(lag(avg_delay_minutes) over w, 0)', 'avg_delay_minutes_change_pct')}
        from daily_del window w as (order by date_key)""", "daily_del"))
def w4(spark, folder):
    daily = rollups.daily_deliveries(del_clean(spark, folder), exact=True).select(
        "date_key", "total_deliveries", "avg_delay_minutes")
    return rollups.period_change(daily, "date_key", ["total_deliveries", "avg_delay_minutes"])


# --- ordered windows and trips -----------------------------------------------------------

@query("w5_attempt_numbers", check(
    f"""select delivery_id, {at('event_timestamp')}, event_type, vehicle_id, driver_id,
        row_number() over (partition by delivery_id order by event_timestamp, event_type, vehicle_id, driver_id) as attempt_number
        from deliveries where event_type in ('DELIVERED', 'FAILED_ATTEMPT', 'RETURNED')""", "deliveries"))
def w5(spark, folder):
    tasks = sample.delivery_tasks(spark, folder)
    return trips.attempt_numbers(sample.deliveries(spark, folder, tasks), tasks=tasks).select(
        "delivery_id", "event_timestamp", "event_type", "vehicle_id", "driver_id", "attempt_number")


define("linked", """
    select *, date_diff('microsecond', p_ts, event_timestamp) / 60e6 as gap_minutes,
        sqrt(power((latitude - p_lat) * 69, 2) + power((longitude - p_lon) * 69 * cos(radians(latitude)), 2)) as gap_miles,
        greatest(p_fuel - fuel_level, 0.0e0) as burned, p_status = 'IDLE' as was_idle,
        p_status = 'ON' and engine_status <> 'ON' as is_stop
    from (select *, lag(event_timestamp) over w as p_ts, lag(latitude) over w as p_lat, lag(longitude) over w as p_lon,
            lag(fuel_level) over w as p_fuel, lag(engine_status) over w as p_status, lag(odometer_miles) over w as p_odo
        from gps_clean window w as (partition by vehicle_id order by event_timestamp, event_id))""", "gps_clean")
define("numbered", f"""
    select *, sum(cast(starts as int)) over (partition by vehicle_id order by event_timestamp, event_id) as trip_number
    from (select *, p_ts is null or gap_minutes > {RATES.trip_gap_minutes} or p_status = 'OFF' as starts from linked)""", "linked")
define("trips", f"""
    select vehicle_id, cast(trip_number as bigint) as trip_number,
        concat(vehicle_id, '-', cast(trip_number as bigint)) as trip_id, count(*) as gps_events,
        min(event_timestamp) as start_time, max(event_timestamp) as end_time, avg(speed_mph) as avg_speed_mph,
        max(speed_mph) as max_speed_mph, max(odometer_miles) - min(odometer_miles) as distance_miles,
        sum(case when starts then 0.0e0 else burned end) * {RATES.tank_gallons} as gallons,
        sum(case when not starts and was_idle then gap_minutes else 0.0e0 end) as idle_minutes,
        count(*) filter (not starts and is_stop) as stop_count,
        date_diff('microsecond', min(event_timestamp), max(event_timestamp)) / 60e6 as duration_minutes
    from numbered group by vehicle_id, trip_number""", "numbered")


@query("w6_trip_segmentation", check(
    f"select event_id, vehicle_id, {n('trip_number')}, concat(vehicle_id, '-', cast(trip_number as bigint)) as trip_id from numbered",
    "numbered"))
def w6(spark, folder):
    return trips.with_trip_id(gps_facts(spark, folder)).select("event_id", "vehicle_id", "trip_number", "trip_id")


define("idle_days", """
    select vehicle_id, date_key, stop_count, fuel_used, coalesce(idle_minutes, 0.0e0) as idle_minutes
    from (select vehicle_id, date_key, count(*) filter (is_stop) as stop_count, coalesce(sum(burned), 0) as fuel_used,
            count(burned) as links from linked group by 1, 2)
    left join (select vehicle_id, cast(strftime(p_ts, '%Y%m%d') as bigint) as date_key, sum(gap_minutes) as idle_minutes
        from linked where was_idle group by 1, 2) using (vehicle_id, date_key)""", "linked")


@query("w7_idle_and_stops", check(
    f"select vehicle_id, date_key, stop_count, {rd('idle_minutes')} from idle_days", "idle_days"))
def w7(spark, folder):
    return trips.idle_days(gps_facts(spark, folder)).drop("fuel_used")


@query("w8_lifecycle_violations", check(
    f"""select delivery_id, {at('event_timestamp')}, event_type, previous_status from (
            select *, lag(event_type) over (partition by delivery_id
                order by event_timestamp, event_type, vehicle_id, driver_id, order_id) as previous_status from del_latest)
        where previous_status is not null and concat(previous_status, '>', event_type) not in (
            'ORDER_PLACED>ORDER_CONFIRMED', 'ORDER_CONFIRMED>PICKED_UP', 'PICKED_UP>IN_TRANSIT',
            'IN_TRANSIT>OUT_FOR_DELIVERY', 'OUT_FOR_DELIVERY>DELIVERED', 'OUT_FOR_DELIVERY>FAILED_ATTEMPT',
            'FAILED_ATTEMPT>OUT_FOR_DELIVERY', 'FAILED_ATTEMPT>RETURNED')""", "del_latest"))
def w8(spark, folder):
    return quality.lifecycle_violations(quality.latest_deliveries(sample.deliveries(spark, folder))).select(
        "delivery_id", "event_timestamp", "event_type", "previous_status")


@query("w9_ping_distances", check(
    f"""select event_id, vehicle_id, {at('event_timestamp')}, {rd('gap_miles')},
        {rd('odometer_miles - p_odo', 'odometer_gap_miles')} from linked""", "linked"))
def w9(spark, folder):
    return trips.ping_distances(gps_facts(spark, folder))


@query("x10_gap_sessions_batch", check(
    f"""select vehicle_id, {at('min(event_timestamp)', 'session_start')},
        {at('max(event_timestamp) + interval 30 minute', 'session_end')}, count(*) as gps_events
        from (select *, sum(cast(p_ts is null or date_diff('microsecond', p_ts, event_timestamp) >= 1800000000 as int))
                over (partition by vehicle_id order by event_timestamp, event_id) as session_number from linked)
        group by vehicle_id, session_number""", "linked"))
def x10(spark, folder):
    return trips.gap_sessions(gps_facts(spark, folder))


TRIP = f"""trip_id, vehicle_id, trip_number, gps_events, {at('start_time')}, {at('end_time')}, {rd('avg_speed_mph')},
    {rd('max_speed_mph')}, {rd('distance_miles')}, {rd('gallons')}, {rd('idle_minutes')}, stop_count, {rd('duration_minutes')}"""


@query("a24_trip_costs", check(
    f"""select {TRIP}, {rd(f'gallons * {RATES.fuel_price}', 'fuel_cost')},
        {rd(f'gallons * {RATES.fuel_price} / nullif(distance_miles, 0)', 'cost_per_mile')} from trips""", "trips"))
def a24(spark, folder):
    return trips.trips(gps_facts(spark, folder))


define("routes", f"""
    select *, on_time_percentage * {RATES.on_time_weight} + moving_percentage * {RATES.moving_weight} as route_efficiency_score,
        gallons * {RATES.fuel_price} as total_fuel_cost
    from (select vehicle_id, date_key, gps_events, moving_events, total_distance_miles, total_duration_minutes,
            moving_events * 100.0e0 / gps_events as moving_percentage, stop_count, idle_minutes,
            fuel_used * {RATES.tank_gallons} as gallons,
            coalesce(planned_stops, 0) as planned_stops, coalesce(completed_stops, 0) as completed_stops,
            coalesce(failed_stops, 0) as failed_stops, on_time_percentage
        from (select vehicle_id, date_key, count(*) as gps_events, count(*) filter (engine_status = 'ON') as moving_events,
                max(odometer_miles) - min(odometer_miles) as total_distance_miles,
                date_diff('microsecond', min(event_timestamp), max(event_timestamp)) / 60e6 as total_duration_minutes
            from gps_clean group by 1, 2)
        left join (select vehicle_id, date_key, stop_count, idle_minutes, fuel_used from idle_days) using (vehicle_id, date_key)
        left join (select vehicle_id, date_key, count(distinct order_id) as planned_stops,
                count(*) filter (event_type = 'DELIVERED') as completed_stops,
                count(*) filter (event_type = 'FAILED_ATTEMPT') as failed_stops,
                count(*) filter (event_type <> 'OUT_FOR_DELIVERY' and delay_minutes <= 0) * 100.0e0
                    / nullif(count(*) filter (event_type <> 'OUT_FOR_DELIVERY'), 0) as on_time_percentage
            from del_latest group by 1, 2) using (vehicle_id, date_key))""", "gps_clean", "idle_days", "del_latest")


def routes(spark, folder):
    return trips.route_performance(gps_facts(spark, folder), del_latest(spark, folder))


@query("a23_route_performance", check(
    f"""select vehicle_id, date_key, gps_events, moving_events, {rd('total_distance_miles')}, {rd('total_duration_minutes')},
        stop_count, {rd('idle_minutes')}, planned_stops, completed_stops, failed_stops, {rd('on_time_percentage')},
        {rd('moving_percentage')}, {rd('route_efficiency_score')}, {rd('gallons')}, {rd('total_fuel_cost')},
        {rd('idle_minutes / nullif(stop_count, 0)', 'avg_stop_duration_minutes')},
        {rd('total_fuel_cost / nullif(completed_stops, 0)', 'cost_per_delivery')},
        {rd('total_fuel_cost / nullif(total_distance_miles, 0)', 'cost_per_mile')} from routes""", "routes"))
def a23(spark, folder):
    return routes(spark, folder)


define("extended", f"""
    select *, total_fuel_cost + total_miles_driven * {RATES.operating_cost_per_mile} as total_operational_cost,
        active_vehicles * 100.0e0 / total_vehicles as fleet_utilization_pct
    from (select *, (select count(*) from vehicles) as total_vehicles, (select count(*) from drivers) as total_drivers from summary)
    left join (select date_key, sum(total_distance_miles) as total_miles_driven, sum(gallons) as total_fuel_consumed,
            sum(total_fuel_cost) as total_fuel_cost, avg(route_efficiency_score) as avg_route_efficiency
        from routes group by 1) using (date_key)
    left join (select date_key, count(*) filter (event_type = 'FAILED_ATTEMPT') as failed_deliveries
        from del_clean group by 1) using (date_key)""", "summary", "routes", "del_clean", "vehicles", "drivers")


def extended(spark, folder):
    return extended_and_clean(spark, folder)[0]


def extended_and_clean(spark, folder):
    """From stored facts and the stored route table, each made once; and the clean deliveries it is made of."""
    pings, done = gps_facts(spark, folder), stage(del_latest(spark, folder), "delivery-facts")
    clean = quality.flagged(done.where(C.is_terminal()))
    per_route = stage(trips.route_performance(pings, done), "routes")
    summary = trips.extended_summary(
        rollups.daily_summary(pings, clean, exact=True), per_route, clean,
        sample.vehicles(spark, folder), sample.drivers(spark, folder))
    return summary, clean


@query("a25_extended_summary", check(
    f"""select {SUMMARY}, total_vehicles, total_drivers, failed_deliveries, {rd('total_miles_driven')},
        {rd('total_fuel_consumed')}, {rd('total_fuel_cost')}, {rd('avg_route_efficiency')},
        {rd('total_miles_driven / nullif(total_fuel_consumed, 0)', 'avg_mpg')}, {rd('total_operational_cost')},
        {rd('total_operational_cost / nullif(successful_deliveries, 0)', 'cost_per_delivery')},
        {rd('total_operational_cost / nullif(total_miles_driven, 0)', 'cost_per_mile')}, {rd('fleet_utilization_pct')}
        from extended""", "extended"))
def a25(spark, folder):
    return extended(spark, folder)


@query("a26_headline_kpis", check(
    f"""select {rd('(select avg(delay_minutes) from del_clean)', 'avg_delay_minutes')},
        {rd('(select count(*) filter (delay_minutes > 0) * 100.0e0 / count(delay_minutes) from del_clean)', 'delayed_pct')},
        {rd('avg(avg_route_efficiency)', 'route_efficiency_score')},
        {rd('sum(total_operational_cost) / sum(total_miles_driven)', 'cost_per_mile')},
        {rd('avg(fleet_utilization_pct)', 'fleet_utilization_pct')} from extended""", "extended", "del_clean"))
def a26(spark, folder):
    """From the stored summary and the stored deliveries it is made of."""
    summary, clean = extended_and_clean(spark, folder)
    return trips.headline_kpis(stage(summary, "extended-summary"), clean)


@query("a27_incremental_savings", check(
    f"""select full_partitions, full_records, incremental_partitions, incremental_records,
        {rd('(1 - incremental_partitions / full_partitions::double) * 100', 'partitions_reduction_pct')},
        {rd('(1 - incremental_records / full_records::double) * 100', 'records_reduction_pct')}, true as fewer_bytes
        from (select count(distinct cast(event_timestamp as date)) as full_partitions, count(*) as full_records,
            count(distinct cast(event_timestamp as date)) filter (cast(event_timestamp as date) > date '2024-01-13') as incremental_partitions,
            count(*) filter (cast(event_timestamp as date) > date '2024-01-13') as incremental_records from gps)""", "gps"))
def a27(spark, folder):
    full = files.scan(spark, landed_rollup_gps(spark, folder))
    part = files.newer_partitions(full, date(2024, 1, 13))
    return files.savings(full, part, ["year", "month", "day"]).withColumn(
        "fewer_bytes", F.col("incremental_bytes") < F.col("full_bytes"),
    ).drop("full_bytes", "incremental_bytes", "bytes_reduction_pct")


@query("c10_source_availability", check(
    """select event_date, coalesce(g, 0) as gps_rows, coalesce(d, 0) as delivery_rows,
        coalesce(g, 0) > 0 and coalesce(d, 0) > 0 as is_available
        from (select strftime(event_timestamp, '%Y-%m-%d') as event_date, count(*) as g from gps group by 1)
        full join (select strftime(event_timestamp, '%Y-%m-%d') as event_date, count(*) as d from deliveries group by 1)
        using (event_date)""", "gps", "deliveries"))
def c10(spark, folder):
    return quality.daily_availability(sample.gps(spark, folder), sample.deliveries(spark, folder))


@query("c11_output_completeness", check(
    f"""select event_date, expected_rows, coalesce(actual_rows, 0) as actual_rows, {rd('delay_minutes_null_rate')},
        {rd('driver_id_null_rate')}, expected_rows = coalesce(actual_rows, 0) as is_complete
        from (select strftime(event_timestamp, '%Y-%m-%d') as event_date, count(*) as expected_rows from deliveries group by 1)
        left join (select event_date, count(*) as actual_rows,
            count(*) filter (delay_minutes is null) / count(*)::double as delay_minutes_null_rate,
            0.0e0 as driver_id_null_rate from del_clean group by 1) using (event_date)""", "deliveries", "del_clean"))
def c11(spark, folder):
    raw = sample.event_day(sample.deliveries(spark, folder))
    return quality.completeness(raw, sample.event_day(del_clean(spark, folder)), ["delay_minutes", "driver_id"])


# --- places ------------------------------------------------------------------------------

define("customer_places", """
    select c_custkey as place_id, 25.0e0 + (c_custkey * 7919 % 23000) / 1000.0e0 as latitude,
        -125.0e0 + (c_custkey * 104729 % 55000) / 1000.0e0 as longitude from customer""")


def customer_places(spark, folder):
    key = F.col("c_custkey")
    return sample.table(spark, folder, "customer").select(
        key.alias("place_id"), (25 + key * 7919 % 23000 / 1000).alias("latitude"), (-125 + key * 104729 % 55000 / 1000).alias("longitude"))


@query("w7_pings_near_places", check(
    f"""select event_id, p.place_id, {rd('p.miles', 'place_miles')} from gps_clean g left join (
            select event_id, arg_min(place_id, (miles, place_id)) as place_id, min(miles) as miles from (
                select event_id, place_id, sqrt(pow((p.latitude - g.latitude) * 69.0e0, 2)
                    + pow((p.longitude - g.longitude) * 69.0e0 * cos(radians(p.latitude)), 2)) as miles
                from gps_clean g, customer_places p where abs(p.latitude - g.latitude) < 0.2) where miles <= 5 group by event_id) p
        using (event_id)""", "gps_clean", "customer_places"))
def w7_places(spark, folder):
    """Every ping with the nearest customer within five miles."""
    pings = gps_clean(spark, folder).select("event_id", "latitude", "longitude")
    return places.near_places(pings, customer_places(spark, folder), ["event_id"], 5.0).select("event_id", "place_id", "place_miles")


@query("w7_stays", check(
    f"""select vehicle_id, {at('min(event_timestamp)', 'start_time')}, {at('max(event_timestamp)', 'end_time')}, count(*) as pings,
        {rd('avg(latitude)', 'latitude')}, {rd('avg(longitude)', 'longitude')}
        from (select *, sum(leaves) over (partition by vehicle_id order by event_timestamp, event_id) as stay from (
            select *, case when sqrt(pow((latitude - lag(latitude) over v) * 69.0e0, 2)
                + pow((longitude - lag(longitude) over v) * 69.0e0 * cos(radians(latitude)), 2)) <= 600 then 0 else 1 end as leaves
            from gps_clean window v as (partition by vehicle_id order by event_timestamp, event_id)))
        group by vehicle_id, stay having max(event_timestamp) - min(event_timestamp) >= interval 30 minute""", "gps_clean"))
def w7_stays(spark, folder):
    """The sample's pings lie far apart, so a stay is taken to be within 600 miles and 30 minutes here."""
    return places.stays(gps_clean(spark, folder), 600.0, 30.0).select(
        "vehicle_id", "start_time", "end_time", "pings", "latitude", "longitude")
