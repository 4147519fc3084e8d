"""Registered queries: windowed metrics in batch, and streams run to their end over the tables."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from roadgauge.functions import columns as C
from roadgauge.operators import quality
from roadgauge.plans.queries_records import ENRICHED_GPS
from roadgauge.plans.registry import at, check, close_count, define, n, query, rd
from roadgauge.session import scratch_dir, stage
from roadgauge.sources import files, sample
from roadgauge.streaming import compaction, corrected, counters, job, joins, panes, sinks, trips, windows
from roadgauge.streaming.attempts import STORE

#: Bytes of stored rows that a task reads to write slices.
PART_BYTES = 128 << 20


def gps_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The pings as a stream over the events file."""
    schema = sample.table(spark, folder, "events").schema
    return sample.gps_from(spark.readStream.schema(schema).parquet(f"{folder}/events*.parquet"))


def delivery_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The delivery events as a stream over the line items, joined to the static orders."""
    schema = sample.table(spark, folder, "lineitem").schema
    rows = spark.readStream.schema(schema).parquet(f"{folder}/lineitem*.parquet")
    return sample.deliveries_from(rows, sample.table(spark, folder, "orders"))


def finished(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Run a stream over all present data into a Parquet table and read it."""
    root = scratch_dir(spark, label)
    sinks.to_parquet(df, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    # a stream that closed nothing leaves no file to take the schema from
    return spark.read.schema(df.schema).parquet(f"{root}/out")


def written_slices(spark: SparkSession, rows: DataFrame, place: Column, label: str, slices: int, parts: int) -> DataFrame:
    """A stream over the rows of each place, 0 to slices - 1, one micro-batch each, in this order.

    A slice is written by ``parts`` tasks to as many files, and one without rows for all of them is filled up by empty files.
    """
    path = scratch_dir(spark, label)
    for i in range(slices):
        rows.where(place == i).coalesce(parts).write.mode("append").parquet(path)
        while len(spark.read.schema(rows.schema).parquet(path).inputFiles()) < (i + 1) * parts:
            rows.where(F.lit(False)).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", parts).parquet(path)


def stored_parts(spark: SparkSession, df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """The rows written once, and how many tasks read them in parts of at most about PART_BYTES."""
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.parquet(path), max(1, math.ceil(files.size(spark, path) / PART_BYTES))


def in_slices(spark: SparkSession, df: DataFrame, label: str, slices: int = 3) -> DataFrame:
    """A stream over the rows, written in slices of time one after the other, so that it takes several micro-batches."""
    rows, parts = stored_parts(spark, df, label)
    low, high = rows.agg(F.min(F.unix_micros("event_timestamp")), F.max(F.unix_micros("event_timestamp"))).first()
    place = F.floor((F.unix_micros("event_timestamp") - F.lit(low)) * slices / F.lit(high - low + 1))
    return written_slices(spark, rows, place, f"{label}-slices", slices, parts)


def in_hashed_slices(spark: SparkSession, df: DataFrame, columns: tuple[str, ...], label: str, slices: int) -> DataFrame:
    """A stream over the rows in no order of time: every micro-batch has rows of every date."""
    rows, parts = stored_parts(spark, df, f"{label}-rows")
    return written_slices(spark, rows, F.pmod(F.xxhash64(*columns), F.lit(slices)), f"{label}-in", slices, parts)


def gps_slices(spark: SparkSession, folder: str, label: str) -> DataFrame:
    return in_slices(spark, sample.gps(spark, folder), label)


def delivery_slices(spark: SparkSession, folder: str, label: str) -> DataFrame:
    return in_slices(spark, sample.deliveries(spark, folder), label)


define("fleet_windows", """
    select s as window_start, s + interval 5 minute as window_end, count(*) as total_events,
        count(distinct vehicle_id) as active_vehicles, avg(speed_mph) as avg_speed,
        quantile_disc(speed_mph, 0.5) as median_speed, avg(fuel_level) as avg_fuel_level,
        count(*) filter (fuel_level < 0.1e0) as critical_fuel_count,
        count(*) filter (engine_status = 'ON') as moving_events, count(*) filter (engine_status = 'IDLE') as idle_events,
        count(distinct vehicle_id) filter (engine_status = 'ON') as moving_vehicles,
        count(distinct vehicle_id) filter (engine_status = 'IDLE') as idle_vehicles
    from (select *, date_trunc('minute', event_timestamp) - to_minutes(unnest([0, 1, 2, 3, 4])) as s from gps)
    group by s""", "gps")
define("kpi_windows", """
    select s as window_start, s + interval 15 minute as window_end, count(*) as total_deliveries,
        avg(delay_minutes) as avg_delay_minutes, quantile_disc(delay_minutes, 0.5) as median_delay,
        quantile_disc(delay_minutes, 0.95) as p95_delay, count(*) filter (delay_minutes <= 0) as on_time_deliveries,
        count(distinct driver_id) as active_drivers, count(distinct vehicle_id) as active_vehicles,
        avg(package_weight_lbs) as avg_package_weight
    from (select *, time_bucket(interval 5 minute, event_timestamp) - to_minutes(unnest([0, 5, 10])) as s
        from deliveries where event_type = 'DELIVERED')
    group by s""", "deliveries")

FLEET = f"""{at('window_start')}, {at('window_end')}, strftime(window_start, '%Y-%m-%d') as event_date, total_events,
    {rd('avg_speed')}, {rd('avg_fuel_level')}, critical_fuel_count, moving_events, idle_events"""
FLEET_COLUMNS = ["window_start", "window_end", "event_date", "total_events", "avg_speed", "avg_fuel_level",
                 "critical_fuel_count", "moving_events", "idle_events"]
KPIS = f"""{at('window_start')}, {at('window_end')}, strftime(window_start, '%Y-%m-%d') as event_date, total_deliveries,
    {rd('avg_delay_minutes')}, on_time_deliveries, {rd('avg_package_weight')},
    round(on_time_deliveries / total_deliveries::double * 100, 2) as on_time_percentage"""
KPI_COLUMNS = ["window_start", "window_end", "event_date", "total_deliveries", "avg_delay_minutes",
               "on_time_deliveries", "avg_package_weight", "on_time_percentage"]


@query("x3_sliding_fleet_metrics_batch", check(
    f"""select {FLEET}, active_vehicles, {rd('median_speed')}, moving_vehicles, idle_vehicles,
        round(moving_events / active_vehicles::double * 100, 2) as moving_events_per_vehicle_pct,
        round(moving_vehicles / active_vehicles::double * 100, 2) as fleet_utilization_pct,
        true as approx_within_bound from fleet_windows""", "fleet_windows"))
def x3(spark, folder):
    rows = sample.gps(spark, folder)
    near = windows.fleet_metrics(rows).select(
        "window_start", F.col("active_vehicles").alias("near_vehicles"), F.col("median_speed").alias("near_median"))
    exact = windows.fleet_metrics_exact(rows).join(near, "window_start")
    close = close_count("near_vehicles", "active_vehicles")
    return exact.withColumn(
        "approx_within_bound", close & F.col("near_median").eqNullSafe(F.col("median_speed")),
    ).drop("near_vehicles", "near_median")


@query("x4_sliding_delivery_kpis_batch", check(
    f"""select {KPIS}, {n('median_delay')}, {n('p95_delay')}, active_drivers, active_vehicles,
        round(total_deliveries / active_drivers::double, 2) as deliveries_per_driver,
        true as approx_within_bound from kpi_windows""", "kpi_windows"))
def x4(spark, folder):
    rows = sample.deliveries(spark, folder)
    near = windows.delivery_kpis(rows).select(
        "window_start", F.col("active_drivers").alias("near_drivers"), F.col("p95_delay").alias("near_p95"))
    exact = windows.delivery_kpis_exact(rows).join(near, "window_start")
    close = close_count("near_drivers", "active_drivers")
    return exact.withColumn(
        "approx_within_bound", close & F.col("near_p95").eqNullSafe(F.col("p95_delay")),
    ).drop("near_drivers", "near_p95")


@query("x3_sliding_fleet_metrics_stream", check(
    f"""select {FLEET}, active_vehicles, {rd('median_speed')}, moving_vehicles, idle_vehicles,
        round(moving_vehicles / active_vehicles::double * 100, 2) as fleet_utilization_pct
        from fleet_windows
        where window_end <= (select max(event_timestamp) from gps) - interval 1 minute""", "fleet_windows"))
def x3_stream(spark, folder):
    """The stream's own values, merged from panes. Sketches of so few rows a window are exact."""
    made = panes.fleet_windows(panes.fleet_panes(gps_slices(spark, folder, "x3-in")))
    return finished(spark, made, "x3").select(
        *FLEET_COLUMNS, "active_vehicles", "median_speed", "moving_vehicles", "idle_vehicles", "fleet_utilization_pct")


def beside_exact(own: DataFrame, deliveries: DataFrame) -> DataFrame:
    """The windows of a stream, and whether their sketched values lie within bounds of the exact batch form's.

    Distinct counts may differ by the sketch's error, percentiles by 2 % in rank.
    """
    counts, ranks = ("active_drivers", "active_vehicles"), {"median_delay": 0.5, "p95_delay": 0.95}
    exact = windows.delivery_kpis_exact(deliveries).select("window_start", *[F.col(c).alias(f"exact_{c}") for c in counts])
    around = windows.exact_percentiles(
        deliveries.where(C.has_status("DELIVERED")), windows.DELIVERY, "delay_minutes",
        {f"{name}_{side}": share + by for name, share in ranks.items() for side, by in (("low", -0.02), ("high", 0.02))})
    within = F.lit(True)
    for c in counts:
        within = within & close_count(c, f"exact_{c}")
    for c in ranks:
        # no value at all on either side, or one between the exact ones
        within = within & F.when(F.col(c).isNull(), F.col(f"{c}_low").isNull()).otherwise(F.col(c).between(F.col(f"{c}_low"), F.col(f"{c}_high")))
    both = own.join(exact, "window_start", "left").join(around, "window_start", "left")
    return both.select(*own.columns, F.coalesce(within, F.lit(False)).alias("sketches_within_bound"))


@query("x4_sliding_delivery_kpis_stream", check(
    f"""select {KPIS}, {n('median_delay')}, {n('p95_delay')}, active_drivers, active_vehicles, true as sketches_within_bound
        from kpi_windows where window_end <=
        (select max(event_timestamp) from deliveries where event_type = 'DELIVERED') - interval 2 minute""", "kpi_windows"))
def x4_stream(spark, folder):
    """As x3: several micro-batches, panes of five minutes, three of them a window. The stream's own values, compared with the exact ones."""
    made = panes.delivery_windows(panes.delivery_panes(delivery_slices(spark, folder, "x4-in")))
    own = finished(spark, made, "x4").select(
        *KPI_COLUMNS, "median_delay", "p95_delay", "active_drivers", "active_vehicles")
    return beside_exact(own, sample.deliveries(spark, folder))


LONG = windows.Slide(24 * 60, 60, 1)


@query("x3_day_windows_from_panes", check(
    f"""select {at('s', 'window_start')}, count(*) as total_events, count(distinct vehicle_id) as vehicles, true as ranks_within_bound,
        true as vehicles_within_bound
    from (select *, date_trunc('hour', event_timestamp) - to_hours(unnest(range(24))) as s from gps)
    group by s""", "gps"))
def x3_days(spark, folder):
    """Windows of a day that slide by the hour: rows enter one pane instead of 24 windows, and the sketches are past their exact size.

    The median's rank among the window's pings lies within 2 %, and the count of vehicles within 5 % of the exact one.
    """
    rows = stage(sample.gps(spark, folder), "x3-days")
    made = stage(panes.fleet_windows(panes.fleet_panes(rows, LONG), LONG).select(
        "window_start", "total_events", "active_vehicles", "median_speed"), "x3-windows")
    hourly = rows.groupBy(F.date_trunc("hour", "event_timestamp").alias("hour"), "vehicle_id", "speed_mph").agg(
        F.count(F.lit(1)).alias("n"))
    spread = hourly.withColumn("window_start", F.explode(F.sequence(
        F.col("hour") - F.expr("interval 23 hours"), F.col("hour"), F.expr("interval 1 hour")))).drop("hour")
    both = spread.join(made, "window_start").groupBy("window_start", "total_events", "active_vehicles").agg(
        F.sum(F.when(F.col("speed_mph") < F.col("median_speed"), F.col("n")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("speed_mph") <= F.col("median_speed"), F.col("n")).otherwise(0)).alias("upto"),
        F.sum(F.when(F.col("speed_mph").isNotNull(), F.col("n")).otherwise(0)).alias("ranked"),
        F.countDistinct("vehicle_id").alias("vehicles"))
    within = (F.col("below") <= 0.52 * F.col("ranked")) & (F.col("upto") >= 0.48 * F.col("ranked"))
    close = F.abs(F.col("active_vehicles") - F.col("vehicles")) <= F.greatest(0.05 * F.col("vehicles"), F.lit(1))
    return both.select("window_start", "total_events", "vehicles", within.alias("ranks_within_bound"), close.alias("vehicles_within_bound"))


define("raw_hours", """
    select vehicle_id, date_trunc('hour', event_timestamp) as window_start, count(*) as gps_events,
        avg(speed_mph) as avg_speed, count(*) filter (engine_status = 'ON') as moving_time_events,
        count(*) filter (engine_status = 'IDLE') as idle_time_events,
        round(count(*) filter (engine_status = 'ON') / count(*)::double * 100, 2) as efficiency_score
    from gps group by 1, 2""", "gps")


@query("x5_vehicle_hours_stream", check(
    f"""select vehicle_id, {at('window_start')}, gps_events, {rd('avg_speed')}, moving_time_events, idle_time_events,
        efficiency_score from raw_hours
        where window_start + interval 1 hour <= (select max(event_timestamp) from gps) - interval 1 minute""", "raw_hours"))
def x5_stream(spark, folder):
    hours = windows.flat(windows.vehicle_hours(gps_slices(spark, folder, "x5-in")))
    return finished(spark, hours, "x5").drop("window_end", "event_date")


@query("x1_enrich_gps_stream", check(f"select {ENRICHED_GPS} from gps", "gps"))
def x1_stream(spark, folder):
    """All derived columns of all rows, after several micro-batches."""
    rows = finished(spark, C.enrich_gps(gps_slices(spark, folder, "x1-in")), "x1")
    return rows.select(
        "event_id", "processed_at", F.col("event_date").cast("string").alias("event_date"), "event_hour", "day_of_week", "day_name",
        "is_weekend", "speed_category", "fuel_status", "is_moving")


@query("x9_stream_first_copies", check("select event_id, 1::bigint as copies from gps group by event_id", "gps"))
def x9(spark, folder):
    kept = C.enrich_gps(windows.first_copies(gps_slices(spark, folder, "x9-first-in")))
    return finished(spark, kept, "x9").groupBy("event_id").agg(F.count(F.lit(1)).alias("copies"))


define("sessions", """
    select vehicle_id, min(event_timestamp) as session_start, max(event_timestamp) + interval 30 minute as session_end,
        count(*) as gps_events
    from (select *, sum(cast(prior is null or date_diff('microsecond', prior, event_timestamp) >= 1800000000 as int))
            over (partition by vehicle_id order by event_timestamp, event_id, processed_at) as number
        from (select *, lag(event_timestamp) over (partition by vehicle_id
            order by event_timestamp, event_id, processed_at) as prior from gps))
    group by vehicle_id, number""", "gps")


@query("x10_session_trips_stream", check(
    f"""select vehicle_id, {at('session_start')}, {at('session_end')}, gps_events from sessions
        where session_end <= (select max(event_timestamp) from gps) - interval 10 minute""", "sessions"))
def x10_stream(spark, folder):
    sessions = windows.session_trips(gps_stream(spark, folder)).withColumn("event_date", C.event_date("session_start"))
    return finished(spark, sessions, "x10").drop("event_date")


@query("x12_stream_delivery_counters", check(
    f"""select strftime(event_timestamp, '%Y-%m-%d') as event_date,
        count(*) filter (event_type = 'DELIVERED') as total_deliveries,
        {n("coalesce(sum(coalesce(delay_minutes, 0)) filter (event_type = 'DELIVERED'), 0)", 'total_delay_minutes')},
        count(*) filter (event_type = 'DELIVERED' and coalesce(delay_minutes, 0) <= 0) as on_time_count,
        count(*) filter (event_type = 'FAILED_ATTEMPT') as failed_attempts, {at('max(event_timestamp)', 'last_updated')}
        from deliveries where event_type in ('DELIVERED', 'FAILED_ATTEMPT') group by 1""", "deliveries"))
def x12_deliveries(spark, folder):
    root = scratch_dir(spark, "x12-deliveries")
    counters.keep_delivery_counters(delivery_stream(spark, folder), f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return counters.read_delivery_counters(spark, f"{root}/out")


def fleet_counters(spark: SparkSession, folder: str, label: str) -> str:
    """Fleet counters after several micro-batches, compacted on the way."""
    root = scratch_dir(spark, label)
    stream = in_slices(spark, sample.gps(spark, folder), f"{label}-in", 5)
    counters.keep_fleet_counters(stream, f"{root}/out", f"{root}/checkpoint", tidy=2).awaitTermination()
    return f"{root}/out"


@query("x12_stream_fleet_counters", check(
    f"""select strftime(event_timestamp, '%Y-%m-%d') as event_date, count(*) as total_events,
        count(distinct vehicle_id) as active_vehicles, {at('max(event_timestamp)', 'last_updated')} from gps group by 1""", "gps"))
def x12_fleet(spark, folder):
    return counters.read_fleet_counters(spark, fleet_counters(spark, folder, "x12-fleet")).select(
        "event_date", "total_events", "active_vehicles", "last_updated")


@query("x12_stream_hourly_vehicles", check(
    f"""select {at("date_trunc('hour', event_timestamp)", 'hour')}, count(*) as total_events,
        count(distinct vehicle_id) as active_vehicles, count(*) filter (engine_status = 'ON') as moving_count
        from gps group by 1""", "gps"))
def x12_hours(spark, folder):
    """From the same stored sets as the daily counters: distinct vehicles of any span, pings read once."""
    hourly = counters.read_fleet_counters(spark, fleet_counters(spark, folder, "x12-hours"), by="hour")
    return hourly.select("hour", "total_events", "active_vehicles", "moving_count")


@query("x12_stream_counters_compacted", check(
    f"""select strftime(event_timestamp, '%Y-%m-%d') as event_date,
        count(*) filter (event_type = 'DELIVERED') as total_deliveries,
        count(*) filter (event_type = 'DELIVERED' and coalesce(delay_minutes, 0) <= 0) as on_time_count,
        count(*) filter (event_type = 'FAILED_ATTEMPT') as failed_attempts, true as few_batches
        from deliveries where event_type in ('DELIVERED', 'FAILED_ATTEMPT') group by 1""", "deliveries"))
def x12_compacted(spark, folder):
    """Events in no order of time, so that every micro-batch touches every date; merged every three batches."""
    root = scratch_dir(spark, "x12-compacted")
    stream = in_hashed_slices(spark, sample.deliveries(spark, folder), ("delivery_id",), "x12", 8)
    counters.keep_delivery_counters(stream, f"{root}/out", f"{root}/checkpoint", tidy=3).awaitTermination()
    left = max(len(ids) for ids in compaction.batches(spark, f"{root}/out").values())
    return counters.read_delivery_counters(spark, f"{root}/out").select(
        "event_date", "total_deliveries", "on_time_count", "failed_attempts", F.lit(left <= 3).alias("few_batches"))


@query("x12_stream_positions", check(
    f"""select vehicle_id, event_id, {at('event_timestamp')}, {rd('speed_mph')} from gps
        qualify row_number() over (partition by vehicle_id
            order by event_timestamp desc, processed_at desc, event_id desc) = 1""", "gps"))
def x12_positions(spark, folder):
    root = scratch_dir(spark, "x12-positions")
    counters.keep_positions(gps_stream(spark, folder), f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return counters.read_positions(spark, f"{root}/out").select("vehicle_id", "event_id", "event_timestamp", "speed_mph")


@query("x7_four_streams", check(
    f"""select 'gps' as output, count(*) as records, {rd('sum(speed_mph)', 'total')} from gps
        union all select 'deliveries', count(*), {rd('sum(delay_minutes)', 'total')} from deliveries
        union all select 'hourly_metrics', count(*), {rd('sum(total_events)', 'total')} from fleet_windows
            where window_end <= (select max(event_timestamp) from gps) - interval 1 minute
        union all select 'delivery_kpis', count(*), {rd('sum(total_deliveries)', 'total')} from kpi_windows
            where window_end <= (select max(event_timestamp) from deliveries where event_type = 'DELIVERED') - interval 2 minute""",
    "fleet_windows", "kpi_windows"))
def x7(spark, folder):
    """Four queries side by side, each over several micro-batches: rows and a total of each output."""
    root = scratch_dir(spark, "x7")
    started = job.start(gps_slices(spark, folder, "x7-gps"), delivery_slices(spark, folder, "x7-deliveries"), root, interval=None)
    sinks.wait(spark, started, any_ends=False)
    outputs = {
        "gps": ("processed", "speed_mph", "double"), "deliveries": ("processed", "delay_minutes", "int"),
        "hourly_metrics": ("aggregated", "total_events", "bigint"), "delivery_kpis": ("aggregated", "total_deliveries", "bigint")}
    # the schema is given, since a stream that closed nothing leaves no file to take it from
    totals = [
        spark.read.schema(f"{measure} {kind}").parquet(f"{root}/{layer}/{name}").agg(
            F.lit(name).alias("output"), F.count(F.lit(1)).alias("records"), F.sum(measure).cast("double").alias("total"))
        for name, (layer, measure, kind) in outputs.items()
    ]
    return totals[0].union(totals[1]).union(totals[2]).union(totals[3])


@query("x9_stream_latest_copies", check(
    f"""select event_id, vehicle_id, {at('event_timestamp')}, {at('processed_at')}, {rd('speed_mph')} from gps_latest
        where event_timestamp <= (select max(event_timestamp) from gps) - interval 10 minute""", "gps_latest"))
def x9_latest(spark, folder):
    """The stream twin of w1 for closed time: the copy processed last."""
    kept = windows.latest_copies(gps_slices(spark, folder, "x9-in")).withColumn("event_date", C.event_date("event_timestamp"))
    return finished(spark, kept, "x9-latest").select("event_id", "vehicle_id", "event_timestamp", "processed_at", "speed_mph")


@query("x6_late_rows_corrected", check(
    f"""select {FLEET}, active_vehicles, {rd('median_speed')}, moving_vehicles, idle_vehicles from fleet_windows""", "fleet_windows"))
def x6(spark, folder):
    """Pings of all days arrive in three batches, most of them late: the windows end as those of the batch form, all of them."""
    stream = in_hashed_slices(spark, sample.gps(spark, folder), ("event_id", "processed_at"), "x6", 3)
    root = scratch_dir(spark, "x6")
    corrected.keep_fleet_windows(stream, f"{root}/out", f"{root}/checkpoint", tidy=2).awaitTermination()
    return corrected.read_fleet_windows(spark, f"{root}/out").select(
        *FLEET_COLUMNS, "active_vehicles", "median_speed", "moving_vehicles", "idle_vehicles")


define("nearest_pings", """
    select d.delivery_id, d.event_type, d.vehicle_id, d.event_timestamp, arg_min(p.event_id, (abs(epoch_us(p.event_timestamp)
            - epoch_us(d.event_timestamp)), p.event_timestamp, p.event_id)) as event_id,
        min(abs(epoch_us(p.event_timestamp) - epoch_us(d.event_timestamp))) / 1e6 as gap_seconds
    from deliveries d left join gps_latest p on p.vehicle_id = d.vehicle_id
        and p.event_timestamp between d.event_timestamp - interval 5 minute and d.event_timestamp + interval 5 minute
    group by 1, 2, 3, 4""", "deliveries", "gps_latest")
NEAREST = f"delivery_id, event_type, vehicle_id, {at('event_timestamp')}, event_id, {rd('gap_seconds')}"
NEAREST_COLUMNS = ["delivery_id", "event_type", "vehicle_id", "event_timestamp", "event_id", "gap_seconds"]


@query("j9_nearest_ping", check(f"select {NEAREST} from nearest_pings", "nearest_pings"))
def j9_nearest(spark, folder):
    pings = quality.latest_gps(sample.gps(spark, folder))
    return joins.nearest_pings(sample.deliveries(spark, folder), pings).select(*NEAREST_COLUMNS)


@query("j9_nearest_ping_stream", check(
    f"""select {NEAREST} from nearest_pings where event_timestamp <= least((select max(event_timestamp) from deliveries),
        (select max(event_timestamp) from gps)) - interval 1 hour""", "nearest_pings"))
def j9_stream(spark, folder):
    """Two streams of several batches, up to an hour before the end, when all is closed. Repeated pings change nothing: ids are compared."""
    pings = stage(quality.latest_gps(sample.gps(spark, folder)), "j9-latest")
    made = joins.nearest_pings(delivery_slices(spark, folder, "j9-deliveries"), in_slices(spark, pings, "j9-gps"))
    rows = finished(spark, made.withColumn("event_date", C.event_date("event_timestamp")), "j9")
    ends = [F.lit(df.agg(F.max("event_timestamp")).first()[0]) for df in (sample.deliveries(spark, folder), pings)]
    return rows.where(F.col("event_timestamp") <= F.least(*ends) - F.expr("interval 1 hour")).select(*NEAREST_COLUMNS)


define("engine_trips", """
    select vehicle_id, min(event_timestamp) as start_time, max(event_timestamp) as end_time, count(*) as gps_events
    from (select *, sum(starts) over (partition by vehicle_id order by event_timestamp, event_id) as trip from (
        select *, case when lag(event_id) over v is null or event_timestamp - lag(event_timestamp) over v > interval 30 minute
            or lag(engine_status) over v = 'OFF' then 1 else 0 end as starts
        from gps_latest window v as (partition by vehicle_id order by event_timestamp, event_id)))
    group by vehicle_id, trip""", "gps_latest")


@query("x10_engine_trips_stream", check(
    f"""select vehicle_id, {at('start_time')}, {at('end_time')}, gps_events from engine_trips
        where end_time <= (select max(event_timestamp) from gps) - interval 1 hour""", "engine_trips"))
def x10_engine(spark, folder):
    """The stream twin of w6 for closed trips, up to an hour before the end."""
    pings = quality.latest_gps(sample.gps(spark, folder))
    made = trips.engine_trips(in_slices(spark, pings, "x10-in"))
    # state with timers needs this store; the other streams keep the session's
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    try:
        rows = finished(spark, made.withColumn("event_date", C.event_date("start_time")), "x10-engine").drop("event_date")
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    end = pings.agg(F.max("event_timestamp")).first()[0]
    return rows.where(F.col("end_time") <= F.lit(end) - F.expr("interval 1 hour"))
