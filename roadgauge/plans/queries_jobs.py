"""Registered queries: streams over JSON files, landing, state, lineage, catalog and run metrics."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from roadgauge import schemas as S
from roadgauge.functions import columns as C
from roadgauge.operators import quality
from roadgauge.plans import incremental
from roadgauge.plans.queries_records import landed_gps, wrapped_gps
from roadgauge.plans.registry import at, check, query, rd
from roadgauge.session import scratch_dir
from roadgauge.sinks import state, tables, versioned
from roadgauge.sources import catalog, files, records, sample
from roadgauge.streaming import sinks

FILES = 6


def json_lines(spark: SparkSession, folder: str, label: str) -> str:
    """The wrapped pings as JSON lines in several files, the malformed ones among them."""
    path = scratch_dir(spark, label)
    lines = wrapped_gps(spark, folder).select(F.unbase64("payload").cast("string").alias("value"))
    lines.repartition(FILES, "value").write.text(path)
    return path


def stream(spark: SparkSession, path: str) -> DataFrame:
    """One file per micro-batch."""
    return records.read_stream(spark, "text", {"path": path, "maxFilesPerTrigger": "1"}, S.GPS_EVENT)


@query("s7_streaming_json", check(
    f"""select cast(event_id as varchar) as event_id, vehicle_id, {at('event_timestamp')}, {rd('speed_mph')} from gps
        where event_id % 101 <> 0""", "gps"))
def s7(spark, folder):
    root = scratch_dir(spark, "s7")
    good = records.good(stream(spark, json_lines(spark, folder, "s7-in")), S.GPS_EVENT)
    sinks.to_parquet(sample.event_day(good), f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/out").select("event_id", "vehicle_id", "event_timestamp", "speed_mph")


@query("k7_landing_with_errors", check(
    """select coalesce(cast(strftime(event_timestamp, '%Y-%m-%d') as varchar), 'malformed JSON') as outcome, count(*) as records
        from (select case when event_id % 101 <> 0 then event_timestamp end as event_timestamp from gps) group by 1""", "gps"))
def k7(spark, folder):
    """Good records by day, and bad ones by error, after several micro-batches."""
    root = scratch_dir(spark, "k7")
    parsed = stream(spark, json_lines(spark, folder, "k7-in"))
    sinks.land(parsed, S.GPS_EVENT, f"{root}/good", f"{root}/bad", f"{root}/checkpoint").awaitTermination()
    good = spark.read.parquet(f"{root}/good").select(F.to_date("event_timestamp").cast("string").alias("outcome"))
    bad = spark.read.parquet(f"{root}/bad").select(F.col("error").alias("outcome"))
    return good.union(bad).groupBy("outcome").agg(F.count(F.lit(1)).alias("records"))


@query("x8_checkpoint_recovery", check(
    "select vehicle_id, count(*) as events from gps where event_id % 101 <> 0 group by 1", "gps"))
def x8(spark, folder):
    """The same query started twice over a growing folder counts every record once."""
    root, path = scratch_dir(spark, "x8"), scratch_dir(spark, "x8-in")
    lines = wrapped_gps(spark, folder).select(F.unbase64("payload").cast("string").alias("value"))
    part = F.pmod(F.xxhash64("value"), F.lit(2))
    for half in (0, 1):
        lines.where(part == half).write.mode("append").text(path)
        good = sample.event_day(records.good(stream(spark, path), S.GPS_EVENT))
        sinks.to_parquet(good, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/out").groupBy("vehicle_id").agg(F.count(F.lit(1)).alias("events"))


@query("s10_explicit_schema", check(
    f"select event_id, vehicle_id, {at('event_timestamp')}, null::double as not_there from gps", "gps"))
def s10(spark, folder):
    """Read with a declared schema: no footers are merged, columns that files lack are null."""
    path = landed_gps(spark, folder)
    schema = sample.gps(spark, folder).select("event_id", "vehicle_id", "event_timestamp").schema.add("not_there", "double")
    return files.scan(spark, path, schema).select("event_id", "vehicle_id", "event_timestamp", "not_there")


@query("s12_first_run_probe", check(
    """select event_date, 'full' as first_run, 'incremental' as second_run, count(*) as records
        from (select strftime(event_timestamp, '%Y-%m-%d') as event_date from gps) group by 1""", "gps"))
def s12(spark, folder):
    """Two runs of a job that loads all if its target is not there yet, and else only what is newer than the target's rows."""
    target, kinds = scratch_dir(spark, "s12"), []
    rows = sample.event_day(sample.gps(spark, folder))
    for end in (datetime(2024, 1, 15), datetime(2100, 1, 1)):
        known = files.exists(spark, target)
        kinds.append("incremental" if known else "full")
        high = files.scan(spark, target).agg(F.max("event_timestamp")).first()[0] if known else datetime(1900, 1, 1)
        tables.write_partitions(
            rows.where((F.col("event_timestamp") > F.lit(high)) & (F.col("event_timestamp") < F.lit(end))).withColumn("run", F.lit(len(kinds))),
            target, ["event_date", "run"])
    return files.scan(spark, target).groupBy(F.col("event_date").cast("string").alias("event_date")).agg(
        F.lit(kinds[0]).alias("first_run"), F.lit(kinds[1]).alias("second_run"), F.count(F.lit(1)).alias("records"))


@query("p15_lineage", check(
    f"select event_id, {at('processed_at')}, '2024-02-01 00:00:00.000000' as loaded_at, 'v7' as version_tag from gps", "gps"))
def p15(spark, folder):
    return C.with_lineage(sample.gps(spark, folder), "loaded_at", datetime(2024, 2, 1), "v7").select(
        "event_id", "processed_at", "loaded_at", "version_tag")


@query("c1_watermark_state", check(
    f"""select strftime(event_timestamp, '%Y-%m-%d') as event_date, {at('any_value(high)', 'high_watermark')}, count(*) as newer
        from gps, (select max(event_timestamp) as high from gps where event_timestamp < timestamp '2024-01-20 00:00:00')
        where event_timestamp > high group by 1""", "gps"))
def c1(spark, folder):
    """The greatest time of two passes, stored and read back, and what is newer."""
    root = scratch_dir(spark, "c1")
    for end in (datetime(2024, 1, 10), datetime(2024, 1, 20)):
        high = sample.gps(spark, folder).where(F.col("event_timestamp") < F.lit(end)).agg(F.max("event_timestamp")).first()[0]
        state.set_watermark(spark, root, "job", "gps", high, end)
    stored = state.get_watermark(spark, root, "job", "gps")
    newer = sample.event_day(sample.gps(spark, folder).where(F.col("event_timestamp") > F.lit(stored)))
    return newer.groupBy("event_date").agg(F.lit(stored).cast("timestamp").alias("high_watermark"), F.count(F.lit(1)).alias("newer"))


@query("c2_watermark_range", check(
    f"""select event_id, {at('event_timestamp')}, {at('processed_at')} from gps
        where event_timestamp > timestamp '2024-01-10 06:00:00' - interval 1 hour
            and event_timestamp < timestamp '2024-01-12 00:00:00' - interval 5 minute""", "gps"))
def c2(spark, folder):
    """A read by event time between the stored watermark, less an hour for late rows, and the settled end."""
    low, high = state.watermark_range(datetime(2024, 1, 10, 6), datetime(2024, 1, 12), lateness=timedelta(hours=1))
    return files.scan_range(spark, landed_gps(spark, folder), "event_timestamp", low, high).select(
        "event_id", "event_timestamp", "processed_at")


@query("c8_run_metrics", check(
    f"""select 'gps_events' as feed, (select count(*) from gps) as records_processed, count(distinct event_id) as records_stored,
        {at('max(event_timestamp)', 'committed')} from gps""", "gps"))
def c8(spark, folder):
    """What a run reports, beside what its table holds."""
    target = scratch_dir(spark, "c8-out")
    metrics = incremental.run_feed(spark, incremental.GPS, landed_gps(spark, folder), target, datetime(2024, 2, 1))
    return versioned.read(spark, target).agg(
        F.lit("gps_events").alias("feed"), F.lit(metrics["gps_events_records_processed"]).cast("long").alias("records_processed"),
        F.count(F.lit(1)).alias("records_stored"), F.lit(metrics["gps_events_committed"]).cast("timestamp").alias("committed"))


def topic_of(spark, folder, label: str):
    """Pings as a topic's records in files, and a function that reads them as a broker would, up to a bound on the offsets."""
    pings = quality.latest_gps(sample.gps(spark, folder))
    part = F.pmod(F.xxhash64("vehicle_id"), F.lit(3)).cast("int")
    body = F.to_json(F.struct(
        F.col("event_id").cast("string").alias("event_id"), "vehicle_id",
        F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"), "latitude", "longitude", "speed_mph",
        "heading", "fuel_level", "engine_status", "odometer_miles"))
    value = F.when(F.col("event_id") % 101 == 0, F.lit("{broken")).otherwise(body)
    placed = pings.select(F.lit("gps").alias("topic"), part.alias("partition"), value.alias("value"), "event_id")
    number = F.row_number().over(Window.partitionBy("partition").orderBy("event_id")) - 1
    path = scratch_dir(spark, label)
    placed.withColumn("offset", number.cast("long")).drop("event_id").write.parquet(path)

    def load_below(bound: int | None):
        def load(options):
            starts = json.loads(options["startingOffsets"])["gps"] if options["startingOffsets"] != "earliest" else {}
            first = F.coalesce(F.try_element_at(F.create_map(
                *[F.lit(x) for part, start in starts.items() for x in (int(part), start)]), "partition"), F.lit(0)) if starts else F.lit(0)
            rows = spark.read.parquet(path).where(F.col("offset") >= first)
            return rows if bound is None else rows.where(F.col("offset") < bound)

        return load

    return load_below


@query("c6_offset_job", check(
    f"""select cast(event_id as varchar) as event_id, vehicle_id, {at('event_timestamp')}, {rd('speed_mph')},
        (select count(*) from gps_latest) as read_in_all
        from gps_latest where event_id % 101 <> 0""", "gps_latest"))
def c6(spark, folder):
    """Three runs: part of the topic, the rest of it, and nothing new. The offsets that the last one stored tell how much was read."""
    load_below, target = topic_of(spark, folder, "c6-topic"), scratch_dir(spark, "c6-out")
    for bound, now in ((1000, datetime(2024, 2, 1)), (None, datetime(2024, 2, 2)), (None, datetime(2024, 2, 3))):
        done = incremental.run_offsets(spark, incremental.GPS, "", "gps", target, now, S.GPS_EVENT, load_below(bound))
    read = sum(done["gps_events_offsets"]["gps"].values())
    return versioned.read(spark, target).select(
        "event_id", "vehicle_id", "event_timestamp", "speed_mph", F.lit(read).cast("long").alias("read_in_all"))


@query("c9_partition_registration", check(
    """select cast(strftime(event_timestamp, '%Y-%m-%d') as varchar) as event_date, count(*) as events,
            'string' as id_type from gps group by 1""", "gps"))
def c9(spark, folder):
    """Files written outside the catalog are counted through it once their partitions are registered."""
    root, database = scratch_dir(spark, "c9"), "c9_lake"
    spark.sql(f"drop database if exists {database} cascade")
    catalog.create_tables(spark, root, database)
    rows = catalog.conform(sample.event_day(sample.gps(spark, folder)), "fact_gps_events")
    tables.write_event_dates(rows, f"{root}/{catalog.FOLDERS['fact_gps_events']}")
    catalog.repair(spark, f"{database}.fact_gps_events")
    table = spark.table(f"{database}.fact_gps_events")
    kind = table.schema["event_id"].dataType.simpleString()
    return table.groupBy("event_date").agg(F.count(F.lit(1)).alias("events")).withColumn("id_type", F.lit(kind))
