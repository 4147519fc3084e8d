"""Corrected windows, interval joins, latest copies in streams, places and key lookup over many versions."""

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from roadgauge.functions import columns as C
from roadgauge.operators import dims, places, trips
from roadgauge.streaming import attempts, corrected, joins, sinks, trips as live_trips, windows
from tests.conftest import plan

T0 = datetime(2024, 1, 1, 12)
PING = ("event_id long, vehicle_id string, event_timestamp timestamp, processed_at timestamp, latitude double, longitude double,"
        " speed_mph double, fuel_level double, engine_status string")


def at(minutes):
    return T0 + timedelta(minutes=minutes)


def ping(event, minute, vehicle="V1", speed=10.0, later=0):
    return (event, vehicle, at(minute), at(minute) + timedelta(seconds=later), 40.0, -75.0, speed, 0.5, "ON")


def stream(spark, path, schema, *batches):
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(path))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(path))


def test_late_rows_replace_closed_windows(spark, tmp_path):
    batches = [[ping(1, 0), ping(2, 3, "V2", 30.0)], [ping(3, 60, "V3")], [ping(4, 1, "V4", 50.0), ping(5, 61)], [ping(6, 2, "V4", 70.0)]]
    rows = stream(spark, tmp_path / "in", PING, *batches)
    corrected.keep_fleet_windows(rows, str(tmp_path / "out"), str(tmp_path / "cp"), tidy=2).awaitTermination()
    names = ["window_start", "window_end", "total_events", "active_vehicles", "moving_vehicles", "avg_speed", "median_speed"]
    made = corrected.read_fleet_windows(spark, str(tmp_path / "out")).select(*names).collect()
    batch = windows.fleet_metrics_exact(spark.createDataFrame([r for b in batches for r in b], PING)).select(*names).collect()
    assert sorted(made) == sorted(batch)
    late = corrected.read_late(spark, str(tmp_path / "out"))
    assert sorted((r.event_id, r.batch_id) for r in late.collect()) == [(4, 2), (6, 3)]


def test_latest_copy_comes_out_once_its_time_has_passed(spark, tmp_path):
    batches = [[ping(1, 0, speed=1.0), ping(2, 1)], [ping(1, 0, speed=2.0, later=60), ping(3, 5)], [ping(1, 0, speed=3.0, later=30), ping(4, 60)]]
    kept = windows.latest_copies(stream(spark, tmp_path / "in", PING, *batches))
    out = str(tmp_path / "out")
    query = sinks.to_parquet(kept.withColumn("event_date", C.event_date("event_timestamp")), out, str(tmp_path / "cp"))
    query.awaitTermination()
    assert sorted((r.event_id, r.speed_mph) for r in spark.read.parquet(out).collect()) == [(1, 2.0), (2, 10.0), (3, 10.0)]
    # what is left is the one ping whose time is not closed
    assert query.lastProgress.stateOperators[0].numRowsTotal == 1


def test_nearest_ping_of_a_stream_and_of_tables(spark, tmp_path):
    rng = random.Random(5)
    event = "delivery_id string, event_type string, vehicle_id string, event_timestamp timestamp"
    pings = [ping(i, i * 2 + rng.random(), f"V{rng.randint(1, 3)}") for i in range(120)]
    events = [(f"D{i}", "DELIVERED", f"V{rng.randint(1, 4)}", at(i * 4 + rng.random())) for i in range(55)]

    def brute(e):
        near = [(abs(p[2] - e[3]), p[2], p[0]) for p in pings if p[1] == e[2] and abs(p[2] - e[3]) <= timedelta(minutes=5)]
        return e[0], min(near)[2] if near else None

    tables = joins.nearest_pings(spark.createDataFrame(events, event), spark.createDataFrame(pings, PING))
    assert sorted((r.delivery_id, r.event_id) for r in tables.collect()) == sorted(map(brute, events))
    left = stream(spark, tmp_path / "d", event, events[:20], events[20:40], events[40:])
    right = stream(spark, tmp_path / "p", PING, pings[:40], pings[40:80], pings[80:])
    out = str(tmp_path / "out")
    made = joins.nearest_pings(left, right).withColumn("event_date", C.event_date("event_timestamp"))
    sinks.to_parquet(made, out, str(tmp_path / "cp")).awaitTermination()
    got = sorted((r.delivery_id, r.event_id) for r in spark.read.parquet(out).collect())
    closed = sorted(brute(e) for e in events if e[3] < at(200))
    assert set(closed) <= set(got) <= set(map(brute, events)) and any(x is None for _, x in closed)


def test_near_places_equals_all_pairs(spark):
    rng = random.Random(2)
    spots = [(i, rng.choice([0.0, 40.0, 70.0, -89.0]) + rng.uniform(-1, 1), rng.uniform(-180, 180)) for i in range(400)]
    points = [(i, min(max(lat + rng.uniform(-0.3, 0.3), -90.0), 90.0), lon + rng.uniform(-0.5, 0.5)) for i, lat, lon in spots] + [(999, None, None)]
    given = spark.createDataFrame(points, "id int, latitude double, longitude double")
    known = spark.createDataFrame(spots, "place_id int, latitude double, longitude double")

    def brute(p):
        if p[1] is None:
            return p[0], None
        far = [(math.hypot((s[1] - p[1]) * 69, (s[2] - p[2]) * 69 * math.cos(math.radians(s[1]))), s[0]) for s in spots]
        best = min(far)
        return p[0], best[1] if best[0] <= 15 else None

    made = places.near_places(given, known, ["id"], 15.0)
    assert sorted((r.id, r.place_id) for r in made.collect()) == sorted(map(brute, points))
    assert "CartesianProduct" not in plan(made) and "NestedLoop" not in plan(made)


def test_stays(spark):
    rows = [(1, "V1", at(0), 40.0, -75.0), (2, "V1", at(4), 40.001, -75.0), (3, "V1", at(8), 40.002, -75.0), (4, "V1", at(9), 41.0, -75.0),
            (5, "V1", at(11), 41.0, -75.0), (6, "V1", at(20), None, None), (7, "V1", at(22), 41.0, -75.0), (8, "V1", at(30), 41.0, -75.0)]
    pings = spark.createDataFrame(rows, "event_id long, vehicle_id string, event_timestamp timestamp, latitude double, longitude double")
    made = sorted((r.start_time, r.end_time, r.pings) for r in places.stays(pings).collect())
    assert made == [(at(0), at(8), 3), (at(22), at(30), 2)]


def test_key_with_thousands_of_versions_meets_each_fact_once(spark):
    day = lambda n: datetime(2020, 1, 1) + timedelta(days=n)
    versions = [("k", i, day(i), day(i + 1) if i < 2999 else None) for i in range(3000) if i != 1000] + [("other", 7, day(5), day(6))]
    dim = spark.createDataFrame(versions, "k string, number int, effective_start timestamp, effective_end timestamp")
    facts = spark.createDataFrame(
        [("k", day(i) + timedelta(hours=i % 24), i) for i in range(-2, 3005)] + [("other", day(6), -5), (None, day(9), -6), ("k", None, -7)],
        "k string, event_timestamp timestamp, n int")
    made = {r.n: r.number for r in dims.lookup_key(facts, dim, "k", "number").collect()}
    want = {i: None if i < 0 or i == 1000 else min(i, 2999) for i in range(-2, 3005)} | {-5: None, -6: None, -7: None}
    assert made == want
    # the joins are those that carry a value over a slice's border, on key and slice
    assert "effective_start" not in plan(dims.lookup_key(facts, dim, "k", "number")).split("Join")[1].split("\n")[0]


def test_trips_split_by_engine_and_pause_equal_the_batch_form(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, f"V{rng.randint(1, 3)}", at(i * 1.5 + rng.random()), at(0), 40.0, -75.0, 1.0, 0.5, rng.choice(["ON", "ON", "ON", "IDLE", "OFF"]))
            for i in range(60)] + [(100 + i, "V1", at(150 + 20 * i), at(0), 40.0, -75.0, 1.0, 0.5, "ON") for i in range(4)]
    rows += [(200, "V2", at(600), at(0), 40.0, -75.0, 1.0, 0.5, "ON")]
    late_in_batch = rows[:20] + rows[21:30], [rows[20], *rows[30:]][:30], [rows[20], *rows[30:]][30:]
    made = live_trips.engine_trips(stream(spark, tmp_path / "in", PING, *late_in_batch), delay="20 minutes")
    out = str(tmp_path / "out")
    query = sinks.to_parquet(made.withColumn("event_date", C.event_date("start_time")), out, str(tmp_path / "cp"))
    query.awaitTermination()
    odometer = spark.createDataFrame(rows, PING).withColumn("odometer_miles", F.lit(1.0))
    batch = trips.trips(odometer).select("vehicle_id", "start_time", "end_time", "gps_events")
    closed = sorted(tuple(r) for r in batch.collect() if r.end_time < at(500))
    got = sorted(tuple(r) for r in spark.read.parquet(out).select(*batch.columns).collect())
    assert got == closed and len(closed) > 10


def test_attempt_counters_end_in_event_time(spark, tmp_path):
    event = "delivery_id string, event_type string, event_timestamp timestamp"
    day = lambda n: T0 + timedelta(days=n)
    batches = [[("a", "FAILED_ATTEMPT", day(0)), ("b", "FAILED_ATTEMPT", day(1))], [("a", "FAILED_ATTEMPT", day(2)), ("b", "DELIVERED", day(9))],
               [("z", "DELIVERED", day(20))], [("a", "DELIVERED", day(20)), ("z", "RETURNED", day(40))]]
    numbered = attempts.attempt_numbers(stream(spark, tmp_path / "in", event, *batches), close_after_days=7)
    out = str(tmp_path / "out")
    query = sinks.to_parquet(numbered.withColumn("event_date", C.event_date("event_timestamp")), out, str(tmp_path / "cp"))
    query.awaitTermination()
    got = sorted((r.delivery_id, r.event_timestamp, r.attempt_number) for r in spark.read.parquet(out).collect())
    # the counter of a has ended before day 20; b's has not on day 9, and z's not when day 40 comes, as the watermark is at day 20
    assert got == [("a", day(0), 1), ("a", day(2), 2), ("a", day(20), 1), ("b", day(1), 1), ("b", day(9), 2), ("z", day(20), 1), ("z", day(40), 2)]


def test_nearest_pings_meet_no_whole_vehicle(spark):
    rng = random.Random(11)
    event = "delivery_id string, event_type string, vehicle_id string, event_timestamp timestamp"
    places_of = [None, "V1", "V1", "V1", "V2"]
    pings = [ping(i % 280, rng.randint(0, 400) / 2, rng.choice(places_of), float(i % 3)) for i in range(300)]
    pings += [(900, "V1", None, at(0), 40.0, -75.0, 1.0, 0.5, "ON"), (None, "V1", at(10), at(0), 40.0, -75.0, 1.0, 0.5, "ON")]
    events = [(f"D{i % 250}", "DELIVERED", rng.choice(places_of), at(rng.randint(-20, 440) / 2)) for i in range(300)]
    events += [("D900", "DELIVERED", "V1", None), ("D900", "DELIVERED", None, None), (None, None, "V2", at(3)), events[0], events[0]]
    left, right = spark.createDataFrame(events, event), spark.createDataFrame(pings, PING)

    def brute(e):
        near = [(abs(p[2] - e[3]), p[2], p[0] is not None, p[0] or 0) for p in pings if e[2] and e[3] and p[1] == e[2] and p[2] and abs(p[2] - e[3]) <= timedelta(minutes=5)]
        best = min(near) if near else None
        return (*map(str, e), None if best is None else (best[0].total_seconds(), best[1], best[3] if best[2] else None))

    tables, streams = joins.nearest_pings(left, right), joins._joined_streams(left, right, 300).select(
        *joins.EVENT, (F.col("ping.gap") / 1e6).alias("gap_seconds"), F.timestamp_micros("ping._micros").alias("ping_timestamp"), "ping.event_id")
    for made in (tables, streams):
        got = [(str(r.delivery_id), str(r.event_type), str(r.vehicle_id), str(r.event_timestamp),
                None if r.gap_seconds is None else (r.gap_seconds, r.ping_timestamp, r.event_id)) for r in made.collect()]
        assert sorted(got, key=str) == sorted(set(map(brute, events)), key=str)
    assert "Join" not in plan(tables)
    keys = next(line for line in plan(streams).splitlines() if "Join" in line)
    assert "_cell" in keys.split("]")[0]


def test_nearest_pings_of_a_stream_keep_a_row_of_state_per_vehicle_and_cell(spark, tmp_path):
    rng = random.Random(3)
    event = "delivery_id string, event_type string, vehicle_id string, event_timestamp timestamp"
    events = [(f"D{i}", "DELIVERED", f"V{i % 3}", at(rng.uniform(0, 28))) for i in range(300)]
    pings = [ping(i, rng.uniform(0, 28), f"V{i % 2}") for i in range(80)]
    # the second batches repeat rows and bring some that are late by less than the delay
    far = [("F", "DELIVERED", "V1", at(300))], [ping(900, 300)]
    left = stream(spark, tmp_path / "d", event, events[:200], events[200:] + events[:20] + [("N", "DELIVERED", None, at(27.5))], far[0])
    right = stream(spark, tmp_path / "p", PING, pings[:50], pings[50:] + pings[:5], far[1])
    out = str(tmp_path / "out")
    made = joins.nearest_pings(left, right).withColumn("event_date", C.event_date("event_timestamp"))
    query = sinks.to_parquet(made, out, str(tmp_path / "cp"))
    query.awaitTermination()
    columns = ["delivery_id", "vehicle_id", "event_timestamp", "event_id", "gap_seconds"]
    tables = joins.nearest_pings(spark.createDataFrame(events + [("N", "DELIVERED", None, at(27.5))], event), spark.createDataFrame(pings, PING))
    assert sorted(map(str, spark.read.parquet(out).select(columns).collect())) == sorted(map(str, tables.select(columns).collect()))
    # three vehicles and the null one in three cells, pings of two in two cells more: before, a row per event and ping
    assert max(operator.numRowsUpdated for p in query.recentProgress for operator in p.stateOperators) <= 24
