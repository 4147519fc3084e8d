"""Streams over small JSON files, one file per micro-batch."""

import json
import os
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from roadgauge import schemas as S
from roadgauge.functions import columns as C
from roadgauge.operators import reports, rollups
from roadgauge.plans import queries_streams
from roadgauge.session import scratch_dir, stage
from roadgauge.sources import records
from roadgauge.streaming import attempts, counters, panes, sinks, windows

T0 = datetime(2024, 1, 1, 12, 0)


class Feed:
    """A folder that receives one file of JSON lines per call."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema, self.n = spark, path, schema, 0
        path.mkdir()

    def add(self, *rows):
        lines = [r if isinstance(r, str) else json.dumps(r) for r in rows]
        file = self.path / f"{self.n:03d}.json"
        file.write_text("\n".join(lines) + "\n")
        # the file source reads in order of modification time
        os.utime(file, (1_700_000_000 + 10 * self.n,) * 2)
        self.n += 1

    def parsed(self):
        options = {"path": str(self.path), "maxFilesPerTrigger": "1"}
        return records.read_stream(self.spark, "text", options, self.schema)

    def stream(self):
        return records.good(self.parsed(), self.schema)


@pytest.fixture
def gps(spark, tmp_path):
    return Feed(spark, tmp_path / "gps", S.GPS_EVENT)


@pytest.fixture
def deliveries(spark, tmp_path):
    return Feed(spark, tmp_path / "deliveries", S.DELIVERY_EVENT)


def ping(event, minute, vehicle="V1", status="ON", speed=10.0):
    at = (T0 + timedelta(minutes=minute)).isoformat() + "Z"
    return {"event_id": event, "vehicle_id": vehicle, "timestamp": at, "latitude": 1.0, "longitude": 1.0,
            "speed_mph": speed, "heading": 1, "fuel_level": 0.05, "engine_status": status, "odometer_miles": 1.0}


def delivery(delivery_id, minute, status="DELIVERED", delay=0, driver="D1"):
    at = (T0 + timedelta(minutes=minute)).isoformat() + "Z"
    return {"event_id": f"{delivery_id}-{minute}", "delivery_id": delivery_id, "order_id": "O", "vehicle_id": "V1",
            "driver_id": driver, "event_type": status, "timestamp": at, "customer_id": "C",
            "package_weight_lbs": 2.0, "delay_minutes": delay}


def test_landing_keeps_bad_records_and_a_repeat_adds_nothing(spark, gps, tmp_path):
    gps.add(ping("a", 0), "{broken", ping("b", 1))
    gps.add(ping("c", 2), '{"event_id": "d", "timestamp": "never"}')
    out, errors = str(tmp_path / "out"), str(tmp_path / "errors")
    sinks.land(gps.parsed(), S.GPS_EVENT, out, errors, str(tmp_path / "cp")).awaitTermination()
    landed = spark.read.parquet(out)
    assert sorted(r.event_id for r in landed.collect()) == ["a", "b", "c"]
    assert {"year", "month", "day", "batch_id"} <= set(landed.columns)
    assert sorted(r.error for r in spark.read.parquet(errors).collect()) == ["bad timestamp", "malformed JSON"]
    # the same batch again, as after a crash before its commit
    batch = spark.createDataFrame(
        landed.where("batch_id = 0").drop("batch_id").collect(), landed.drop("batch_id").schema)
    sinks.replace_batch(batch, 0, out, ["year", "month", "day"])
    assert spark.read.parquet(out).count() == 3


def test_restart_goes_on_from_the_checkpoint(spark, gps, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    gps.add(ping("a", 0))
    sinks.to_parquet(C.enrich_gps(gps.stream()), out, checkpoint).awaitTermination()
    gps.add(ping("b", 1))
    sinks.to_parquet(C.enrich_gps(gps.stream()), out, checkpoint).awaitTermination()
    rows = spark.read.parquet(out)
    assert sorted(r.event_id for r in rows.collect()) == ["a", "b"] and "event_date" in rows.columns


def test_late_rows_are_dropped_and_counted(spark, gps, tmp_path):
    late = sinks.LateRows()
    spark.streams.addListener(late)
    gps.add(ping("a", 0), ping("b", 2))
    gps.add(ping("c", 30))
    # a batch drops what was late at the end of the batch before the last
    gps.add(ping("d", 31))
    gps.add(ping("late", 1))
    out = str(tmp_path / "out")
    query = sinks.to_parquet(windows.fleet_metrics(gps.stream()), out, str(tmp_path / "cp"))
    query.awaitTermination()
    deadline = time.time() + 20
    while late.of(query) == 0 and time.time() < deadline:  # progress events come from another thread
        time.sleep(0.2)
    spark.streams.removeListener(late)
    assert late.of(query) > 0
    full = [r for r in spark.read.parquet(out).collect() if r.window_start == T0 - timedelta(minutes=2)]
    assert [r.total_events for r in full] == [2] and full[0].critical_fuel_count == 2


def test_stream_windows_equal_exact_batch_windows(spark, gps, tmp_path):
    rows = [ping(str(i), i % 40, f"V{i % 3}", ("ON", "IDLE", "OFF")[i % 3], float(i % 70)) for i in range(200)]
    gps.add(*rows)
    out = str(tmp_path / "out")
    sinks.to_parquet(windows.fleet_metrics(gps.stream()), out, str(tmp_path / "cp")).awaitTermination()
    batch = windows.fleet_metrics_exact(records.good(
        records.parse_json(spark.read.text(str(gps.path)), F.col("value"), S.GPS_EVENT), S.GPS_EVENT))
    closed = batch.where(F.col("window_end") <= T0 + timedelta(minutes=38))
    columns = ["window_start", "window_end", "total_events", "active_vehicles", "median_speed", "moving_events",
               "idle_events", "moving_vehicles", "fleet_utilization_pct", "moving_events_per_vehicle_pct"]
    pick = lambda df: sorted(tuple(r) for r in df.select(*columns).collect())
    assert pick(spark.read.parquet(out)) == pick(closed) != []


def test_windows_across_midnight_stay_whole(spark):
    rows = spark.sql("""select 'V1' vehicle_id, t event_timestamp, 1d speed_mph, 1d fuel_level, 'ON' engine_status
        from values (timestamp '2024-01-01 23:59:00'), (timestamp '2024-01-02 00:01:00') v(t)""")
    for metrics in (windows.fleet_metrics(rows), windows.fleet_metrics_exact(rows)):
        hit = metrics.where("window_start = '2024-01-01 23:58:00'").collect()
        assert [(r.total_events, r.event_date) for r in hit] == [(2, "2024-01-01")]


def test_sliding_delivery_kpis_stream(spark, deliveries, tmp_path):
    deliveries.add(delivery("a", 0, delay=5), delivery("b", 3, delay=0), delivery("x", 3, "RETURNED"), delivery("c", 60))
    out = str(tmp_path / "out")
    sinks.to_parquet(windows.delivery_kpis(deliveries.stream()), out, str(tmp_path / "cp")).awaitTermination()
    row = spark.read.parquet(out).where(F.col("window_start") == T0).first()
    assert (row.total_deliveries, row.on_time_deliveries, row.median_delay, row.p95_delay) == (2, 1, 0, 5)
    assert float(row.on_time_percentage) == 50.0 and float(row.deliveries_per_driver) == 2.0


def test_repeats_within_the_delay_are_dropped(spark, gps, tmp_path):
    gps.add(ping("a", 0), ping("a", 1))
    gps.add(ping("a", 2), ping("b", 3))
    out = str(tmp_path / "out")
    sinks.to_parquet(C.enrich_gps(windows.first_copies(gps.stream())), out, str(tmp_path / "cp")).awaitTermination()
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == ["a", "b"]


def test_session_trips(spark, gps, tmp_path):
    gps.add(ping("a", 0), ping("b", 20), ping("c", 51))
    gps.add(ping("z", 300))
    out = str(tmp_path / "out")
    trips = windows.session_trips(gps.stream()).withColumn("event_date", C.event_date("session_start"))
    sinks.to_parquet(trips, out, str(tmp_path / "cp")).awaitTermination()
    got = sorted((r.session_start, r.gps_events) for r in spark.read.parquet(out).collect())
    assert got == [(T0, 2), (T0 + timedelta(minutes=51), 1)]


def test_route_hours_join_two_windowed_streams(spark, gps, deliveries, tmp_path):
    gps.add(ping("a", 1), ping("b", 2, status="IDLE"), ping("later", 300))
    deliveries.add(delivery("x", 5, delay=4), delivery("y", 6, delay=6), delivery("later", 300))
    out = str(tmp_path / "out")
    joined = windows.route_hours(gps.stream(), deliveries.stream()).withColumn("event_date", C.event_date("window_start"))
    sinks.to_parquet(joined, out, str(tmp_path / "cp")).awaitTermination()
    row = spark.read.parquet(out).first()
    assert (row.vehicle_id, row.gps_events, row.deliveries, row.avg_delay_minutes) == ("V1", 2, 2, 5.0)
    assert float(row.efficiency_score) == 50.0


def test_counters_over_batches_equal_one_batch(spark, deliveries, gps, tmp_path):
    deliveries.add(delivery("a", 0, delay=5), delivery("b", 1, "FAILED_ATTEMPT"))
    deliveries.add(delivery("c", 2, delay=None), delivery("d", 60 * 13, driver=""))
    gps.add(ping("a", 0), ping("b", 1, "V2"))
    gps.add(ping("old", -5, "V1", speed=1.0), ping("c", 5, "V2"))
    path = lambda name: str(tmp_path / name)
    counters.keep_delivery_counters(deliveries.stream(), path("d"), path("d-cp")).awaitTermination()
    counters.keep_driver_counters(deliveries.stream(), path("r"), path("r-cp")).awaitTermination()
    counters.keep_fleet_counters(gps.stream(), path("f"), path("f-cp")).awaitTermination()
    counters.keep_positions(gps.stream(), path("p"), path("p-cp")).awaitTermination()
    counters.keep_alerts(deliveries.stream(), path("a"), path("a-cp")).awaitTermination()
    batch = records.good(records.parse_json(
        spark.read.text(str(deliveries.path)), F.col("value"), S.DELIVERY_EVENT), S.DELIVERY_EVENT)
    pick = lambda df: sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)
    assert pick(counters.read_delivery_counters(spark, path("d"))) == pick(rollups.delivery_counters(batch))
    assert pick(counters.read_driver_counters(spark, path("r"))) == pick(rollups.driver_day_counters(batch))
    fleet = counters.read_fleet_counters(spark, path("f")).first()
    assert (fleet.total_events, fleet.active_vehicles) == (4, 2)
    # the older ping came in the later batch and does not win
    assert {r.vehicle_id: r.event_id for r in counters.read_positions(spark, path("p")).collect()} == {"V1": "a", "V2": "c"}
    assert counters.read_positions(spark, path("p"), T0 + timedelta(hours=24, minutes=1)).count() == 1
    assert spark.read.parquet(path("a")).count() == reports.alerts(batch).count() == 1


def test_attempt_numbers_go_on_over_batches(spark, deliveries, tmp_path):
    deliveries.add(delivery("a", 0, "FAILED_ATTEMPT"), delivery("a", 1, "OUT_FOR_DELIVERY"), delivery("b", 0))
    deliveries.add(delivery("a", 9, "DELIVERED"), delivery("a", 5, "FAILED_ATTEMPT"))
    numbered = attempts.attempt_numbers(deliveries.stream()).withColumn("event_date", C.event_date("event_timestamp"))
    out = str(tmp_path / "out")
    sinks.to_parquet(numbered, out, str(tmp_path / "cp")).awaitTermination()
    got = sorted((r.delivery_id, r.attempt_number, r.event_type) for r in spark.read.parquet(out).collect())
    assert got == [("a", 1, "FAILED_ATTEMPT"), ("a", 2, "FAILED_ATTEMPT"), ("a", 3, "DELIVERED"), ("b", 1, "DELIVERED")]


def test_console_and_failing_query(spark, gps, tmp_path):
    gps.add(ping("a", 0))
    sinks.to_console(windows.fleet_metrics(gps.stream()), "debug_metrics").awaitTermination()

    def broken(batch, number):
        raise RuntimeError("sink down")

    query = sinks.by_batch(gps.stream(), broken, str(tmp_path / "cp"))
    with pytest.raises(Exception, match="sink down"):
        sinks.wait(spark, [query], any_ends=False)


def test_stream_that_closes_nothing_gives_no_rows(spark, gps):
    gps.add(ping(1, 0), ping(2, 10))
    trips = windows.session_trips(gps.stream()).withColumn("event_date", C.event_date("session_start"))
    made = queries_streams.finished(spark, trips, "open-session")
    assert made.columns == ["vehicle_id", "session_start", "session_end", "gps_events", "event_date"] and made.collect() == []


@pytest.mark.parametrize("parts", [1, 3])
def test_slices_of_several_files_are_one_micro_batch_each(spark, monkeypatch, parts):
    # the second of four slices of time has one row, the third none, and no task but one has a row of the first
    minutes = [0, 1, 2, 90, *range(240, 300)]
    rows = spark.createDataFrame([(i, T0 + timedelta(minutes=m)) for i, m in enumerate(minutes)], "n long, event_timestamp timestamp")
    monkeypatch.setattr(queries_streams, "stored_parts", lambda *_: (stage(rows.repartitionByRange(6, "n"), "six"), parts))
    seen = {}
    stream = queries_streams.in_slices(spark, rows, "several", 4)
    sinks.by_batch(stream, lambda df, i: seen.update({i: sorted(r.n for r in df.collect())}), scratch_dir(spark, "cp")).awaitTermination()
    assert [seen[i] for i in sorted(seen)] == [[0, 1, 2], [3], [], list(range(4, 64))]


def test_stored_rows_are_read_in_parts(spark, monkeypatch):
    rows = spark.range(20000).repartition(8)
    assert queries_streams.stored_parts(spark, rows, "parts")[1] == 1
    monkeypatch.setattr(queries_streams, "PART_BYTES", 20000)
    assert queries_streams.stored_parts(spark, rows, "parts")[1] > 3


def test_sketched_kpis_are_compared_with_the_exact_ones(spark):
    rows = [(f"d{i}", "DELIVERED", T0 + timedelta(seconds=i), i % 90 - 10 if i % 7 else None, f"D{i % 40}", f"V{i % 30}", 1.0) for i in range(280)]
    rows += [("late", "DELIVERED", T0 + timedelta(hours=2), None, "D1", "V1", 1.0)]
    done = spark.createDataFrame(
        rows, "delivery_id string, event_type string, event_timestamp timestamp, delay_minutes int, driver_id string, vehicle_id string,"
        " package_weight_lbs double")
    own = panes.delivery_windows(panes.delivery_panes(done))
    assert {r.sketches_within_bound for r in queries_streams.beside_exact(own, done).collect()} == {True}
    for name, wrong in (("p95_delay", F.lit(20)), ("median_delay", F.lit(79)), ("active_drivers", F.lit(90))):
        made = queries_streams.beside_exact(own.withColumn(name, wrong.cast("bigint")), done)
        assert made.columns == [*own.columns, "sketches_within_bound"] and not any(r.sketches_within_bound for r in made.collect()), name
