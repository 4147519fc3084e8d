"""Sliced windows must equal plain ones, also with one very busy key and empty stretches."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window, functions as F

from roadgauge.operators import quality, timeline, trips
from roadgauge.plans import catalogue
from roadgauge.sources import sample
from tests.conftest import plan


@pytest.fixture(scope="module")
def pings(spark):
    rng = random.Random(4)
    rows = []
    for i in range(3000):
        key = "HOT" if rng.random() < 0.4 else f"V{rng.randrange(20)}"
        at = datetime(2024, 1, 1) + timedelta(minutes=rng.randrange(60 * 24 * 5))
        if rng.random() < 0.2:
            at = at.replace(minute=0)
        rows.append((key, at, i, rng.choice([None, "a", "b"]), rng.randrange(5)))
    return spark.createDataFrame(rows, "k string, t timestamp, i int, s string, n int").repartition(5)


def same(a, b):
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


PLAIN = dict(key="k", order=["t", "i"])


def window():
    return Window.partitionBy("k").orderBy("t", "i")


@pytest.mark.parametrize("unit", ["hour", "day", "month"])
def test_previous_and_next(spark, pings, unit):
    got = timeline.with_previous(pings, columns=["s"], unit=unit, **PLAIN)
    same(got.select("i", "previous.t", "previous.s"), pings.select("i", F.lag("t").over(window()), F.lag("s").over(window())))
    got = timeline.with_next(pings, columns=["s"], unit=unit, **PLAIN)
    same(got.select("i", "following.t", "following.s"), pings.select("i", F.lead("t").over(window()), F.lead("s").over(window())))


def test_running_total(spark, pings):
    got = timeline.with_running_total(pings, value=F.col("n"), name="total", **PLAIN)
    upto = window().rowsBetween(Window.unboundedPreceding, 0)
    same(got.select("i", "total"), pings.select("i", F.sum("n").over(upto)))


def test_last_known(spark, pings):
    got = timeline.with_last_known(pings, column="s", name="last", **PLAIN)
    upto = window().rowsBetween(Window.unboundedPreceding, 0)
    same(got.select("i", "last"), pings.select("i", F.last("s", ignorenulls=True).over(upto)))


def test_several_keys(spark, pings):
    two = pings.withColumn("j", F.col("i") % 2)
    got = timeline.with_previous(two, ["k", "j"], ["t", "i"], [])
    w = Window.partitionBy("k", "j").orderBy("t", "i")
    same(got.select("i", "previous.t"), two.select("i", F.lag("t").over(w)))


def test_rows_are_shuffled_by_key_and_slice(spark, pings):
    text = plan(timeline.with_previous(pings, columns=["s"], **PLAIN))
    assert "hashpartitioning(_key" in text and "_slice" in text


def test_null_keys_belong_together(spark, pings):
    some = pings.withColumn("k", F.when(F.col("k") == "HOT", None).otherwise(F.col("k")))
    upto = window().rowsBetween(Window.unboundedPreceding, 0)
    same(timeline.with_running_total(some, value=F.lit(1), name="total", **PLAIN).select("i", "total"),
         some.select("i", F.sum(F.lit(1)).over(upto)))
    same(timeline.with_previous(some, columns=["s"], **PLAIN).select("i", "previous.i"), some.select("i", F.lag("i").over(window())))
    same(timeline.with_next(some, columns=["s"], **PLAIN).select("i", "following.i"), some.select("i", F.lead("i").over(window())))
    same(timeline.with_last_known(some, column="s", name="last", **PLAIN).select("i", "last"),
         some.select("i", F.last("s", ignorenulls=True).over(upto)))


def test_driver_as_of_equals_brute_force(spark):
    rng = random.Random(9)
    start = datetime(2024, 1, 1)
    when = lambda: start + timedelta(minutes=rng.randrange(600))
    stops = [(rng.choice("AB"), when(), f"D{rng.randrange(9)}") for _ in range(120)]
    pings = [(i, rng.choice("AABC"), when()) for i in range(300)]
    got = timeline.with_driver_as_of(
        spark.createDataFrame(pings, "event_id int, vehicle_id string, event_timestamp timestamp"),
        spark.createDataFrame(stops, "vehicle_id string, event_timestamp timestamp, driver_id string"))
    expected = {
        i: max(((t, d) for v, t, d in stops if v == vehicle and t <= at), default=(None, None))[1]
        for i, vehicle, at in pings}
    assert {r.event_id: r.driver_id for r in got.collect()} == expected


GPS = """event_id int, vehicle_id string, event_timestamp timestamp, latitude double, longitude double, speed_mph double,
    fuel_level double, engine_status string, odometer_miles double"""


def ping(i, minute, status="ON", fuel=0.5, odometer=0.0):
    return (i, "V1", datetime(2024, 1, 1, 23, 0) + timedelta(minutes=minute), 1.0, 1.0, 10.0, fuel, status, odometer)


def test_trips_split_at_gap_and_after_engine_off(spark):
    gps = spark.createDataFrame([
        ping(1, 0), ping(2, 30), ping(3, 61), ping(4, 62, "OFF"), ping(5, 63), ping(6, 64, "IDLE")], GPS)
    got = {r.event_id: r.trip_number for r in trips.with_trip_id(gps).collect()}
    # exactly 30 minutes is no gap; 31 is; the OFF ping ends its trip
    assert got == {1: 1, 2: 1, 3: 2, 4: 2, 5: 3, 6: 3}


def test_refuelling_is_not_consumption(spark):
    gps = spark.createDataFrame([
        ping(1, 0, fuel=0.5), ping(2, 5, fuel=0.25), ping(3, 10, fuel=1.0), ping(4, 15, fuel=0.75, odometer=10.0)], GPS)
    trip = trips.trips(gps).first()
    assert trip.gallons == pytest.approx(10.0) and trip.distance_miles == 10.0
    assert trip.fuel_cost == pytest.approx(35.0) and trip.cost_per_mile == pytest.approx(3.5)


def test_idle_minutes_count_for_the_day_they_started(spark):
    gps = spark.createDataFrame([ping(1, 50, "ON"), ping(2, 55, "IDLE"), ping(3, 70, "ON")], GPS)
    got = {r.date_key: (r.idle_minutes, r.stop_count) for r in trips.idle_days(gps).collect()}
    assert got == {20240101: (15.0, 1), 20240102: (0.0, 0)}


def test_attempts_count_final_statuses_in_order(spark):
    day = datetime(2024, 1, 1)
    rows = [("D1", "FAILED_ATTEMPT", day), ("D1", "OUT_FOR_DELIVERY", day + timedelta(hours=1)),
            ("D1", "FAILED_ATTEMPT", day + timedelta(days=1)), ("D1", "DELIVERED", day + timedelta(days=2)),
            ("D2", "DELIVERED", day)]
    events = spark.createDataFrame(rows, "delivery_id string, event_type string, event_timestamp timestamp")
    got = trips.attempt_numbers(events, ["event_timestamp", "event_type"]).collect()
    assert sorted((r.delivery_id, r.attempt_number, r.event_type) for r in got) == [
        ("D1", 1, "FAILED_ATTEMPT"), ("D1", 2, "FAILED_ATTEMPT"), ("D1", 3, "DELIVERED"), ("D2", 1, "DELIVERED")]


@pytest.mark.parametrize("name", ["w5_attempts_on_facts", "w5_attempt_numbers"])
def test_attempts_go_to_more_tasks_as_the_feed_grows(spark, tmp_path, monkeypatch, name):
    lines = [(k, k % 50, k % 7, n, 1.0, 1.0, 0.1, "R" if k % 3 else "N", "F" if n % 2 else "O")
             for k in range(300) for n in (1, 1, 2)] + [(None, 1, 1, 1, 1.0, 1.0, 0.1, "R", "F"), (5, 1, 1, None, 1.0, 1.0, 0.1, "R", "F")]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,"
                          " l_extendedprice double, l_discount double, l_returnflag string, l_linestatus string"
                          ).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(k, k % 20) for k in range(290)] + [(7, 1)], "o_orderkey long, o_custkey long"
                          ).write.parquet(str(tmp_path / "orders.parquet"))
    # once as small beside what a task takes, once as large
    monkeypatch.setattr(sample, "TASK_ROWS", 1000, raising=False)
    small = catalogue.QUERIES[name](spark, str(tmp_path))
    monkeypatch.setattr(sample, "TASK_ROWS", 20, raising=False)
    large = catalogue.QUERIES[name](spark, str(tmp_path))
    held = [len(rows) for rows in large.rdd.glom().collect()]
    assert len(held) == -(-902 // 20) and max(held) < 60
    rows = sorted(map(str, large.collect()))
    assert rows == sorted(map(str, small.collect()))
    # every ended event of an order once; order 7 is there twice
    ended = [k for k, *_, flag, status in lines if k is not None and k < 290 and not (flag == "N" and status == "F")]
    assert len(rows) == len(ended) + ended.count(7)


def test_lifecycle_violations(spark):
    day = datetime(2024, 1, 1)
    path = ["ORDER_PLACED", "ORDER_CONFIRMED", "PICKED_UP", "IN_TRANSIT", "OUT_FOR_DELIVERY", "FAILED_ATTEMPT",
            "OUT_FOR_DELIVERY", "DELIVERED"]
    rows = [("OK", s, day + timedelta(hours=i)) for i, s in enumerate(path)]
    rows += [("BAD", "DELIVERED", day), ("BAD", "IN_TRANSIT", day + timedelta(hours=30))]
    events = spark.createDataFrame(rows, "delivery_id string, event_type string, event_timestamp timestamp")
    got = quality.lifecycle_violations(events).collect()
    assert [(r.delivery_id, r.previous_status, r.event_type) for r in got] == [("BAD", "DELIVERED", "IN_TRANSIT")]
