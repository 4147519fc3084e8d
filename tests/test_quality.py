from datetime import datetime

import pytest
from pyspark.sql import functions as F

from roadgauge.operators import quality, reports, rollups
from tests.conftest import plan

GPS = """event_id string, vehicle_id string, event_timestamp timestamp, processed_at timestamp, latitude double,
    longitude double, speed_mph double, fuel_level double, engine_status string"""


def ping(event, speed, minute=0, lat=1.0, vehicle="V1"):
    return (event, vehicle, datetime(2024, 1, 1), datetime(2024, 1, 1, 0, minute), lat, 1.0, speed, 0.5, "ON")


def test_gate_after_dedup_does_not_bring_back_an_older_copy(spark):
    rows = spark.createDataFrame([ping("a", 10.0, 0), ping("a", -1.0, 5), ping("b", 1.0)], GPS)
    assert [r.event_id for r in quality.clean_gps(rows).collect()] == ["b"]
    rejects = quality.gps_rejects(rows).collect()
    assert [(r.event_id, r.reject_reason) for r in rejects] == [("a", "speed")]


def test_equal_copies_resolve_the_same_way_in_any_order(spark):
    rows = [ping("a", float(s)) for s in range(20)]
    kept = {
        quality.latest_gps(spark.createDataFrame(order, GPS).repartition(n)).first().speed_mph
        for n, order in ((1, rows), (3, rows[::-1]), (7, rows[5:] + rows[:5]))}
    assert kept == {19.0}


def test_copies_of_one_key_are_reduced_before_the_shuffle(spark):
    hot = spark.range(100_000).select(
        # no literal, which the optimizer would take out of the key
        F.when(F.col("id") >= 0, "same").alias("event_id"), F.lit("V").alias("vehicle_id"),
        F.timestamp_seconds("id").alias("processed_at"), F.timestamp_seconds(F.lit(0)).alias("event_timestamp"))
    kept = quality.latest_gps(hot)
    text = plan(kept)
    assert text.count("WindowGroupLimit") >= 2 and "Partial" in text
    assert kept.count() == 1 and kept.first().processed_at == datetime(1970, 1, 2, 3, 46, 39)


DELIVERY = """delivery_id string, event_type string, event_timestamp timestamp, vehicle_id string, driver_id string,
    package_weight_lbs double, delay_minutes int"""


def event(status, minute, delay=0, driver="D1", delivery="X"):
    return (delivery, status, datetime(2024, 1, 1, 0, minute), "V1", driver, 1.0, delay)


def test_clean_deliveries_keep_one_row_per_delivery_and_final_status(spark):
    rows = spark.createDataFrame([
        event("IN_TRANSIT", 1), event("FAILED_ATTEMPT", 2), event("FAILED_ATTEMPT", 3, 5), event("DELIVERED", 9, None)], DELIVERY)
    got = sorted((r.event_type, r.delay_minutes, r.is_on_time, r.is_successful) for r in quality.clean_deliveries(rows).collect())
    assert got == [("DELIVERED", None, None, True), ("FAILED_ATTEMPT", 5, False, False)]


def test_day_without_deliveries_has_null_ratios(spark):
    gps = quality.clean_gps(spark.createDataFrame([ping("a", 1.0)], GPS))
    none = quality.clean_deliveries(spark.createDataFrame([], DELIVERY))
    for exact in (True, False):
        row = rollups.daily_summary(gps, none, exact).first()
        assert row.total_gps_events == 1 and row.total_deliveries is None and row.on_time_delivery_pct is None


def test_availability_and_requirements(spark):
    gps = spark.createDataFrame([ping("a", 1.0)], GPS).withColumn("event_date", F.lit("2024-01-01"))
    none = spark.createDataFrame([], DELIVERY).withColumn("event_date", F.lit(""))
    assert [r.is_available for r in quality.daily_availability(gps, none).collect()] == [False]
    quality.require_available({"gps": gps}, "2024-01-01")
    with pytest.raises(ValueError, match="deliveries"):
        quality.require_available({"gps": gps, "deliveries": none}, "2024-01-01")
    with pytest.raises(ValueError, match="daily aggregate"):
        quality.require_output(gps, spark.sql("select 1 date_key"), "2024-01-01")


def test_event_can_raise_two_alerts(spark):
    rows = spark.createDataFrame([event("FAILED_ATTEMPT", 1, 31), event("DELIVERED", 2, 30)], DELIVERY).withColumns({
        "order_id": F.lit("O"), "customer_id": F.lit("C")})
    got = reports.alerts(rows).collect()
    assert sorted(r.alert_type for r in got) == ["DELAY", "FAILED_ATTEMPT"]
    assert any("delayed by 31 minutes" in r.message for r in got)


def test_latest_per_key_takes_event_time_not_arrival(spark):
    rows = spark.createDataFrame([ping("new", 1.0, 1), ping("old", 2.0, 9)], GPS).withColumn(
        "event_timestamp", F.when(F.col("event_id") == "new", F.lit(datetime(2024, 1, 2))).otherwise(F.col("event_timestamp")))
    assert reports.latest_positions(rows).first().event_id == "new"
    assert reports.unexpired(reports.latest_positions(rows), datetime(2024, 1, 3), 24).count() == 0


def test_top_k_has_a_total_order_and_no_full_sort(spark):
    rows = spark.createDataFrame([ping(str(i), 1.0, vehicle=f"V{i}") for i in range(20)], GPS)
    top = rollups.top_vehicles(rows, 3)
    assert [r.vehicle_id for r in top.collect()] == ["V0", "V1", "V10"]
    assert "TakeOrderedAndProject" in plan(top)


def test_change_against_previous_period(spark):
    daily = spark.sql("select * from values (1, 10), (2, 15), (3, 0), (4, 5) t(d, v)")
    got = [tuple(r) for r in rollups.period_change(daily, "d", ["v"]).orderBy("d").collect()]
    assert got == [(1, 10, None, None), (2, 15, 5, 50.0), (3, 0, -15, -100.0), (4, 5, 5, None)]
