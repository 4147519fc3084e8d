from datetime import datetime

import pytest
from pyspark.sql import functions as F

from roadgauge.functions import columns as C


def values(spark, kind, column, items):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(column).collect()]


def test_speed_limits(spark):
    assert values(spark, "double", C.speed_category("v"), [0.0, 24.9, 25.0, 44.9, 45.0, 65.0, -1.0, None]) == [
        "STOPPED", "SLOW", "NORMAL", "NORMAL", "FAST", "VERY_FAST", "SLOW", "VERY_FAST"]


def test_fuel_limits(spark):
    assert values(spark, "double", C.fuel_status("v"), [0.0999, 0.1, 0.25, 0.5, 1.0, None]) == [
        "CRITICAL", "LOW", "MEDIUM", "GOOD", "GOOD", "GOOD"]


def test_delay_limits_are_inclusive(spark):
    assert values(spark, "int", C.delay_category("v"), [-1, 0, 1, 15, 16, 30, 31, 60, 61, None]) == [
        "ON_TIME", "ON_TIME", "SLIGHT_DELAY", "SLIGHT_DELAY", "MODERATE_DELAY", "MODERATE_DELAY",
        "SIGNIFICANT_DELAY", "SIGNIFICANT_DELAY", "SEVERE_DELAY", "SEVERE_DELAY"]


def test_weight_limits(spark):
    assert values(spark, "double", C.package_size("v"), [0.9, 1.0, 5.0, 20.0, None]) == [
        "SMALL", "MEDIUM", "LARGE", "EXTRA_LARGE", "EXTRA_LARGE"]


@pytest.mark.parametrize("policy, expected", [
    ("else_branch", ("VERY_FAST", "GOOD", "SEVERE_DELAY", "EXTRA_LARGE")),
    ("default", ("STOPPED", "GOOD", "ON_TIME", "SMALL")),
    ("unknown", ("UNKNOWN",) * 4),
])
def test_null_policies(spark, policy, expected):
    row = spark.range(1).select(F.lit(None).cast("double").alias("v")).select(
        C.speed_category("v", policy), C.fuel_status("v", policy), C.delay_category("v", policy),
        C.package_size("v", policy)).first()
    assert tuple(row) == expected


def test_unknown_policy_is_rejected(spark):
    with pytest.raises(ValueError):
        C.fuel_status("v", "guess")


def test_time_columns(spark):
    stamps = [datetime(2024, 1, 5, 8, 59), datetime(2024, 1, 6, 9, 0), datetime(2024, 1, 7, 17, 59), datetime(2024, 1, 8, 18, 0)]
    rows = spark.createDataFrame([(t,) for t in stamps], "t timestamp").select(
        C.date_key("t"), C.time_key("t"), C.event_date("t"), C.event_hour("t"), C.day_number("t"), C.day_name("t"),
        C.is_weekend("t"), C.is_business_hours("t")).collect()
    assert [tuple(r) for r in rows] == [
        (20240105, 859, "2024-01-05", 8, 6, "Friday", False, False),
        (20240106, 900, "2024-01-06", 9, 7, "Saturday", True, True),
        (20240107, 1759, "2024-01-07", 17, 1, "Sunday", True, True),
        (20240108, 1800, "2024-01-08", 18, 2, "Monday", False, False),
    ]


def test_flags_keep_nulls(spark):
    assert values(spark, "int", C.is_on_time("v"), [-5, 0, 1, None]) == [True, True, False, None]
    assert values(spark, "string", C.is_moving("v"), ["ON", "IDLE", None]) == [True, False, None]
    assert values(spark, "string", C.is_terminal("v"), ["RETURNED", "IN_TRANSIT"]) == [True, False]


def test_gate_and_faults_agree(spark):
    rows = spark.createDataFrame([
        (90.0, 180.0, 0.0, 0.0), (-90.0, -180.0, 1.0, 1.0), (90.1, 0.0, 1.0, 0.5), (0.0, 180.1, 1.0, 0.5),
        (0.0, 0.0, -0.1, 0.5), (0.0, 0.0, 1.0, 1.1), (None, 0.0, 1.0, 0.5), (0.0, 0.0, None, None),
        (0.0, 0.0, float("nan"), 0.5), (float("nan"), 0.0, 1.0, float("nan")),
    ], "latitude double, longitude double, speed_mph double, fuel_level double").select(
        F.coalesce(C.gps_valid(), F.lit(False)), C.gps_faults()).collect()
    assert [tuple(r) for r in rows] == [
        (True, ""), (True, ""), (False, "latitude"), (False, "longitude"), (False, "speed"), (False, "fuel"),
        (False, "latitude"), (False, "speed,fuel"), (False, "speed"), (False, "latitude,fuel")]


def test_percent_fuel_feed(spark):
    row = spark.sql("select 1d latitude, 1d longitude, 1d speed_mph, 55d fuel_level")
    assert row.where(C.gps_valid()).count() == 0
    assert row.where(C.gps_valid(fuel_scale=100)).count() == 1


def test_ratios_that_do_not_fit_are_null(spark):
    row = spark.sql("select 5 a, 0 b, 1 c, 1000000 d").select(
        C.percentage("a", "b"), C.as_decimal(C.percentage("a", "c")), C.as_decimal(C.percentage("d", "c"))).first()
    assert row[0] is None and float(row[1]) == 500.0 and row[2] is None


def test_defaults_and_lineage(spark):
    rows = spark.sql("select cast(null as int) delay_minutes, cast(null as string) notes, 5 other")
    assert tuple(C.with_defaults(rows).first()) == (0, "Unknown", 5)
    stamped = C.with_lineage(rows, at="2024-01-01 00:00:00", version="v1").first()
    assert stamped.processed_at == datetime(2024, 1, 1) and stamped.version_tag == "v1"


def test_coord_prefix(spark):
    assert spark.sql("select 40.7128d latitude, -74.0060d longitude").select(C.coord_prefix()).first()[0] == "40.71-74.00"


def test_enrichment_runs_without_shuffle_or_python(spark):
    from tests.conftest import plan
    rows = spark.sql("""select timestamp '2024-01-01' event_timestamp, 1d speed_mph, 1d fuel_level, 'ON' engine_status,
        1 delay_minutes, 1d package_weight_lbs, 'DELIVERED' event_type""")
    text = plan(C.enrich_deliveries(C.enrich_gps(rows)))
    assert "Exchange" not in text and "Python" not in text
