"""Registered queries: contract, and a few of them beside their SQL on the smallest tables."""

import re

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SAMPLE

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
          " conversations").split()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SAMPLE}/{name}.parquet'")
    return connection


def test_names_and_sql_belong_together():
    queries, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(queries)
    assert all(re.fullmatch(r"[a-z]+\d+_[a-z0-9_]+|pipeline", name) for name in queries)


def test_entry_is_the_daily_summary(spark):
    df = entry.entry(spark)
    assert {"date_key", "active_vehicles", "on_time_delivery_pct"} <= set(df.columns) and df.count() > 0


@pytest.mark.parametrize("name", [
    "a1_vehicle_day_trips", "a12_daily_delivery_performance", "c3_upsert_merge", "j11_driver_as_of", "w1_keep_latest_gps",
    "w6_trip_segmentation", "x4_sliding_delivery_kpis_batch",
])
def test_rows_equal_the_sql(spark, db, name):
    df = entry.queries()[name](spark, SAMPLE)
    cursor = db.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
    assert got == sorted(cursor.fetchall(), key=repr)


def test_daily_job_is_repeatable(spark, tmp_path):
    from roadgauge.plans import daily
    from roadgauge.sinks import tables
    from roadgauge.sources import sample

    lake = daily.Lake(str(tmp_path))
    for name, df in (("gps", sample.gps(spark, SAMPLE)), ("deliveries", sample.deliveries(spark, SAMPLE))):
        tables.write_event_dates(sample.event_day(df), lake.path("raw", name))
    first = daily.run_daily(spark, lake, "2024-01-15")
    counts = {name: df.count() for name, df in first.items()}
    daily.run_daily(spark, lake, "2024-01-16")
    loaded = {}
    again = daily.run_daily(spark, lake, "2024-01-15", load=lambda name, df: loaded.update({name: df.count()}))
    assert {name: df.count() for name, df in again.items()} == counts == loaded
    with pytest.raises(ValueError, match="no gps, deliveries data"):
        daily.run_daily(spark, lake, "2030-01-01")


def test_headline_kpis_derive_the_deliveries_for_stored_facts_once(spark, folder, monkeypatch):
    from roadgauge.plans import queries_summaries as summaries

    made, latest = [], summaries.quality.latest_deliveries
    monkeypatch.setattr(summaries.quality, "latest_deliveries", lambda *given: made.append(1) or latest(*given))
    assert summaries.a26(spark, folder).count() == 1 and len(made) == 1
