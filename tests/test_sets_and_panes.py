"""Vehicle sets, panes of sliding windows, and compaction of batch outputs."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from roadgauge.operators import vehicle_sets
from roadgauge.sinks import state
from roadgauge.streaming import compaction, panes, sinks, windows

T0 = datetime(2024, 1, 1)
PING = "vehicle_id string, event_timestamp timestamp, speed_mph double, fuel_level double, engine_status string"


def pings(spark, count, vehicles, minutes=60):
    return spark.range(count).select(
        F.concat(F.lit("V"), (F.col("id") * 7919 % vehicles).cast("string")).alias("vehicle_id"),
        (F.lit(T0) + F.make_dt_interval(secs=F.col("id") * 60 * minutes / count)).alias("event_timestamp"),
        (F.col("id") * 104729 % 1000 / 10.0).alias("speed_mph"), F.lit(0.5).alias("fuel_level"), F.lit("ON").alias("engine_status"))


def test_numbers_are_dense_stable_and_go_on(spark):
    first = vehicle_sets.numbered(pings(spark, 500, 300))
    numbers = {r.vehicle_id: r.vehicle_number for r in first.collect()}
    assert sorted(numbers.values()) == list(range(1, 301))
    assert {r.vehicle_id: r.vehicle_number for r in vehicle_sets.numbered(pings(spark, 2000, 300)).collect()} == numbers
    more = vehicle_sets.numbered(pings(spark, 2000, 310), first).collect()
    assert sorted(r.vehicle_number for r in more) == list(range(301, 311)) and not {r.vehicle_id for r in more} & set(numbers)
    assert vehicle_sets.numbered(pings(spark, 10, 5).where("false"), first).count() == 0


def test_sets_of_many_blocks_merge_exactly(spark):
    """70,000 vehicles need three blocks; parts overlap, and a ping without vehicle counts as a ping only."""
    rows = pings(spark, 90_000, 70_000).unionByName(pings(spark, 1, 1).withColumn("vehicle_id", F.lit(None).cast("string")))
    named = rows.join(vehicle_sets.numbered(rows), "vehicle_id", "left").withColumn("day", F.lit("d"))
    halves = [vehicle_sets.vehicle_sets(named.where(c), ["day"], None) for c in ("speed_mph < 60", "speed_mph >= 40")]
    made = vehicle_sets.counts(halves[0].unionByName(halves[1]), ["day"]).first()
    assert made.active_vehicles == 70_000 and abs(made.estimated_vehicles - 70_000) < 3500
    assert halves[0].count() <= 4


def test_windows_from_panes_equal_exact_windows(spark):
    rows = pings(spark, 3000, 40, 30)
    names = ["window_start", "total_events", "active_vehicles", "moving_vehicles", "moving_events", "avg_fuel_level"]
    made = panes.fleet_windows(panes.fleet_panes(rows)).select(*names, "median_speed")
    exact = windows.fleet_metrics_exact(rows).select(*names, "median_speed")
    key = lambda r: r.window_start
    made, exact = sorted(made.collect(), key=key), sorted(exact.collect(), key=key)
    assert [r[:6] for r in made] == [r[:6] for r in exact]
    # 500 speeds a window, evenly spread over 0 to 100: two percent of the ranks are two miles an hour
    assert all(abs(a.median_speed - b.median_speed) <= 2 for a, b in zip(made, exact))


def test_a_window_without_measures_has_no_rank(spark):
    rows = pings(spark, 10, 2, 1).withColumn("speed_mph", F.lit(None).cast("double"))
    made = panes.fleet_windows(panes.fleet_panes(rows)).collect()
    assert len(made) == 5 and all(r.median_speed is None and r.avg_speed is None and r.total_events == 10 for r in made)


def test_rows_enter_one_pane_only(spark):
    """No plan node multiplies the raw rows: the expansion follows the first aggregation."""
    text = panes.fleet_windows(panes.fleet_panes(pings(spark, 10, 2)))._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Expand") < text.index("kll_sketch_agg") if "Expand" in text else True


# --- compaction --------------------------------------------------------------------------

def combined(rows):
    return rows.groupBy("event_date", "k").agg(F.sum("n").alias("n"))


def put(spark, path, batch, *rows):
    sinks.replace_batch(spark.createDataFrame(list(rows), "event_date string, k string, n long").coalesce(1), batch, path, ["event_date"])


def content(spark, path):
    return sorted(tuple(r) for r in combined(compaction.read(spark, path)).collect())


@pytest.fixture
def stored(spark, tmp_path):
    path = str(tmp_path / "out")
    for batch in range(12):
        put(spark, path, batch, ("2024-01-01", "a", 1), ("2024-01-01", f"k{batch % 2}", batch), ("2024-01-02", "a", 10))
    return path


WHOLE = [("2024-01-01", "a", 12), ("2024-01-01", "k0", 30), ("2024-01-01", "k1", 36), ("2024-01-02", "a", 120)]


def test_compaction_keeps_the_rows_and_bounds_the_files(spark, stored):
    assert content(spark, stored) == WHOLE
    assert compaction.compact(spark, stored, combined, 9, most=4) == ["2024-01-01", "2024-01-02"]
    assert content(spark, stored) == WHOLE
    assert compaction.batches(spark, stored) == {"2024-01-01": [10, 11], "2024-01-02": [10, 11]}
    # a late batch for a merged date counts, and is merged when the date has been closed
    put(spark, stored, 12, ("2024-01-01", "a", 100))
    assert content(spark, stored)[0] == ("2024-01-01", "a", 112)
    assert compaction.compact(spark, stored, combined, 12, closed_before="2024-01-02", most=4) == ["2024-01-01"]
    assert content(spark, stored)[0] == ("2024-01-01", "a", 112) and "2024-01-01" not in compaction.batches(spark, stored)
    assert compaction.compact(spark, stored, combined, 12, closed_before="2024-01-02", most=4) == []


def test_all_batches_merged_leaves_a_readable_table(spark, stored):
    compaction.compact(spark, stored, combined, 11, closed_before="2025-01-01")
    assert compaction.batches(spark, stored) == {} and content(spark, stored) == WHOLE
    assert compaction.read(spark, stored, since="2024-01-02").count() == 1


def test_crash_before_and_after_publishing_changes_nothing(spark, stored, monkeypatch):
    with monkeypatch.context() as broken:
        broken.setattr(state, "write", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            compaction.compact(spark, stored, combined, 9, most=4)
    assert content(spark, stored) == WHOLE
    with monkeypatch.context() as broken:
        broken.setattr(compaction, "_sweep", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            compaction.compact(spark, stored, combined, 9, most=4)
    # published, and the old folders are still there
    assert content(spark, stored) == WHOLE and len(compaction.batches(spark, stored)["2024-01-01"]) == 12
    compaction.compact(spark, stored, combined, 9, most=4)
    assert content(spark, stored) == WHOLE and len(compaction.batches(spark, stored)["2024-01-01"]) == 2


def test_expired_dates_go(spark, stored):
    compaction.compact(spark, stored, combined, 9, most=4)
    compaction.expire(spark, stored, "2024-01-02")
    assert content(spark, stored) == WHOLE[3:]
