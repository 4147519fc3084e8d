import json
import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from roadgauge.operators import dims, merge
from roadgauge.session import stage
from roadgauge.sinks import key_dates, state, versioned
from tests.conftest import plan

T0 = datetime(2024, 1, 1)
ROW = "id int, ts timestamp, v string, w int"


def day(n):
    return T0 + timedelta(days=n)


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_upsert_updates_inserts_and_keeps(spark):
    target = spark.createDataFrame([(1, day(0), "a", 1), (2, day(0), "b", 2)], ROW).withColumn("loaded_at", F.lit(day(0)))
    source = spark.createDataFrame([(2, day(1), "B", None), (3, day(1), "c", 3)], ROW)
    got = merge.upsert(target, source, ["id"], "ts", loaded_at=day(5))
    assert rows(got, "id", "v", "w", "loaded_at") == [(1, "a", 1, day(0)), (2, "B", 2, day(5)), (3, "c", 3, day(5))]
    over = merge.upsert(target, source, ["id"], "ts", null_policy="overwrite")
    assert rows(over, "id", "w") == [(1, 1), (2, None), (3, 3)]
    with pytest.raises(ValueError):
        merge.upsert(target, source, ["id"], "ts", null_policy="x")


def test_duplicate_source_keys_do_not_multiply_rows(spark):
    target = spark.createDataFrame([(1, day(0), "a", 1)], ROW)
    source = spark.createDataFrame([(1, day(1), "x", 1), (1, day(3), "z", 1), (1, day(2), "y", 1)], ROW)
    assert rows(merge.upsert(target, source, ["id"], "ts"), "id", "v") == [(1, "z")]
    assert merge.updated(target, source, ["id"]).count() == 1
    assert rows(merge.first_load(source, ["id"], "ts"), "v") == [("z",)]


def test_new_columns_reach_updated_rows_too(spark):
    target = spark.createDataFrame([(1, day(0), "a", 1), (2, day(0), "b", 1)], ROW)
    source = spark.createDataFrame([(1, day(1), "a", 1)], ROW).withColumn("extra", F.lit("new"))
    assert rows(merge.upsert(target, source, ["id"], "ts"), "id", "extra") == [(1, "new"), (2, None)]


def test_merging_twice_is_merging_once(spark):
    rng = random.Random(1)
    make = lambda n, lo: [(rng.randrange(30), day(rng.randrange(9)), rng.choice("abc"), rng.choice([None, 1, 2])) for _ in range(n)]
    target = merge.first_load(spark.createDataFrame(make(40, 0), ROW), ["id"], "ts")
    source = spark.createDataFrame(make(40, 0), ROW)
    once = merge.upsert(target, source, ["id"], "ts")
    twice = merge.upsert(once, source, ["id"], "ts")
    assert rows(once, "id", "ts", "v", "w") == rows(twice, "id", "ts", "v", "w")
    assert once.groupBy("id").count().where("count > 1").isEmpty()


def test_hash_tells_nulls_and_positions_apart(spark):
    df = spark.sql("select * from values (null, 'a'), ('a', null), ('a', 'a'), ('', 'a') t(x, y)")
    assert df.select(merge.row_hash(["x", "y"])).distinct().count() == 4


def test_changed_rows(spark):
    current = spark.createDataFrame([(1, day(0), "a", None), (2, day(0), "b", 2)], ROW)
    source = spark.createDataFrame([(1, day(1), "a", None), (2, day(1), "b", None), (3, day(1), "c", 1)], ROW)
    assert rows(merge.changed(current, source, ["id"], ["v", "w"]), "id", "change") == [(2, "update"), (3, "insert")]


def history_of(events):
    """Versions by brute force: per key in time order, dropping repeats."""
    out = []
    for key in {e[0] for e in events}:
        kept = []
        for e in sorted((e for e in events if e[0] == key), key=lambda e: e[1]):
            if not kept or kept[-1][2:] != e[2:]:
                kept.append(e)
        ends = [e[1] for e in kept[1:]] + [None]
        out += [(key, e[2], e[3], e[1], end, end is None) for e, end in zip(kept, ends)]
    return sorted(out, key=repr)


HISTORY = ("id", "v", "w", "effective_start", "effective_end", "is_current")


@pytest.mark.parametrize("seed", [1, 2])
def test_history_equals_brute_force_with_late_and_chained_rows(spark, seed):
    rng = random.Random(seed)
    stamps = {}
    events = []
    for i in range(60):
        key = rng.randrange(6)
        at = day(rng.randrange(400))
        if (key, at) not in stamps:
            stamps[key, at] = True
            events.append((key, at, rng.choice("ab"), rng.choice([None, 1])))
    rng.shuffle(events)
    table, expected = None, []
    for part in (events[:20], events[20:40], events[40:]):
        table = merge.scd2(table, spark.createDataFrame(part, ROW), ["id"], "ts")
        table = spark.createDataFrame(table.collect(), table.schema)
        # what a stored table knows is its versions, not the rows that changed nothing
        expected = history_of([(k, start, v, w) for k, v, w, start, _, _ in expected] + part)
        assert rows(table, *HISTORY) == expected
        again = merge.scd2(table, spark.createDataFrame(part, ROW), ["id"], "ts")
        assert rows(again, *HISTORY) == history_of([(k, start, v, w) for k, v, w, start, _, _ in expected] + part)


def test_key_lookup_takes_the_version_of_the_time(spark):
    source = spark.createDataFrame([(1, day(0), "a", 1), (1, day(10), "b", 1)], ROW)
    dim = dims.versioned_dim(merge.scd2(None, source, ["id"], "ts"), "id", "key")
    facts = spark.createDataFrame([(1, day(-1)), (1, day(0)), (1, day(9)), (1, day(10)), (2, day(5))], "id int, event_timestamp timestamp")
    got = dims.lookup_key(facts, dim, "id", "key").join(dim.select("key", "v"), "key", "left")
    assert rows(got, "id", "event_timestamp", "v") == sorted(
        [(1, day(-1), None), (1, day(0), "a"), (1, day(9), "a"), (1, day(10), "b"), (2, day(5), None)], key=repr)


# --- versioned tables --------------------------------------------------------------------

EVENT = "id int, event_timestamp timestamp, event_date string, v string"


def events(spark, *items):
    return spark.createDataFrame([(i, day(d), day(d).date().isoformat(), v) for i, d, v in items], EVENT)


def test_merge_rewrites_only_touched_dates(spark, tmp_path):
    root = str(tmp_path)
    assert versioned.read(spark, root) is None
    versioned.merge_into(spark, root, events(spark, (1, 0, "a"), (2, 1, "b"), (3, 2, "c")), ["id"])
    result = versioned.merge_into(spark, root, events(spark, (2, 1, "B"), (4, 3, "d")), ["id"])
    assert result.rows == 2 and result.watermark == day(3) and result.dates == ["2024-01-02", "2024-01-04"]
    assert {d: int(v.split("-")[0]) for d, v in versioned.published(spark, root).partitions.items()} == {
        "2024-01-01": 1, "2024-01-02": 2, "2024-01-03": 1, "2024-01-04": 2}
    assert rows(versioned.read(spark, root), "id", "v") == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]
    assert rows(versioned.read(spark, root, ["2024-01-02"]), "id") == [(2,)]


def test_key_that_changes_its_date_leaves_no_copy(spark, tmp_path):
    root = str(tmp_path)
    versioned.merge_into(spark, root, events(spark, (1, 0, "a"), (2, 1, "b")), ["id"])
    versioned.merge_into(spark, root, events(spark, (1, 5, "moved")), ["id"])
    assert rows(versioned.read(spark, root), "id", "event_date", "v") == [(1, "2024-01-06", "moved"), (2, "2024-01-02", "b")]
    assert "2024-01-01" not in versioned.published(spark, root).partitions


def test_crash_before_publishing_changes_nothing_and_a_repeat_heals(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    versioned.merge_into(spark, root, events(spark, (1, 0, "a")), ["id"])
    with monkeypatch.context() as broken:
        broken.setattr(state, "write", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            versioned.merge_into(spark, root, events(spark, (1, 0, "A"), (2, 0, "b")), ["id"])
    assert rows(versioned.read(spark, root), "id", "v") == [(1, "a")]
    versioned.merge_into(spark, root, events(spark, (1, 0, "A")), ["id"])
    assert rows(versioned.read(spark, root), "id", "v") == [(1, "A")]
    # the crashed run's folder and the replaced one
    assert len(versioned.remove_unnamed(spark, root, keep_states=1)) == 2
    assert rows(versioned.read(spark, root), "id", "v") == [(1, "A")]


def test_crashed_merge_stays_unseen_when_its_date_empties_later(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    versioned.merge_into(spark, root, events(spark, (1, 0, "a")), ["id"])
    with monkeypatch.context() as broken:
        broken.setattr(state, "write", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            versioned.merge_into(spark, root, events(spark, (1, 0, "A"), (2, 0, "crashed")), ["id"])
    versioned.merge_into(spark, root, events(spark, (1, 5, "moved")), ["id"])
    assert rows(versioned.read(spark, root), "id", "event_date", "v") == [(1, "2024-01-06", "moved")]


def test_losing_writer_leaves_the_winners_rows(spark, tmp_path, monkeypatch):
    root, write = str(tmp_path), state.write
    versioned.merge_into(spark, root, events(spark, (1, 0, "a")), ["id"])

    def other_run_first(*args):
        monkeypatch.setattr(state, "write", write)
        versioned.merge_into(spark, root, events(spark, (1, 0, "winner")), ["id"])
        return write(*args)

    monkeypatch.setattr(state, "write", other_run_first)
    with pytest.raises(RuntimeError, match="another run"):
        versioned.merge_into(spark, root, events(spark, (1, 0, "loser")), ["id"])
    assert rows(versioned.read(spark, root), "id", "v") == [(1, "winner")]


def test_added_column_is_read_and_survives_the_next_merge(spark, tmp_path):
    root = str(tmp_path)
    versioned.merge_into(spark, root, events(spark, (1, 0, "a"), (2, 1, "b")), ["id"])
    versioned.merge_into(spark, root, events(spark, (1, 0, "A")).withColumn("extra", F.lit("x")), ["id"])
    assert rows(versioned.read(spark, root), "id", "v", "extra") == [(1, "A", "x"), (2, "b", None)]
    versioned.merge_into(spark, root, events(spark, (3, 0, "c")), ["id"])
    assert rows(versioned.read(spark, root), "id", "extra") == [(1, "x"), (2, None), (3, None)]


def test_state_cut_short_does_not_count(spark, tmp_path):
    folder = str(tmp_path / "s")
    state.write(spark, folder, {"a": 1}, 0)
    (tmp_path / "s" / "000000000002.json").write_text("")
    assert state.read(spark, folder) == (2, {"a": 1})
    assert state.write(spark, folder, {"a": 3}, 2) == 3 and state.read(spark, folder) == (3, {"a": 3})


# --- index of key to date ----------------------------------------------------------------

def test_index_of_few_keys_reads_their_buckets_only(spark, tmp_path):
    root = str(tmp_path)
    index = key_dates.KeyDates(spark, root, buckets=16)
    pairs = spark.range(5000).select(F.col("id").cast("string").alias("key"), F.lit("2024-01-01").alias("event_date"))
    index.add(pairs)
    few = index.find(spark.createDataFrame([("7",), ("none",)], "key string"))
    # the planner prunes buckets of plain scans, too, but shows it for bucketed ones only
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    shown = plan(index.find(spark.createDataFrame([("7",), ("none",)], "key string")))
    spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert "SelectedBucketsCount: 2 out of 16" in shown
    assert few.collect() == [("7", "2024-01-01")]
    assert index.files_per_bucket() == 1


def test_index_of_many_keys_is_not_shuffled(spark, tmp_path):
    root = str(tmp_path)
    index = key_dates.KeyDates(spark, root, buckets=16)
    index.add(spark.range(5000).select(F.col("id").cast("string").alias("key"), F.lit("2024-01-01").alias("event_date")))
    keys = stage(spark.range(2000, 8000).select(F.col("id").cast("string").alias("key")), "many")
    found = index.find(keys)
    assert found.count() == 3000
    # the one exchange is that of the batch
    text = plan(found)
    assert text.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in text
    assert text.index("key_dates_") < text.index("Exchange")


def test_merge_reads_only_the_dates_of_its_keys(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    for d in range(6):
        versioned.merge_into(spark, root, events(spark, (d, d, "a")), ["id"])
    asked, live = [], versioned._live
    monkeypatch.setattr(versioned, "_live", lambda *a: asked.append(a[3]) or live(*a))
    result = versioned.merge_into(spark, root, events(spark, (1, 4, "moved")), ["id"])
    assert asked == [{"2024-01-02", "2024-01-05"}] and result.dates == ["2024-01-02", "2024-01-05"]
    assert rows(versioned.read(spark, root), "id", "event_date")[:2] == [(0, "2024-01-01"), (1, "2024-01-05")]


def test_index_survives_crash_restart_and_compaction(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    monkeypatch.setattr(key_dates, "MOST_FILES", 0.02)
    versioned.merge_into(spark, root, events(spark, (1, 0, "a"), (2, 1, "b")), ["id"])
    with monkeypatch.context() as broken:
        broken.setattr(state, "write", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            versioned.merge_into(spark, root, events(spark, (1, 3, "lost")), ["id"])
    for table in spark.catalog.listTables():  # a new session knows no tables
        if table.name.startswith("key_dates_"):
            spark.sql(f"drop table {table.name}")
    first = versioned.published(spark, root).keys
    versioned.merge_into(spark, root, events(spark, (1, 5, "moved")), ["id"])
    versioned.merge_into(spark, root, events(spark, (1, 7, "again")), ["id"])
    assert rows(versioned.read(spark, root), "id", "event_date", "v") == [(1, "2024-01-08", "again"), (2, "2024-01-02", "b")]
    assert versioned.published(spark, root).keys != first
    versioned.remove_unnamed(spark, root, keep_states=1)
    versioned.merge_into(spark, root, events(spark, (1, 0, "home"), (2, 2, "B")), ["id"])
    assert rows(versioned.read(spark, root), "id", "event_date") == [(1, "2024-01-01"), (2, "2024-01-03")]


def test_a_table_without_index_gets_one(spark, tmp_path):
    root = str(tmp_path)
    versioned.merge_into(spark, root, events(spark, (1, 0, "a")), ["id"], keys_keep_date=True)
    assert versioned.published(spark, root).keys is None
    versioned.merge_into(spark, root, events(spark, (1, 2, "moved")), ["id"])
    assert rows(versioned.read(spark, root), "id", "event_date") == [(1, "2024-01-03")]


def test_merge_in_slices_of_keys_is_the_merge_at_once(spark, tmp_path, monkeypatch):
    rng = random.Random(4)
    batches = [[(rng.choice([None, *range(40)]), rng.randrange(6), rng.choice("abc")) for _ in range(50)] for _ in range(3)]
    once, sliced = str(tmp_path / "once"), str(tmp_path / "sliced")
    counts, write = [], versioned.tables.write_partitions
    monkeypatch.setattr(versioned.tables, "write_partitions", lambda df, path, *a, **b: counts.append(path) or write(df, path, *a, **b))
    for root, most in ((once, 10**6), (sliced, 20)):
        monkeypatch.setattr(versioned, "SLICE_ROWS", most)
        for number, batch in enumerate(batches):
            versioned.merge_into(spark, root, events(spark, *batch), ["id"], only_newer=number == 2, loaded_at=day(number))
    columns = ("id", "event_timestamp", "event_date", "v", "loaded_at")
    assert rows(versioned.read(spark, sliced), *columns) == rows(versioned.read(spark, once), *columns)
    # three slices of 50 rows at first, then as many as are allowed
    assert sum(sliced in path for path in counts) == 3 + 4 + 4 and sum(once in path for path in counts) == 3
    assert not list((tmp_path / "sliced" / "_merging").iterdir())


def test_unfinished_slices_are_removed_later(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    with monkeypatch.context() as broken:
        broken.setattr(versioned, "_move_dates", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            versioned.merge_into(spark, root, events(spark, (1, 0, "lost")), ["id"])
    assert versioned.read(spark, root) is None and len(list((tmp_path / "_merging").iterdir())) == 1
    versioned.merge_into(spark, root, events(spark, (1, 0, "a")), ["id"])
    versioned.remove_unnamed(spark, root)
    assert rows(versioned.read(spark, root), "id", "v") == [(1, "a")] and not list((tmp_path / "_merging").iterdir())


def test_merge_leaves_no_shuffle_files(spark, tmp_path):
    """Only those of its small aggregates stay until the driver collects its garbage."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held = lambda: {f.getName(): f.length() for f in (files.getAllFiles().apply(i) for i in range(files.getAllFiles().size())) if "shuffle" in f.getName()}
    rng = random.Random(9)
    made = spark.createDataFrame([(i, day(i % 5), day(i % 5).date().isoformat(), str(rng.random())) for i in range(20000)], EVENT)
    before = set(held())
    for _ in range(2):
        versioned.merge_into(spark, str(tmp_path), made, ["id"])
    until = time.time() + 20
    while (left := sum(size for name, size in held().items() if name not in before)) > 50_000 and time.time() < until:
        time.sleep(0.5)
    assert left <= 50_000


@pytest.mark.parametrize("few", [2, 1000])
def test_index_takes_what_is_new_and_tells_the_dates_of_its_keys(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(key_dates, "FEW_KEYS", few)
    rng, known = random.Random(6), set()
    index = key_dates.KeyDates(spark, str(tmp_path), buckets=8)
    for _ in range(4):
        batch = [(rng.choice([None, *range(30)]), rng.randrange(9), "v") for _ in range(25)]
        source = events(spark, *batch)
        pairs = {(r.key, r.event_date) for r in source.select(key_dates.key_of(["id"]).alias("key"), "event_date").collect()}
        dates = index.touch(source, ["id"])
        assert set(dates) == {d for k, d in known if k in {k for k, _ in pairs}} and len(dates) == len(set(dates))
        known |= pairs
        assert sorted(map(tuple, index.table().collect())) == sorted(known)


def test_stored_row_that_is_later_stays(spark):
    target = spark.createDataFrame([(1, day(5), "late", None), (2, day(1), "old", "x")], "id int, ts timestamp, v string, w string")
    source = spark.createDataFrame([(1, day(3), "stale", "w"), (2, day(1), "same", None), (3, None, "new", "n")], target.schema)
    made = merge.upsert(target, source, ["id"], "ts", only_newer=True, loaded_at=day(9))
    assert rows(made, "id", "v", "w", "loaded_at") == [(1, "late", None, None), (2, "same", "x", day(9)), (3, "new", "n", day(9))]


# --- incremental jobs --------------------------------------------------------------------

PING = "event_id string, vehicle_id string, event_timestamp timestamp, speed_mph double, processed_at timestamp"


def land(spark, path, *pings):
    made = spark.createDataFrame([(e, "V1", at, speed, done) for e, at, speed, done in pings], PING)
    made.withColumn("event_date", F.to_date("event_timestamp").cast("string")).write.mode("append").partitionBy("event_date").parquet(path)


def test_incremental_load_loses_nothing(spark, tmp_path):
    from roadgauge.plans import incremental

    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    speeds = lambda: rows(versioned.read(spark, target), "event_id", "speed_mph")
    land(spark, source, ("old", day(-300), 10.0, day(-300)), ("new", day(9), 20.0, day(9)),
         ("twice", day(8), 50.0, day(8)), ("twice", day(8), 40.0, day(8) + timedelta(seconds=60)))
    first = incremental.run_feed(spark, incremental.GPS, source, target, day(10))
    # the oldest row is there, and of two copies the one processed last
    assert speeds() == [("new", 20.0), ("old", 10.0), ("twice", 40.0)] and first["gps_events_records_processed"] == 4
    land(spark, source, ("late", day(9) - timedelta(hours=1), 30.0, day(10)))
    second = incremental.run_feed(spark, incremental.GPS, source, target, day(11))
    assert ("late", 30.0) in speeds() and len(speeds()) == 4
    assert second["gps_events_read_since"] < first["gps_events_arrived_until"]
    before = speeds()
    incremental.run_feed(spark, incremental.GPS, source, target, day(12))
    assert speeds() == before


def test_stale_copies_never_replace_newer_rows(spark, tmp_path):
    """Whether a stale copy comes late, or old files are read again in the overlap."""
    from roadgauge.plans import incremental

    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    land(spark, source, ("a", day(8), 40.0, day(8) + timedelta(minutes=20)), ("b", day(8), 1.0, day(8)))
    incremental.run_feed(spark, incremental.GPS, source, target, day(10))
    land(spark, source, ("a", day(8), 50.0, day(8) + timedelta(minutes=10)), ("b", day(8), 2.0, day(8) + timedelta(minutes=1)))
    for at in (11, 12):
        incremental.run_feed(spark, incremental.GPS, source, target, day(at))
        assert rows(versioned.read(spark, target), "event_id", "speed_mph") == [("a", 40.0), ("b", 2.0)]


def test_offsets_are_published_with_their_rows(spark, tmp_path, monkeypatch):
    """A run that crashes before publishing leaves the offsets, and the next one reads the same records again."""
    from roadgauge import schemas as S
    from roadgauge.plans import incremental

    target, asked = str(tmp_path / "out"), []
    value = lambda e, speed: ('{"event_id": "%s", "vehicle_id": "V1", "timestamp": "2024-01-0%dT00:00:00Z", "speed_mph": %s}' % (e, int(e) + 1, speed))
    topic = spark.createDataFrame(
        [("t", 0, 0, value("1", 1.0)), ("t", 0, 1, "{broken"), ("t", 1, 0, value("2", 2.0)), ("t", 0, 2, value("1", 9.0))],
        "topic string, partition int, offset long, value string")

    def load(options):
        asked.append(options["startingOffsets"])
        starts = json.loads(asked[-1])["t"] if asked[-1] != "earliest" else {}
        first = F.when(F.col("partition") == 0, starts.get("0", 0)).otherwise(starts.get("1", 0))
        return topic.where(F.col("offset") >= first).where("offset < 2 or %s" % (len(asked) > 2))

    def run(n):
        return incremental.run_offsets(spark, incremental.GPS, "", "t", target, day(10 + n), S.GPS_EVENT, load)

    with monkeypatch.context() as broken:
        broken.setattr(state, "write", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            run(0)
    first = run(1)
    assert asked == ["earliest", "earliest"] and first["gps_events_records_rejected"] == 1
    assert first["gps_events_offsets"] == {"t": {"0": 2, "1": 1}}
    assert rows(versioned.read(spark, target), "event_id", "speed_mph") == [("1", 1.0), ("2", 2.0)]
    assert run(2)["gps_events_offsets"] == {"t": {"0": 3, "1": 1}} and json.loads(asked[2]) == {"t": {"0": 2, "1": 1}}
    assert rows(versioned.read(spark, target), "event_id", "speed_mph") == [("1", 9.0), ("2", 2.0)]


def test_arrived_rows_are_not_stored_a_second_time(spark, tmp_path, monkeypatch):
    from roadgauge.plans import incremental

    monkeypatch.setattr(incremental, "stage", lambda *a: pytest.fail("writes the arrived rows"))
    monkeypatch.setattr(key_dates, "stage", lambda *a: pytest.fail("writes the keys"))
    monkeypatch.setattr(key_dates, "FEW_KEYS", 1)
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    feed = incremental.Feed("moving", ("event_id",), incremental._derive_gps)
    land(spark, source, ("a", day(0), 1.0, day(0)), ("b", day(1), 1.0, day(1)))
    incremental.run_feed(spark, feed, source, target, day(1))
    land(spark, source, ("a", day(3), 2.0, day(3)), ("c", day(1), 1.0, day(1)))
    metrics = incremental.run_feed(spark, feed, source, target, day(4))
    assert rows(versioned.read(spark, target), "event_id", "event_date") == [("a", "2024-01-04"), ("b", "2024-01-02"), ("c", "2024-01-02")]
    assert metrics["moving_records_processed"] == 4


def test_landing_and_merging_shuffle_rows_once_at_most(spark, tmp_path):
    """Landing shuffles nothing; a later merge shuffles stored rows, new rows and new keys once each, besides four small aggregates."""
    from roadgauge.plans import incremental, queries_history

    number = lambda: spark._jsc.sc().newShuffleId()
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    made = spark.range(4000).selectExpr(
        "concat('D', id) as delivery_id", "'DELIVERED' as event_type", "cast(id % 9 as int) as delay_minutes",
        "timestamp'2024-01-01 00:00:00' + make_dt_interval(cast(id % 5 as int)) as event_timestamp",
        "cast(date'2024-01-01' + cast(id % 5 as int) as string) as event_date")
    first = number()
    queries_history.arrive(made.where("delay_minutes < 3"), source)
    queries_history.arrive(made.where("delay_minutes >= 3"), source)
    assert number() == first + 1
    for at in (10, 11):
        before = number()
        incremental.run_feed(spark, incremental.DELIVERIES, source, target, day(at))
    assert number() - before - 1 <= 7
    assert rows(versioned.read(spark, target), "delivery_id", "event_date") == rows(made, "delivery_id", "event_date")


def test_bounded_start_is_explicit(spark, tmp_path):
    from roadgauge.plans import incremental

    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    land(spark, source, ("a", day(0), 1.0, day(0)))
    result = incremental.run_feed(spark, incremental.GPS, source, target, day(1), start=datetime(2100, 1, 1))
    assert result["gps_events_records_processed"] == 0 and versioned.read(spark, target) is None


def test_pings_need_no_scan_of_stored_keys(spark, tmp_path, monkeypatch):
    from roadgauge.plans import incremental

    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    land(spark, source, ("a", day(0), 1.0, day(0)))
    monkeypatch.setattr(merge, "updated", lambda *a: pytest.fail("reads the keys of the whole table"))
    incremental.run_feed(spark, incremental.GPS, source, target, day(1))
    land(spark, source, ("b", day(1), 1.0, day(1)))
    incremental.run_feed(spark, incremental.GPS, source, target, day(2))
    assert rows(versioned.read(spark, target), "event_id") == [("a",), ("b",)]


def test_empty_source_and_version_pruning(spark, tmp_path):
    root = str(tmp_path)
    versioned.merge_into(spark, root, events(spark, (1, 0, "a")), ["id"])
    assert versioned.merge_into(spark, root, events(spark).limit(0), ["id"]).rows == 0
    text = plan(versioned.read(spark, root))
    assert "version" in text[text.index("PartitionFilters"):].split("PushedFilters")[0]


def test_two_writers_from_one_state_do_not_both_win(spark, tmp_path):
    folder = str(tmp_path / "s")
    assert state.write(spark, folder, {"a": 1}, 0) == 1
    with pytest.raises(RuntimeError):
        state.write(spark, folder, {"a": 2}, 0)
    assert state.read(spark, folder) == (1, {"a": 1})


def test_watermarks(spark, tmp_path):
    root = str(tmp_path)
    assert state.get_watermark(spark, root, "job", "gps") is None
    state.set_watermark(spark, root, "job", "gps", day(3), day(4))
    state.set_watermark(spark, root, "job", "gps", day(5), day(6))
    assert state.get_watermark(spark, root, "job", "gps") == day(5)
    now = day(10)
    assert state.watermark_range(None, now) == (None, now - timedelta(minutes=5))
    assert state.watermark_range(None, now, lookback=timedelta(days=1))[0] == now - timedelta(days=1)
    assert state.watermark_range(day(5), now)[0] == day(5)
    assert state.watermark_range(day(5), now, lateness=timedelta(hours=1))[0] == day(5) - timedelta(hours=1)
