import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from roadgauge import schemas as S
from roadgauge.plans.queries_records import landed_gps, landed_rollup_gps
from roadgauge.sinks import tables
from roadgauge.sources import catalog, external, files, records, sample
from tests.conftest import plan


def partition_filters(df) -> str:
    text = plan(df)
    return text[text.index("PartitionFilters"):].split("]")[0]


@pytest.fixture(scope="module")
def landed(spark):
    return landed_gps(spark, "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def rollup(spark):
    return landed_rollup_gps(spark, "/root/testdata/sf0.001")


def files_read(df) -> int:
    df.collect()
    return df.select(F.input_file_name()).distinct().count()


def test_date_scan_prunes_partitions_and_columns(spark, landed):
    df = files.scan_date(spark, landed, "2024-01-15").select("event_id")
    assert "event_date" in partition_filters(df) and "2024-01-15" in partition_filters(df)
    text = plan(df)
    assert "ReadSchema: struct<event_id:bigint>" in text


def test_time_range_also_prunes_partitions(spark, landed):
    df = files.scan_range(spark, landed, "event_timestamp", datetime(2024, 1, 3, 12), datetime(2024, 1, 5))
    assert "event_date" in partition_filters(df) and "PushedFilters: [IsNotNull(event_timestamp)" in plan(df)
    assert df.where((F.col("event_timestamp") <= datetime(2024, 1, 3, 12)) | (F.col("event_timestamp") >= datetime(2024, 1, 5))).isEmpty()


def test_range_is_open_below_at_the_last_maximum(spark, tmp_path):
    rows = [(datetime(2024, 1, 1, 0, 0, 0, 100),), (datetime(2024, 1, 1, 0, 0, 0, 200),), (datetime(2024, 1, 1, 0, 0, 0, 900),)]
    spark.createDataFrame(rows, "t timestamp").write.parquet(str(tmp_path / "t"))
    got = files.scan_range(spark, str(tmp_path / "t"), "t", rows[0][0], rows[2][0]).collect()
    # the event 100 microseconds after the last maximum is read
    assert [r.t for r in got] == [rows[1][0]]


def test_newer_partitions_are_pruned_by_date(spark, rollup):
    df = files.scan_newer_partitions(spark, rollup, date(2024, 1, 29))
    assert "make_date" in partition_filters(df)
    assert {(r.year, r.month, r.day) for r in df.select("year", "month", "day").distinct().collect()} == {(2024, 1, 30)}
    assert files.scan_newer_partitions(spark, rollup, None).count() == 1100


def test_savings_count_bytes_of_the_files_read(spark, rollup):
    full = files.scan(spark, rollup)
    row = files.savings(full, files.newer_partitions(full, date(2024, 1, 20)), ["year", "month", "day"]).first()
    assert row.full_partitions == 30 and row.incremental_partitions == 10
    assert row.partitions_reduction_pct == pytest.approx(100 * 2 / 3)
    assert 0 < row.incremental_bytes < row.full_bytes
    none = files.savings(full, files.newer_partitions(full, date(2030, 1, 1)), ["year", "month", "day"]).first()
    assert none.incremental_records == 0 and none.records_reduction_pct == 100


def test_one_day_query_prunes(spark, rollup):
    df = files.scan(spark, rollup).where("year = 2024 and month = 1 and day = 15")
    assert "day" in partition_filters(df)


def test_exists_and_explicit_schema(spark, landed, tmp_path):
    assert files.exists(spark, landed) and not files.exists(spark, str(tmp_path / "none"))
    df = files.scan(spark, landed, sample.gps(spark, "/root/testdata/sf0.001").select("event_id", "speed_mph").schema)
    assert df.columns[:2] == ["event_id", "speed_mph"] and df.count() == 1100


def test_rewriting_a_day_leaves_other_days(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "event_date string, v int")
    tables.write_event_dates(rows, path)
    tables.write_event_dates(rows.where("v = 2").withColumn("v", F.lit(3)), path)
    assert sorted(r.v for r in files.scan(spark, path).collect()) == [1, 3]


def test_heavy_day_is_written_by_several_tasks(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(10_000).withColumn("event_date", F.lit("2024-01-01"))
    # AQE would rightly join so few rows into one file
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.write_partitions(rows, path, ["event_date"], sort=["id"], files_per_partition=3)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    read = spark.read.parquet(path)
    assert read.count() == 10_000 and 1 < read.select(F.input_file_name()).distinct().count() <= 3


def test_older_files_are_normalised(spark):
    old = spark.sql("select 40d fuel_level, 'FAILED' status, '2024-01-01T00:00:00Z' timestamp, 7 odometer")
    row = files.normalise(old, {**S.GPS_ALIASES, **S.DELIVERY_ALIASES}, fuel_scale=100).first()
    assert row.event_type == "FAILED_ATTEMPT" and row.fuel_level == 0.4 and row.odometer_miles == 7
    assert row.event_timestamp == datetime(2024, 1, 1)


GOOD = '{"event_id": "1", "vehicle_id": "V1", "timestamp": "2024-01-01T00:00:00.5Z", "speed_mph": 1.5}'


def test_json_split_keeps_bad_records_with_their_error(spark):
    lines = [GOOD, '{"event_id": "2"', "[]", GOOD.replace("2024-01-01T", "garbage"), "", None]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    parsed, seen = records.counted(records.parse_json(df, F.col("value"), S.GPS_EVENT))
    out = parsed.select("raw", "error").collect()
    assert [r.error for r in out] == [None, "malformed JSON", "malformed JSON", "bad timestamp", "malformed JSON", "no payload"]
    assert seen.get == {"processed": 1, "failed": 5}
    row = records.good(records.parse_json(df, F.col("value"), S.GPS_EVENT), S.GPS_EVENT).collect()
    assert len(row) == 1 and row[0].speed_mph == 1.5 and row[0].event_timestamp == datetime(2024, 1, 1, 0, 0, 0, 500000)
    assert len(S.GPS_EVENT.fields) == 10


def test_records_without_identity_are_bad(spark):
    lines = ['{"timestamp": "2024-01-01T00:00:00Z"}', GOOD.replace('"V1"', '" "'), GOOD.replace('"1"', "null")]
    parsed = records.parse_json(spark.createDataFrame([(x,) for x in lines], "value string"), F.col("value"), S.GPS_EVENT)
    assert [r.error for r in parsed.select("error").collect()] == ["no event_id", "no vehicle_id", "no event_id"]


def test_wrapped_payloads(spark):
    df = spark.createDataFrame([(GOOD,)], "v string").select(F.base64("v").alias("p")).union(
        spark.sql("select '***not base64***' p"))
    parsed = records.unwrap(df, "p", S.GPS_EVENT)
    assert [r.error for r in parsed.collect()] == [None, "no payload"]


def test_jdbc_options_push_the_range_and_split_it():
    got = external.jdbc_options("jdbc:x", "app.orders", "updated_at", datetime(2024, 1, 1), datetime(2024, 1, 2), 4)
    assert got["dbtable"] == (
        "(select * from app.orders where updated_at >= timestamp '2024-01-01 00:00:00.000000'"
        " and updated_at < timestamp '2024-01-02 00:00:00.000000') as changed")
    assert got["partitionColumn"] == "updated_at" and got["numPartitions"] == "4"
    with pytest.raises(ValueError):
        external.jdbc_range_query("t; drop table t", "ts", datetime(2024, 1, 1), datetime(2024, 1, 2))


def test_kafka_offsets_go_on_where_the_last_run_ended(spark):
    assert external.kafka_options("s", "t", None)["startingOffsets"] == "earliest"
    batch = spark.sql("select * from values ('t', 0, 5), ('t', 0, 9), ('t', 2, 1) v(topic, partition, offset)")
    offsets = external.next_offsets(batch, {"t": {"0": 4, "1": 7}})
    assert offsets == {"t": {"0": 10, "1": 7, "2": 2}}
    assert json.loads(external.kafka_options("s", "t", offsets)["startingOffsets"]) == offsets


def test_offsets_come_from_the_rows_that_were_read(spark):
    """The source grows between two actions; the batch does not."""
    grown = {"n": 5}
    source = spark.range(100).select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"))

    def load(options):
        assert options["startingOffsets"] == json.dumps({"t": {"0": 2}})
        return source.where(F.col("offset").between(2, grown["n"]))

    batch, offsets = external.read_kafka_range(spark, "s", "t", {"t": {"0": 2}}, load=load)
    grown["n"] = 50
    assert batch.count() == 4 and offsets == {"t": {"0": 6}}


def test_warehouse_load_refuses_rows_of_other_days(spark):
    rows = spark.createDataFrame([(20240115,), (None,)], "date_key int")
    with pytest.raises(ValueError, match="outside"):
        tables.load_warehouse(rows, "jdbc:none", "dw.fact", {}, lambda text: pytest.fail("ran a statement"), [20240115])
    swap = tables.warehouse_swap_sql("dw.fact", "dw.fact_staging", ["date_key", "n"], [20240115])
    assert swap.startswith("begin; delete from dw.fact where date_key in (20240115);") and swap.endswith("commit")


def test_catalog_tables_and_partition_upkeep(spark, tmp_path):
    root = str(tmp_path)
    catalog.create_tables(spark, root, "lake")
    assert {t.name for t in spark.catalog.listTables("lake")} == set(catalog.TABLES)
    rows = spark.range(3).select(F.col("id").cast("string").alias("event_id"), F.lit("2024-01-15").alias("event_date"))
    tables.write_event_dates(rows, f"{root}/{catalog.FOLDERS['raw_gps_events']}")
    assert spark.table("lake.raw_gps_events").count() == 0
    catalog.repair(spark, "lake.raw_gps_events")
    assert spark.table("lake.raw_gps_events").where("event_date = '2024-01-15'").count() == 3
    catalog.add_partition(spark, "lake.agg_daily_summary", "date_key", 20240115)
    assert [r[0] for r in spark.sql("show partitions lake.agg_daily_summary").collect()] == ["date_key=20240115"]
    assert spark.table("lake.agg_daily_summary").schema["on_time_delivery_pct"].dataType.simpleString() == "decimal(5,2)"


def test_catalog_reads_what_the_daily_job_writes(spark, tmp_path):
    from roadgauge.plans import daily
    from roadgauge.sources import sample
    from tests.conftest import SAMPLE

    lake = daily.Lake(str(tmp_path))
    for name, df in (("gps", sample.gps(spark, SAMPLE)), ("deliveries", sample.deliveries(spark, SAMPLE))):
        tables.write_event_dates(sample.event_day(df), lake.path("raw", name))
    daily.run_daily(spark, lake, "2024-01-15", now="2024-01-16 01:02:03")
    catalog.create_tables(spark, lake.root, "daily_lake")
    for name in ("fact_gps_events", "fact_deliveries", "fact_vehicle_trips", "agg_daily_summary"):
        catalog.repair(spark, f"daily_lake.{name}")
        rows = spark.table(f"daily_lake.{name}")
        assert len(rows.collect()) > 0
        assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in catalog.declared(name)]
    summary = spark.table("daily_lake.agg_daily_summary").first()
    assert str(summary.created_at) == "2024-01-16 01:02:03" and str(summary.summary_date) == "2024-01-15"
    trips = spark.table("daily_lake.fact_vehicle_trips")
    assert trips.where("trip_date is null or date_key <> 20240115").isEmpty()
    spark.sql("drop database daily_lake cascade")


def test_warehouse_statements_and_columns(spark):
    assert tables.warehouse_delete_sql("dw.fact", [20240115]) == "delete from dw.fact where date_key in (20240115)"
    with pytest.raises(ValueError):
        tables.warehouse_delete_sql("x; y", [1])
    fact = tables.to_fact_gps(spark.sql("""select 1 event_id, 1 date_key, 2 time_key, 3L vehicle_key, 4L location_key, 1d latitude,
        2d longitude, 5000d speed_mph, 90 heading, 'ON' engine_status, 0.5d fuel_level, 1.5d odometer_miles, current_timestamp() event_timestamp"""))
    assert fact.schema["latitude"].dataType.simpleString() == "decimal(10,6)" and fact.first().speed_mph is None


def test_json_report_is_one_document_per_day(spark, tmp_path):
    path = str(tmp_path / "reports")
    rows = spark.sql("select date '2024-01-01' report_date, 5 total union all select date '2024-01-02', 6")
    for _ in range(2):
        tables.write_json_report(rows, path)
    back = spark.read.json(path)
    assert sorted((str(r.day), r.total) for r in back.collect()) == [("2024-01-01", 5), ("2024-01-02", 6)]
