"""Partitioned Parquet reads, full and incremental."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from roadgauge import schemas as S


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in its own file system. Any other error is raised, so an
    unreadable target is never mistaken for a first run."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file or folder."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(jvm_path).getLength()


def scan(spark: SparkSession, root: str, schema: StructType | None = None) -> DataFrame:
    """Whole table with partition discovery; a given schema skips reading footers."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(root)


def scan_date(spark: SparkSession, root: str, day: str, schema: StructType | None = None) -> DataFrame:
    """One event_date. Reading the root keeps the partition column and prunes the rest."""
    return scan(spark, root, schema).where(F.col("event_date") == day)


def scan_range(
    spark: SparkSession, root: str, ts: str, low: datetime | None, high: datetime,
    schema: StructType | None = None, date_column: str | None = "event_date",
) -> DataFrame:
    """Rows with low < ts < high, or all before ``high`` on a first run.

    ``low`` is the exact maximum already loaded. With ``date_column`` the same bounds also go
    on the partition column, so whole directories are skipped and not only row groups.
    """
    rows = scan(spark, root, schema).where(F.col(ts) < F.lit(high))
    if low is not None:
        rows = rows.where(F.col(ts) > F.lit(low))
    if date_column is not None and date_column in rows.columns:
        day = F.col(date_column)
        rows = rows.where(day <= F.lit(high.date().isoformat()))
        if low is not None:
            rows = rows.where(day >= F.lit(low.date().isoformat()))
    return rows


def scan_arrived(spark: SparkSession, root: str, since: datetime | None, schema: StructType | None = None) -> DataFrame:
    """Rows of files that arrived at or after a time (all if it is None), with the time as ``arrived_at``.

    Arrival is the file's modification time, which the file index knows, so older files are not opened.
    A late event is read with the file that brings it, however old the event is.
    """
    rows = scan(spark, root, schema).withColumn("arrived_at", F.col("_metadata.file_modification_time"))
    return rows if since is None else rows.where(F.col("_metadata.file_modification_time") >= F.lit(since))


def between(df: DataFrame, ts: str, low: datetime, high: datetime) -> DataFrame:
    """Half-open time range of a frame."""
    return df.where((F.col(ts) >= F.lit(low)) & (F.col(ts) < F.lit(high)))


def scan_newer_partitions(spark: SparkSession, root: str, watermark: date | None) -> DataFrame:
    """year/month/day partitions strictly after the watermark date; all if it is None."""
    return newer_partitions(scan(spark, root), watermark)


def newer_partitions(rows: DataFrame, watermark: date | None) -> DataFrame:
    """Only partition columns are compared, so files of older days are not listed for reading."""
    if watermark is None:
        return rows
    return rows.where(F.make_date("year", "month", "day") > F.lit(watermark))


def savings(full: DataFrame, part: DataFrame, partition_columns: list[str]) -> DataFrame:
    """Partitions, records and bytes of a full and an incremental scan, and the reduction.

    Bytes are summed over the distinct files the rows came from.
    """
    def figures(df: DataFrame, suffix: str) -> DataFrame:
        per_file = df.groupBy(
            *partition_columns, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
        ).agg(F.count(F.lit(1)).alias("n"))
        per_partition = per_file.groupBy(*partition_columns).agg(F.sum("n").alias("n"), F.sum("size").alias("size"))
        return per_partition.agg(
            F.count(F.lit(1)).alias(f"{suffix}_partitions"),
            F.coalesce(F.sum("n"), F.lit(0)).alias(f"{suffix}_records"),
            F.coalesce(F.sum("size"), F.lit(0)).alias(f"{suffix}_bytes"),
        )

    both = figures(full, "full").withColumn("_part", figures(part, "incremental").select(F.struct("*")).scalar())
    return both.select("*", "_part.*").drop("_part").withColumns({
        f"{what}_reduction_pct":
            (1 - F.try_divide(F.col(f"incremental_{what}"), F.col(f"full_{what}"))) * 100
        for what in ("partitions", "records", "bytes")
    })


def normalise(df: DataFrame, aliases: dict[str, str], fuel_scale: float = 1.0) -> DataFrame:
    """Bring older landing files to the current column names, units and time column."""
    out = df.withColumnsRenamed({old: new for old, new in aliases.items() if old in df.columns})
    if "event_timestamp" not in out.columns and "timestamp" in out.columns:
        out = out.withColumn("event_timestamp", F.try_to_timestamp("timestamp"))
    if "fuel_level" in out.columns and fuel_scale != 1.0:
        out = out.withColumn("fuel_level", F.col("fuel_level") / fuel_scale)
    if "event_type" in out.columns:
        renamed = F.col("event_type")
        for old, new in S.STATUS_ALIASES.items():
            renamed = F.when(F.col("event_type") == old, new).otherwise(renamed)
        out = out.withColumn("event_type", renamed)
    return out
