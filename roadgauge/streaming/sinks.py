"""Streaming sinks and the lifecycle of several queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from roadgauge.sources import records
from pyspark.sql.types import StructType


def _trigger(interval: str | None) -> dict:
    """Process what is there and stop, or run on an interval."""
    return {"availableNow": True} if interval is None else {"processingTime": interval}


def to_parquet(
    df: DataFrame, path: str, checkpoint: str, by: str = "event_date", name: str | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Append files under ``by`` partitions; each query has its own checkpoint."""
    writer = df.writeStream.format("parquet").outputMode("append").partitionBy(by)
    if name:
        writer = writer.queryName(name)
    return writer.option("path", path).option("checkpointLocation", checkpoint).trigger(**_trigger(interval)).start()


def to_console(df: DataFrame, name: str, interval: str | None = None) -> StreamingQuery:
    """Print updated rows in full, for debugging."""
    return (
        df.writeStream.format("console").outputMode("update").option("truncate", False).queryName(name)
        .trigger(**_trigger(interval)).start()
    )


def by_batch(
    df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append",
    name: str | None = None, interval: str | None = None,
) -> StreamingQuery:
    """Hand each micro-batch to ``write`` with its id. A repeated batch keeps its id, so a
    writer that replaces the id's own partition is idempotent."""
    writer = df.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**_trigger(interval)).start()


def replace_batch(df: DataFrame, batch: int, path: str, by: list[str] | None = None) -> None:
    """Write one micro-batch below its own batch_id folders."""
    (
        df.withColumn("batch_id", F.lit(batch))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*(by or []), "batch_id").parquet(path)
    )


def land(
    parsed: DataFrame, schema: StructType, path: str, errors: str, checkpoint: str, interval: str | None = None,
) -> StreamingQuery:
    """Good records to Parquet by arrival date, bad ones with their error to another folder.

    The arrival time is the micro-batch's logged time, so a repeated batch lands in the same
    partition.
    """
    def write(batch: DataFrame, number: int) -> None:
        # two writes of one micro-batch: keep it instead of parsing twice
        batch.persist()
        try:
            arrival = F.col("arrived_at")
            good = batch.where("error is null").select(
                *[F.col(f"data.{c}").alias(c) for c in schema.fieldNames()], "event_timestamp", "arrived_at",
                F.year(arrival).alias("year"), F.month(arrival).alias("month"), F.day(arrival).alias("day"),
            )
            replace_batch(good, number, path, ["year", "month", "day"])
            replace_batch(records.bad(batch), number, errors)
        finally:
            batch.unpersist()

    return by_batch(parsed.withColumn("arrived_at", F.current_timestamp()), write, checkpoint, interval=interval)


def wait(spark: SparkSession, queries: list[StreamingQuery], any_ends: bool = True) -> None:
    """Wait for the first query to end (a long-running job) or for all (a bounded one); a
    failed query raises, and the others are stopped."""
    try:
        if any_ends:
            spark.streams.awaitAnyTermination()
        else:
            for query in queries:
                query.awaitTermination()
    finally:
        for query in queries:
            if query.isActive:
                query.stop()


class LateRows(StreamingQueryListener):
    """Counts rows dropped for being older than the watermark, over the whole life of each query.

    Add it before the queries start: ``spark.streams.addListener(LateRows())``.
    """

    def __init__(self):
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.dropped.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        late = sum(operator.numRowsDroppedByWatermark for operator in event.progress.stateOperators)
        key = str(event.progress.id)
        self.dropped[key] = self.dropped.get(key, 0) + late

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def of(self, query: StreamingQuery) -> int:
        return self.dropped.get(str(query.id), 0)
