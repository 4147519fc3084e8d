"""Incremental reads from databases and message brokers."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from roadgauge.session import stage


def jdbc_range_query(table: str, ts: str, low: datetime, high: datetime) -> str:
    """Subquery the database evaluates, so only changed rows travel."""
    for name in (*table.split("."), ts):
        if not name.isidentifier():
            raise ValueError(f"not a plain identifier: {name}")
    return (
        f"(select * from {table} where {ts} >= timestamp '{low:%Y-%m-%d %H:%M:%S.%f}'"
        f" and {ts} < timestamp '{high:%Y-%m-%d %H:%M:%S.%f}') as changed"
    )


def jdbc_options(
    url: str, table: str, ts: str, low: datetime, high: datetime, partitions: int = 16,
    properties: dict[str, str] | None = None,
) -> dict[str, str]:
    """Options of a read split by time into ``partitions`` parallel queries."""
    return {
        **(properties or {}),
        "url": url,
        "dbtable": jdbc_range_query(table, ts, low, high),
        "partitionColumn": ts,
        "lowerBound": f"{low:%Y-%m-%d %H:%M:%S}",
        "upperBound": f"{high:%Y-%m-%d %H:%M:%S}",
        "numPartitions": str(partitions),
    }


def read_jdbc_range(spark: SparkSession, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**kwargs)).load()


def kafka_options(servers: str, topic: str, offsets: dict[str, dict[str, int]] | None) -> dict[str, str]:
    """Bounded read from the stored offsets (earliest on a first run) to the newest."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": json.dumps(offsets) if offsets else "earliest",
        "endingOffsets": "latest",
        "failOnDataLoss": "true",
    }


def read_kafka_range(
    spark: SparkSession, servers: str, topic: str, offsets=None, load=None,
) -> tuple[DataFrame, dict[str, dict[str, int]]]:
    """The records since the stored offsets, and the offsets to store with what is made of them.

    "latest" is resolved anew by every action, so the batch is written once and both come from the
    written rows: offsets never run ahead of the records. ``load`` replaces the read in tests.
    """
    read = load or (lambda options: spark.read.format("kafka").options(**options).load())
    batch = stage(read(kafka_options(servers, topic, offsets)), "broker-batch")
    return batch, next_offsets(batch, offsets)


def next_offsets(records: DataFrame, before: dict[str, dict[str, int]] | None = None) -> dict[str, dict[str, int]]:
    """Offsets to start from next time: one past the greatest read per topic partition.

    Collects one row per topic partition.
    """
    out = {topic: dict(parts) for topic, parts in (before or {}).items()}
    for row in records.groupBy("topic", "partition").agg({"offset": "max"}).collect():
        out.setdefault(row[0], {})[str(row[1])] = row[2] + 1
    return out
