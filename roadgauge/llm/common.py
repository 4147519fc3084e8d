"""Pieces the operators share: reading documents, and walking Arrow batches inside tasks.

Every operator first selects the columns it needs by name, so further columns of any name
cannot clash with its own. Null handling is stated by each operator.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Rows in one Arrow batch. Texts may be long, and a batch must fit a worker several times.
BATCH_ROWS = 1000
#: A value is hot if it holds more than this share of the rows; so fewer than 1024 are.
HOT_SHARE = 1 / 1024


def session(spark: SparkSession) -> SparkSession:
    """Settings the operators rely on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return session(spark).read.parquet(f"{folder}/{name}.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """doc_id as a long, and text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Apply a function to each Arrow batch; batches without rows are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = function(batch)
                if made is not None and made.num_rows:
                    yield made

    return df.mapInArrow(run, schema)


def fold_of(column: str, parts: int):
    """crc32 of an id written as text, modulo parts. A null id belongs to part 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % parts, F.lit(0))


def join_spread(rows: DataFrame, named: DataFrame, key: str, size: str) -> DataFrame:
    """rows joined to named (key, size, ...), which holds each key once and its number of rows, for any number of rows to a key.

    Keys with more than HOT_SHARE of all rows are fewer than 1024 by count, and are broadcast, so that their rows stay
    where they lie. The others meet in a shuffle. A null key matches none.
    """
    total = named.agg(F.sum(size)).first()[0] or 0
    hot = F.col(size) > F.lit(total * HOT_SHARE)
    few = named.where(hot).drop(size)
    spread = rows.join(F.broadcast(few), key)
    rest = rows.join(F.broadcast(few.select(key)), key, "left_anti").join(named.where(~hot).drop(size), key)
    return spread.unionByName(rest)
