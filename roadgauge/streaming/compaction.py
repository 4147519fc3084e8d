"""Compaction of what micro-batches leave: one folder per date and batch becomes one file set per date.

A merge reads the stored rows of a date up to a batch id, combines them, writes them to a folder of its own run, and then names that folder,
with the batch id it covers, in a numbered state. Readers take the named folders and the batches after them, so a
crash before the state is written changes nothing, and after it leaves folders that are only ignored until the next
run deletes them. Batches that come later, for old dates too, stay beside the merged rows until they are merged in turn.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadgauge.sinks import state

#: Batch folders of a date that may lie side by side.
MOST_BATCHES = 16


def _folders(spark: SparkSession, pattern: str) -> list[tuple[str, ...]]:
    fs, path = state.file_system(spark, pattern)
    found = fs.globStatus(path) or []
    return [(status.getPath().getParent().getName(), status.getPath().getName(), status.getPath()) for status in found]


def batches(spark: SparkSession, path: str) -> dict[str, list[int]]:
    """Batch ids by date, of folders only."""
    out: dict[str, list[int]] = {}
    for day, batch, _ in _folders(spark, f"{path}/event_date=*/batch_id=*"):
        out.setdefault(day.split("=", 1)[1], []).append(int(batch.split("=", 1)[1]))
    return out


def read(spark: SparkSession, path: str, since: str | None = None, until: int | None = None) -> DataFrame:
    """Rows of all batches, each once, with event_date as text; the merged folders stand for the batches they cover.

    until: leave out batches after this one.
    """
    _, stored = state.read(spark, f"{path}/_state")
    live, parts = stored.get("dates", {}), []
    if batches(spark, path):
        raw = spark.read.parquet(path).withColumn("event_date", F.col("event_date").cast("string"))
        if live:
            covered = F.create_map(*[F.lit(x) for day, entry in live.items() for x in (day, entry["upto"])])
            raw = raw.where(F.col("batch_id") > F.coalesce(F.try_element_at(covered, "event_date"), F.lit(-1)))
        if until is not None:
            raw = raw.where(F.col("batch_id") <= until)
        parts.append(raw.drop("batch_id"))
    if live:
        names = [f"{entry['run']}/{day}" for day, entry in live.items()]
        merged = spark.read.parquet(f"{path}/_merged").withColumn("event_date", F.col("event_date").cast("string"))
        parts.append(merged.where(F.concat_ws("/", "run", "event_date").isin(names)).drop("run"))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return rows if since is None else rows.where(F.col("event_date") >= since)


def compact(
    spark: SparkSession, path: str, combine: Callable[[DataFrame], DataFrame], upto: int, closed_before: str | None = None,
    most: int = MOST_BATCHES,
) -> list[str]:
    """Merge the dates that have more than ``most`` batches up to ``upto``, or any if they are closed; returns them.

    combine: stored rows to fewer rows of the same columns that stand for them. upto: a batch that is committed, so that
    no batch up to it is written again. One call at a time per path.
    """
    here = {day: [b for b in ids if b <= upto] for day, ids in batches(spark, path).items()}
    number, stored = state.read(spark, f"{path}/_state")
    live = stored.get("dates", {})
    due = sorted(
        day for day, ids in here.items()
        if any(b > live.get(day, {"upto": -1})["upto"] for b in ids)
        and (len(ids) > most or (closed_before is not None and day < closed_before)))
    if due:
        run = uuid.uuid4().hex
        rows = read(spark, path, until=upto).where(F.col("event_date").isin(due))
        combine(rows).withColumn("run", F.lit(run)).hint("rebalance", F.col("event_date")).write.mode("append").partitionBy(
            "run", "event_date").parquet(f"{path}/_merged")
        live = live | {day: {"run": run, "upto": upto} for day in due}
        state.write(spark, f"{path}/_state", {**stored, "dates": live}, number)
    _sweep(spark, path)
    return due


def expire(spark: SparkSession, path: str, before: str) -> None:
    """Remove all rows of dates before a day, merged or not."""
    number, stored = state.read(spark, f"{path}/_state")
    live = {day: entry for day, entry in stored.get("dates", {}).items() if day >= before}
    if live != stored.get("dates", {}):
        state.write(spark, f"{path}/_state", {**stored, "dates": live}, number)
    for day, _, folder in _folders(spark, f"{path}/event_date=*/batch_id=*"):
        if day.split("=", 1)[1] < before:
            state.file_system(spark, path)[0].delete(folder, True)
    _sweep(spark, path)


def _sweep(spark: SparkSession, path: str) -> None:
    """Delete batch folders that a merged one covers, and merged folders that no state names."""
    _, stored = state.read(spark, f"{path}/_state")
    live, (fs, _) = stored.get("dates", {}), state.file_system(spark, path)
    for day, batch, folder in _folders(spark, f"{path}/event_date=*/batch_id=*"):
        if int(batch.split("=", 1)[1]) <= live.get(day.split("=", 1)[1], {"upto": -1})["upto"]:
            fs.delete(folder, True)
    for run, day, folder in _folders(spark, f"{path}/_merged/run=*/event_date=*"):
        if live.get(day.split("=", 1)[1], {"run": None})["run"] != run.split("=", 1)[1]:
            fs.delete(folder, True)
    state.remove_old(spark, f"{path}/_state", 2)
