"""Attempt numbers in a stream: the one operator with keyed Python state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from roadgauge.functions import columns as C

OUTPUT = "delivery_id string, event_type string, event_timestamp timestamp, attempt_number bigint"
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class AttemptCounter(StatefulProcessor):
    """Numbers a delivery's final-status events as they arrive. The state is one counter, which a timer in event time may end."""

    def __init__(self, ttl_ms: int | None, close_after_ms: int | None = None):
        self._ttl_ms, self._close_after_ms = ttl_ms, close_after_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._count = handle.getValueState("attempts", "n bigint", self._ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        done = self._count.get()[0] if self._count.exists() else 0
        newest = 0
        if self._close_after_ms is not None:
            for timer in list(self._handle.listTimers()):
                self._handle.deleteTimer(timer)
                if timer <= timerValues.getCurrentWatermarkInMs():
                    done = 0  # rows of a batch are seen before the timers that are due in it
                else:
                    newest = timer - self._close_after_ms
        # chunk by chunk, so a delivery with very many events is never held whole
        for chunk in rows:
            newest = max(newest, int(chunk["event_timestamp"].max().timestamp() * 1000))
            ordered = chunk.sort_values(["event_timestamp", "event_type"])
            numbers = range(done + 1, done + len(ordered) + 1)
            done += len(ordered)
            yield ordered[["delivery_id", "event_type", "event_timestamp"]].assign(attempt_number=list(numbers))
        self._count.update((done,))
        if self._close_after_ms is not None:
            self._handle.registerTimer(newest + self._close_after_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._count.clear()
        return iter(())

    def close(self) -> None:
        pass


def attempt_numbers(
    deliveries: DataFrame, ttl_days: int | None = None, close_after_days: int | None = None, delay: str = "1 hour",
) -> DataFrame:
    """Attempt number per final-status event, in arrival order across micro-batches.

    With ``ttl_days`` a counter expires that long after its last use. Expiry runs on the
    processing clock, which never ends by itself: use it with an interval trigger only.
    With ``close_after_days`` it ends when the watermark (``delay`` behind the newest event) is so long past the delivery's newest
    event, which a bounded run ends with, too. Needs the RocksDB state store.
    """
    if ttl_days is not None and close_after_days is not None:
        raise ValueError("one clock for the end of a counter")
    ttl_ms = None if ttl_days is None else ttl_days * 86_400_000
    events = deliveries.where(C.is_terminal()).select("delivery_id", "event_type", "event_timestamp")
    close_after_ms, mode = None, "None" if ttl_ms is None else "ProcessingTime"
    if close_after_days is not None:
        events, close_after_ms, mode = events.withWatermark("event_timestamp", delay), close_after_days * 86_400_000, "EventTime"
    return events.groupBy("delivery_id").transformWithStateInPandas(
        AttemptCounter(ttl_ms, close_after_ms), outputStructType=OUTPUT, outputMode="append", timeMode=mode)
