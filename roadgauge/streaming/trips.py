"""Trips in a stream, split by pauses and by the engine: the stream twin of ``operators.trips.with_trip_id``."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from roadgauge.schemas import RATES

OUTPUT = "vehicle_id string, start_time timestamp, end_time timestamp, gps_events bigint"


class TripSplitter(StatefulProcessor):
    """Holds a vehicle's pings until the watermark has passed them, so that they are taken in order of time, and one open trip.

    Times are microseconds. A timer fires for the pings that wait, and one for the end of the open trip.
    """

    def __init__(self, gap_micros: int):
        self._gap = gap_micros

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._waiting = handle.getListState("waiting", "at bigint, event_id bigint, stops boolean")
        self._open = handle.getValueState("open", "start bigint, last bigint, stopped boolean, events bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        added = []
        for chunk in rows:
            at = chunk["event_timestamp"].astype("datetime64[us]").astype("int64")
            added += list(zip(at.tolist(), chunk["event_id"].tolist(), (chunk["engine_status"] == "OFF").tolist()))
        self._waiting.appendList(added)
        self._handle.registerTimer(min(at for at, _, _ in added) // 1000 + 1)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = sorted(self._waiting.get()) if self._waiting.exists() else []
        due = [row for row in waiting if row[0] <= passed]
        trip = self._open.get() if self._open.exists() else None
        closed = []
        for at, _, stops in due:
            if trip is not None and (at - trip[1] > self._gap or trip[2]):
                closed.append(trip)
                trip = None
            trip = (at, at, stops, 1) if trip is None else (trip[0], at, stops, trip[3] + 1)
        rest = waiting[len(due):]
        if trip is not None and (trip[2] or trip[1] + self._gap < passed):
            closed.append(trip)
            trip = None
        if rest:
            self._waiting.put(rest)
        elif waiting:
            self._waiting.clear()
        if trip is None:
            self._open.clear()
        else:
            self._open.update(trip)
            self._handle.registerTimer((trip[1] + self._gap) // 1000 + 1)
        if rest:
            self._handle.registerTimer(rest[0][0] // 1000 + 1)
        if closed:
            start, last, _, events = zip(*closed)
            yield pd.DataFrame({
                "vehicle_id": [key[0]] * len(closed), "start_time": pd.to_datetime(list(start), unit="us"),
                "end_time": pd.to_datetime(list(last), unit="us"), "gps_events": list(events)})

    def close(self) -> None:
        pass


def engine_trips(gps: DataFrame, gap_minutes: int = RATES.trip_gap_minutes, delay: str = "10 minutes") -> DataFrame:
    """Trips that are over: the next one began, the engine went OFF, or the pause has passed.

    A trip begins on a vehicle's first ping, after a longer pause than ``gap_minutes``, and on the ping after the engine was OFF. Pings later than
    the delay are left out. The state of a vehicle is the pings of the delay and one trip; it is empty after its last
    trip. Needs the RocksDB state store.
    """
    rows = gps.withWatermark("event_timestamp", delay).select("vehicle_id", "event_id", "event_timestamp", "engine_status")
    return rows.groupBy("vehicle_id").transformWithStateInPandas(
        TripSplitter(gap_minutes * 60_000_000), outputStructType=OUTPUT, outputMode="append", timeMode="EventTime")
