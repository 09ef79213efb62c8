"""Per-series state machines for ``transformWithState``.

They run the same step functions as the batch scans.  A call costs milliseconds
whatever it is given, so the key of a call is a bucket of series: its state is a list
with a row per series, and the call goes through the bucket's series one by one.  Rows
arrive in any order within a micro-batch and are sorted there; what one call holds in
memory is one bucket's rows of one micro-batch, which the source's rate limit and the
number of buckets bound, and its states.  That number belongs to a query's state: keep
it over restarts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import Column, DataFrame, GroupedData, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from pulseweave.functions.times import micros
from pulseweave.operators.credits import KEYS, SessionScan, in_series, with_caps, with_moments
from pulseweave.operators.credits import SCAN_SCHEMA as SESSION_ROWS
from pulseweave.operators.drift import (SCAN_COLUMNS, SCAN_SCHEMA, STATE_SCHEMA, DriftCall,
                                        DriftWindow, drift_rows, series_rows)

RECORD, ALERT = 0, 1
BUCKETS = 512
SCANNED = ["max_credits", "min_credits", "us", "kind", "value", "is_alert"]
SESSION_COLUMNS = [field.split()[0] for field in SESSION_ROWS.split(", ")]


def _in_order(frames: Iterator[pd.DataFrame], columns: list[str]) -> pd.DataFrame:
    whole = pd.concat(list(frames), ignore_index=True)
    return whole.sort_values(columns, kind="stable")


def in_buckets(rows: DataFrame, buckets: int) -> GroupedData:
    return rows.withColumn("bucket", F.pmod(F.xxhash64(*KEYS), F.lit(buckets))).groupBy("bucket")


class SeriesProcessor(StatefulProcessor):
    """Runs the series of a bucket: a list of states, each of patient, unit and ``STATE``."""

    STATE = ""
    ORDER = ["us", "kind", "value"]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.states = handle.getListState("series", self._schema())

    def _schema(self) -> str:
        return f"patient_id string, unit string, {self.STATE}"

    def _load(self) -> dict[tuple, tuple]:
        return {row[:2]: row[2:] for row in self.states.get()}

    def _store(self, states: dict[tuple, tuple]) -> None:
        self.states.put([(*key, *state) for key, state in states.items()])

    def _ordered(self, rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
        return _in_order(rows, [*KEYS, *self.ORDER])

    @staticmethod
    def _series(frame: pd.DataFrame, *columns: str) -> Iterator[tuple[tuple, list[list]]]:
        """Each series of an ordered frame with these columns of its rows."""
        lists, at = [frame[c].tolist() for c in columns], 0
        for key, same in groupby(zip(frame["patient_id"].tolist(), frame["unit"].tolist())):
            start, at = at, at + sum(1 for _ in same)
            yield key, [values[start:at] for values in lists]

    def close(self) -> None:
        pass


class CreditSessions(SeriesProcessor):
    """Credit sessions fed by records (kind 0) and alerts (kind 1).

    With ``ttl_ms`` a series that has had no rows for so long begins anew; the list goes
    once its whole bucket has had none.
    """

    STATE = ("session_id bigint, credits bigint, grant bigint, n bigint, total double, "
             "lowest double, highest double, first_us bigint, seen_ms bigint")

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.states = handle.getListState("series", self._schema(), self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        states, closed = _alive(self._load(), self.ttl_ms, timerValues), []
        now = timerValues.getCurrentProcessingTimeInMs() if self.ttl_ms else 0
        for series, (caps, floors, *columns) in self._series(self._ordered(rows), *SCANNED):
            scan = SessionScan(int(caps[0]), int(floors[0]))
            if series in states:
                _resume(scan, states[series][:8])
            for us, kind, value, raises in zip(*columns):
                if kind == RECORD:
                    done = scan.step(us, value)
                    if done is not None:
                        closed.append((*series, *done))
                if kind == ALERT or raises:
                    scan.alert()
            states[series] = (*_kept(scan), now)
        self._store(states)
        if closed:
            yield pd.DataFrame.from_records(closed, columns=SESSION_COLUMNS)


def _alive(states: dict[tuple, tuple], ttl_ms: int | None, timerValues) -> dict[tuple, tuple]:
    """The states (which end in ``seen_ms``) without those that are too old."""
    if not ttl_ms:
        return states
    now = timerValues.getCurrentProcessingTimeInMs()
    return {key: state for key, state in states.items() if state[-1] + ttl_ms > now}


def _kept(scan: SessionScan) -> tuple:
    return (scan.session_id, scan.credits, scan.grant, scan.n, scan.total, scan.lowest,
            scan.highest, scan.first_us)


def _resume(scan: SessionScan, state: tuple) -> None:
    (scan.session_id, scan.credits, scan.grant, scan.n, scan.total, scan.lowest,
     scan.highest, scan.first_us) = state


def stream_credit_sessions(flagged: DataFrame, caps: DataFrame, alerts: DataFrame | None = None,
                           ttl_ms: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Full credit sessions of a stream.

    Alerts come either as an ``is_alert`` column of the records, or as a second
    stream in ``alerts`` (patient_id, unit, ts); pass one of the two.
    """
    rows = flagged
    if "is_alert" not in rows.columns:
        rows = rows.withColumn("is_alert", F.lit(False))
    rows = in_series(rows).select(*KEYS, "ts", "value", "is_alert", F.lit(RECORD).alias("kind"))
    if alerts is not None:
        known = [F.col(c).isNotNull() for c in (*KEYS, "ts")]
        rows = rows.unionByName(alerts.filter(known[0] & known[1] & known[2]).select(
            *KEYS, "ts", F.lit(0.0).alias("value"), F.lit(False).alias("is_alert"),
            F.lit(ALERT).alias("kind")))
    inputs = with_caps(rows, caps).withColumn("us", F.unix_micros("ts")).drop("ts")
    return with_moments(in_buckets(inputs, buckets).transformWithStateInPandas(
        CreditSessions(ttl_ms), outputStructType=SESSION_ROWS, outputMode="Update",
        timeMode="ProcessingTime" if ttl_ms else "None"))


class NumberBySession(SeriesProcessor):
    """Hands every record on with the id of its credit session."""

    STATE = "session_id bigint, credits bigint, grant bigint"
    ORDER = ["ts", "value"]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        states, frame, ids = self._load(), self._ordered(rows), []
        for series, (caps, floors, values, alerts) in self._series(
                frame, "max_credits", "min_credits", "value", "is_alert"):
            scan = SessionScan(int(caps[0]), int(floors[0]), states.get(series))
            for value, raises in zip(values, alerts):
                ids.append(scan.session_id)
                scan.step(0, value)
                if raises:
                    scan.alert()
            states[series] = (scan.session_id, scan.credits, scan.grant)
        self._store(states)
        yield frame[["patient_id", "unit", "ts", "value"]].assign(session_id=ids)


def sessionized_records(flagged: DataFrame, caps: DataFrame,
                        buckets: int = BUCKETS) -> DataFrame:
    """The stream of records keyed by (patient, unit, session).

    Event time is passed on, so gap sessions can follow in the same query:
    declare the watermark on the input.
    """
    rows = flagged
    if "is_alert" not in rows.columns:
        rows = rows.withColumn("is_alert", F.lit(False))
    return in_buckets(with_caps(in_series(rows), caps), buckets).transformWithStateInPandas(
        NumberBySession(),
        outputStructType="patient_id string, unit string, ts timestamp, value double, "
                         "session_id bigint",
        outputMode="Append", timeMode="EventTime", eventTimeColumnName="ts")


class DriftDetection(SeriesProcessor):
    """One drift window per series; one call per micro-batch."""

    STATE = f"{STATE_SCHEMA}, seen_ms bigint"
    ORDER = ["us", "value"]

    def __init__(self, emit: str, published: bool, ttl_ms: int | None):
        self.emit, self.published, self.ttl_ms = emit, published, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.names = [field.split()[0] for field in STATE_SCHEMA.split(", ")]
        self.states = handle.getListState("series", self._schema(), self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        states, found = _alive(self._load(), self.ttl_ms, timerValues), []
        now = timerValues.getCurrentProcessingTimeInMs() if self.ttl_ms else 0
        for series, (flags, values, times) in self._series(
                self._ordered(rows), "adaptive", "value", "us"):
            adaptive = bool(flags[0])
            resumed = series in states
            if resumed:
                window = DriftWindow.load(dict(zip(self.names, states[series])), adaptive,
                                          self.published)
            else:
                window = DriftWindow(adaptive, self.published)
            call = DriftCall(window, self.emit, resumed)
            if isinstance(times[0], float) and not any(map(math.isnan, times)):
                times = [int(us) for us in times]  # floats as another series lacks a time
            drifts = call.feed(values, times) + call.close()
            found += [(*series, *drift, None) for drift in drifts]
            stored = window.dump()
            states[series] = (*(stored[n] for n in self.names), now)
        self._store(states)
        if found:
            yield pd.DataFrame.from_records(found, columns=SCAN_COLUMNS)


def stream_drift(records: DataFrame, adaptive: Column | None = None, emit: str = "per_batch",
                 variant: str = "reference", ttl_ms: int | None = None,
                 buckets: int = BUCKETS) -> DataFrame:
    """Drifts of every series of a stream.

    State never expires unless ``ttl_ms`` is given.  With the default
    ``per_batch`` a series yields at most one row per micro-batch.
    """
    found = in_buckets(series_rows(records, adaptive), buckets).transformWithStateInPandas(
        DriftDetection(emit, variant == "paper", ttl_ms), outputStructType=SCAN_SCHEMA,
        outputMode="Update", timeMode="ProcessingTime" if ttl_ms else "None")
    return drift_rows(found)


class CarryOver(StatefulProcessor):
    """Runs along closed windows: latest record time so far, previous count.

    The input is one row per window over all keys, so one state is enough.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState(
            "last", "latest_us bigint, end_us bigint, n_records bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = _in_order(rows, ["start_us"])
        latest, last_end, last_n = self.state.get() if self.state.exists() else (None, None, 0)
        latest_us, previous = [], []
        for start, end, n, here in zip(*(frame[c].tolist() for c in (
                "start_us", "end_us", "n_records", "here_us"))):
            latest = here if latest is None else max(latest, here)
            latest_us.append(latest)
            previous.append(last_n if start == last_end else 0)
            last_end, last_n = end, n
        self.state.update((latest, last_end, last_n))
        yield frame[["start_us", "end_us", "n_records", "max_latency"]].assign(
            latest_us=latest_us, n_previous=previous)

    def close(self) -> None:
        pass


class ExpiringCreditSessions(SeriesProcessor):
    """Credit sessions of series that end: a series silent for longer than ``expire_us`` of
    event time loses its state, with the session that is open.  A record after that begins
    a new life: session 1 with the first credits.  Each session says when its life began.

    Silence within one micro-batch counts like silence between two, so results do not
    depend on how the stream is cut.  Every call frees the bucket's series that do not
    return, and a timer the last of them.
    """

    STATE = ("session_id bigint, credits bigint, grant bigint, n bigint, total double, "
             "lowest double, highest double, first_us bigint, since bigint, last bigint")

    def __init__(self, expire_us: int):
        self.expire_us = expire_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.handle = handle

    def _deadline(self, last_us: int) -> int:
        # Timers are in whole milliseconds; a series expires after, not at, the bound.
        return (last_us + self.expire_us) // 1000 + 1

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        states, closed = self._load(), []
        if states:
            self.handle.deleteTimer(self._deadline(max(s[-1] for s in states.values())))
        for series, (caps, floors, *columns) in self._series(self._ordered(rows), *SCANNED):
            cap, floor = int(caps[0]), int(floors[0])
            scan, since, last = SessionScan(cap, floor), None, None
            if series in states:
                *state, since, last = states[series]
                _resume(scan, state)
            for us, kind, value, raises in zip(*columns):
                if last is None or us - last > self.expire_us:
                    scan, since = SessionScan(cap, floor), us
                last = us
                if kind == RECORD:
                    done = scan.step(us, value)
                    if done is not None:
                        closed.append((*series, *done, since))
                if kind == ALERT or raises:
                    scan.alert()
            states[series] = (*_kept(scan), since, last)
        passed = timerValues.getCurrentWatermarkInMs()
        alive = {k: state for k, state in states.items() if self._deadline(state[-1]) > passed}
        self._store(alive)
        if alive:
            self.handle.registerTimer(self._deadline(max(s[-1] for s in alive.values())))
        if closed:
            yield pd.DataFrame.from_records(closed, columns=[*SESSION_COLUMNS, "since_us"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if all(self._deadline(state[-1]) <= expiredTimerInfo.getExpiryTimeInMs()
               for state in self._load().values()):
            self.states.clear()
        return iter(())


def stream_expiring_sessions(records: DataFrame, caps: DataFrame, expire: str,
                             delay: str, buckets: int = BUCKETS) -> DataFrame:
    """Full credit sessions of a stream whose series expire after ``expire`` without records;
    ``delay`` is how late records may be."""
    rows = in_series(records.withWatermark("ts", delay)).select(
        *KEYS, "ts", "value", F.lit(False).alias("is_alert"), F.lit(RECORD).alias("kind"),
        F.unix_micros("ts").alias("us"))
    found = in_buckets(with_caps(rows, caps), buckets).transformWithStateInPandas(
        ExpiringCreditSessions(micros(expire)),
        outputStructType=f"{SESSION_ROWS}, since_us bigint",
        outputMode="Append", timeMode="EventTime")
    return with_moments(found, F.timestamp_micros("since_us").alias("since"))


class Debounce(StatefulProcessor):
    """One row per burst of a key, sent once the key has been quiet for ``quiet_us``."""

    def __init__(self, quiet_us: int):
        self.quiet_us = quiet_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.burst = handle.getValueState("burst", "last bigint, n bigint")

    def _deadline(self, last_us: int) -> int:
        return -(-(last_us + self.quiet_us) // 1000)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last, n = self.burst.get() if self.burst.exists() else (None, 0)
        if last is not None:
            self.handle.deleteTimer(self._deadline(last))
        sent = []
        for us in _in_order(rows, ["us"])["us"].tolist():
            if last is not None and us - last >= self.quiet_us:
                sent.append((*key, last + self.quiet_us, n))
                n = 0
            last, n = us, n + 1
        self.burst.update((last, n))
        self.handle.registerTimer(self._deadline(last))
        if sent:
            yield self._frame(sent)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.burst.exists():
            last, n = self.burst.get()
            if self._deadline(last) <= expiredTimerInfo.getExpiryTimeInMs():
                self.burst.clear()
                yield self._frame([(*key, last + self.quiet_us, n)])

    @staticmethod
    def _frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame.from_records(rows, columns=["patient_id", "sent_us", "n_records"])


def debounced(records: DataFrame, quiet: str, delay: str, arrival: str = "arrival_ts") -> DataFrame:
    """(patient_id, sent_ts, n_records) of every burst of a patient's records by arrival."""
    rows = records.withWatermark(arrival, delay).select(
        "patient_id", arrival, F.unix_micros(arrival).alias("us")).filter("us IS NOT NULL")
    sent = rows.groupBy("patient_id").transformWithStateInPandas(
        Debounce(micros(quiet)), outputStructType="patient_id string, sent_us bigint, n_records bigint",
        outputMode="Append", timeMode="EventTime")
    return sent.select("patient_id", F.timestamp_micros("sent_us").alias("sent_ts"), "n_records")


def carry_over(windows: DataFrame) -> DataFrame:
    """Add ``latest_ts`` and ``n_previous`` to a stream of closed windows with
    columns window_start, window_end, n_records, latest_here and max_latency."""
    rows = windows.select(
        F.lit(0).alias("all"), F.unix_micros("window_start").alias("start_us"),
        F.unix_micros("window_end").alias("end_us"), "n_records",
        F.unix_micros("latest_here").alias("here_us"), "max_latency")
    carried = rows.groupBy("all").transformWithStateInPandas(
        CarryOver(),
        outputStructType="start_us bigint, end_us bigint, n_records bigint, max_latency bigint, "
                         "latest_us bigint, n_previous bigint",
        outputMode="Append", timeMode="None")
    return carried.select(
        F.timestamp_micros("start_us").alias("window_start"),
        F.timestamp_micros("end_us").alias("window_end"), "n_records",
        F.timestamp_micros("latest_us").alias("latest_ts"), "max_latency", "n_previous")
