"""Credit sessions: sessions counted in records rather than in time.

A session lasts a number of records, its credits.  Each new session is granted
one more record than the one before, up to the unit's cap.  An alert takes one
record off the next grant and halves what is left of the running session.

One rule for odd records in the closed form, the scan with alerts and the stream:
a record without patient, unit or moment belongs to no series and is left out; a
record without value counts, as one whose value is NaN, and NaN takes over its
session's average, minimum and maximum.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pulseweave.functions.times import slot_start
from pulseweave.operators.ordering import key_at, runs, to_batch, values_of, with_position

KEYS = ["patient_id", "unit"]
CAPS = ["max_credits", "min_credits"]
DEFAULT_CAP = 40

# What a scan hands back: moments stay epoch microseconds in Python.
SCAN_SCHEMA = (
    "patient_id string, unit string, session_id bigint, first_us bigint, "
    "last_us bigint, n_records bigint, avg_value double, min_value double, "
    "max_value double"
)


def in_series(records: DataFrame) -> DataFrame:
    """Records that belong to a series, with NaN for no value."""
    known = F.col("patient_id").isNotNull() & F.col("unit").isNotNull() & F.col("ts").isNotNull()
    return records.filter(known).withColumn("value", F.coalesce("value", F.lit(float("nan"))))


def _value_aggregates() -> list[Column]:
    """Average, minimum and maximum of a session; NaN takes over each of them."""
    lowest = F.when(F.bool_or(F.isnan("value")), F.lit(float("nan"))).otherwise(F.min("value"))
    return [F.avg("value").alias("avg_value"), lowest.alias("min_value"),
            F.max("value").alias("max_value")]


def with_caps(records: DataFrame, caps: DataFrame, default_cap: int = DEFAULT_CAP) -> DataFrame:
    """Look the credit caps up; a unit that is not listed gets the default."""
    return (records.join(caps, "unit", "left")
            .withColumn("max_credits", F.coalesce("max_credits", F.lit(default_cap)).cast("int"))
            .withColumn("min_credits", F.coalesce("min_credits", F.lit(1)).cast("int")))


def session_number(position: Column, cap: Column) -> Column:
    """0-based session of the record at a 1-based position, without alerts.

    Lengths run 1, 1, 2, 3, ..., cap, cap, ...: the growing part ends after
    1 + cap(cap+1)/2 records and follows the triangular numbers.
    """
    r = (position - 1).cast("bigint")
    growing = cap * (cap + 1) / 2
    in_growth = F.ceil((F.sqrt(8 * r + 1) - 1) / 2)
    at_cap = cap + F.ceil((r - growing) / cap)
    return (F.when(r == 0, 0).when(r <= growing, in_growth).otherwise(at_cap)).cast("bigint")


def session_length(number: Column, cap: Column) -> Column:
    """Records in the 0-based session ``number`` once it is full."""
    return F.when(number == 0, 1).otherwise(F.least(number, cap.cast("bigint")))


def with_session_id(records: DataFrame, caps: DataFrame, default_cap: int = DEFAULT_CAP,
                    slot: str = "1 hour") -> DataFrame:
    """Records with the 1-based id of their credit session, without alerts."""
    placed = with_caps(with_position(in_series(records), KEYS, slot), caps, default_cap)
    number = session_number(F.col("position"), F.col("max_credits"))
    return placed.withColumn("session_id", number + 1)


def credit_sessions(records: DataFrame, caps: DataFrame, default_cap: int = DEFAULT_CAP,
                    slot: str = "1 hour") -> DataFrame:
    """Aggregates of the full credit sessions of a table, without alerts."""
    numbered = with_session_id(records, caps, default_cap, slot)
    full = session_length(F.col("session_id") - 1, F.col("max_credits"))
    return (numbered.groupBy(*KEYS, "session_id", "max_credits")
            .agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
                 F.count("*").alias("n_records"), *_value_aggregates())
            .filter(F.col("n_records") == full)
            .drop("max_credits"))


# --- the step, for one series ------------------------------------------------
#
# State of a series between records: session number, credits left, next grant.

def start_state() -> tuple[int, int, int]:
    return 1, 0, 1


def on_alert(credits: int, grant: int, floor: int) -> tuple[int, int]:
    """An alert's effect on (credits left, next grant)."""
    return credits // 2, max(grant - 1, floor)


class SessionScan:
    """Runs one series record by record; ``step`` returns a closed session."""

    __slots__ = ("session_id", "credits", "grant", "cap", "floor", "n", "total",
                 "lowest", "highest", "first_us")

    def __init__(self, cap: int, floor: int, state: tuple[int, int, int] | None = None):
        self.session_id, self.credits, self.grant = state or start_state()
        self.cap, self.floor = cap, floor
        self.clear()

    def clear(self) -> None:
        self.n, self.total, self.first_us = 0, 0.0, 0
        self.lowest, self.highest = float("inf"), float("-inf")

    def step(self, us: int, value: float):
        if self.n == 0:
            self.first_us = us
        self.n += 1
        self.total += value
        if value < self.lowest or value != value:
            self.lowest = value
        if value > self.highest or value != value:
            self.highest = value
        self.credits -= 1
        if self.credits > 0:
            return None
        closed = (self.session_id, self.first_us, us, self.n, self.total / self.n,
                  self.lowest, self.highest)
        self.session_id += 1
        self.credits = self.grant
        self.grant = min(self.grant + 1, self.cap)
        self.clear()
        return closed

    def alert(self) -> None:
        self.credits, self.grant = on_alert(self.credits, self.grant, self.floor)


def with_moments(scanned: DataFrame, *extra: Column) -> DataFrame:
    """Scan output with timestamps for the session's first and last record."""
    return scanned.select(
        *KEYS, "session_id", F.timestamp_micros("first_us").alias("first_ts"),
        F.timestamp_micros("last_us").alias("last_ts"), "n_records", "avg_value",
        "min_value", "max_value", *extra)


def session_ends(alert_at: list[int], n: int, credits: int, grant: int, cap: int,
                 floor: int) -> tuple[list[int], int, int]:
    """Which of the next ``n`` records close a session, and the state after them.

    ``alert_at`` are the records that raise an alert.  The loop goes from event
    to event (a session that closes, an alert), not from record to record.
    """
    ends, at, pending = [], 0, iter(alert_at)
    alert = next(pending, n)
    while at < n:
        end = at + max(credits, 1) - 1
        if alert < min(end, n):
            credits, grant = on_alert(credits - (alert - at + 1), grant, floor)
            at, alert = alert + 1, next(pending, n)
        elif end < n:
            ends.append(end)
            credits, grant = grant, min(grant + 1, cap)
            at = end + 1
            if alert == end:
                credits, grant = on_alert(credits, grant, floor)
                alert = next(pending, n)
        else:
            credits -= n - at
            at = n
    return ends, credits, grant


def _inputs(flagged: DataFrame, caps: DataFrame, default_cap: int, *extra: str) -> DataFrame:
    return with_caps(flagged, caps, default_cap).select(
        *KEYS, F.unix_micros("ts").alias("us"), "value", "is_alert",
        "max_credits", "min_credits", *extra)


def credit_sessions_with_alerts(flagged: DataFrame, caps: DataFrame,
                                default_cap: int = DEFAULT_CAP,
                                slot: str = "1 hour") -> DataFrame:
    """Full credit sessions of a table whose records carry ``is_alert``.

    A record is counted before the alert it raises.  Every series is cut into time
    slots, which are scanned in parallel, so a series that holds a large share of
    all records spreads over its slots.
    """
    rows = _inputs(in_series(flagged), caps, default_cap)
    return with_moments(_sessions_by_slot(rows, slot))


# --- slots -----------------------------------------------------------------------
#
# (credits left, next grant) takes only cap * (cap + 1) values, so what a time
# slot does to a series is a table: for every state at the slot's start, the
# state at its end and how many sessions were closed.  Slots compute their
# tables in parallel; following the tables slot by slot gives the state each
# slot starts with; then all slots are scanned in parallel from those states.
# What a slot hands on is the smaller of two encodings of the same effect: its
# alert flags, one byte per record, or its table.  Both give the same states.

def _table_bytes(cap: int) -> int:
    return cap * (cap + 1) * 3 * 8


def _all_states(cap: int) -> tuple[np.ndarray, np.ndarray]:
    grants, credits = np.meshgrid(np.arange(1, cap + 1), np.arange(0, cap + 1))
    return credits.ravel(), grants.ravel()


def _state_index(credits: int, grant: int, cap: int) -> int:
    return credits * cap + grant - 1


class SlotEffect:
    """What a run of records does to every possible starting state."""

    def __init__(self, cap: int, floor: int):
        self.cap, self.floor = cap, floor
        self.credits, self.grants = _all_states(cap)
        self.closed = np.zeros(len(self.credits), dtype=np.int64)
        # Starting states that have become equal share one row from then on,
        # but for the sessions they have closed so far.
        self.row_of = np.arange(len(self.credits))
        self.base = np.zeros(len(self.credits), dtype=np.int64)
        self.seen = 0

    def step(self, is_alert: bool) -> None:
        left = self.credits - 1
        renewed = left <= 0
        self.credits = np.where(renewed, self.grants, left)
        self.grants = np.where(renewed, np.minimum(self.grants + 1, self.cap), self.grants)
        self.closed += renewed
        if is_alert:
            self.credits //= 2
            self.grants = np.maximum(self.grants - 1, self.floor)
        self.seen += 1
        if self.seen in (16, 64, 256) or self.seen % 4096 == 0:
            self._merge()

    def _merge(self) -> None:
        code = self.credits * (self.cap + 1) + self.grants
        kept, inverse = np.unique(code, return_inverse=True)
        if len(kept) == len(code):
            return
        self.base += self.closed[self.row_of]
        self.row_of = inverse[self.row_of]
        self.credits, self.grants = kept // (self.cap + 1), kept % (self.cap + 1)
        self.closed = np.zeros(len(kept), dtype=np.int64)

    def table(self) -> np.ndarray:
        """One row per starting state: credits and grant at the end, closed."""
        closed = self.base + self.closed[self.row_of]
        return np.stack([self.credits[self.row_of], self.grants[self.row_of], closed], axis=1)


def _advance(state: tuple[int, int, int], flags: bytes, cap: int,
             floor: int) -> tuple[int, int, int]:
    alert_at = np.flatnonzero(np.frombuffer(flags, dtype=np.uint8)).tolist()
    ends, credits, grant = session_ends(alert_at, len(flags), *state[1:], cap, floor)
    return state[0] + len(ends), credits, grant


class SlotSummary:
    """Collects one slot: its flags while they are few, then its table."""

    def __init__(self, cap: int, floor: int):
        self.cap, self.floor = cap, floor
        self.flags, self.effect = bytearray(), None

    def feed(self, flags: np.ndarray) -> None:
        if self.effect is None:
            self.flags += flags.astype(np.uint8).tobytes()
            if len(self.flags) <= _table_bytes(self.cap):
                return
            self.effect, flags = SlotEffect(self.cap, self.floor), self.flags
        for flag in flags:
            self.effect.step(bool(flag))

    def row(self) -> tuple[int, int, bytes | None, bytes | None]:
        if self.effect is None:
            return self.cap, self.floor, bytes(self.flags), None
        return self.cap, self.floor, None, self.effect.table().tobytes()


_EFFECT_SCHEMA = ("patient_id string, unit string, slot bigint, max_credits int, "
                  "min_credits int, flags binary, effect binary")
_EFFECTS = pa.schema([
    ("patient_id", pa.string()), ("unit", pa.string()), ("slot", pa.int64()),
    ("max_credits", pa.int32()), ("min_credits", pa.int32()), ("flags", pa.binary()),
    ("effect", pa.binary())])
_ENTRY_SCHEMA = ("patient_id string, unit string, slot bigint, session_id bigint, "
                 "credits int, grant int")
_ENTRIES = pa.schema([
    ("patient_id", pa.string()), ("unit", pa.string()), ("slot", pa.int64()),
    ("session_id", pa.int64()), ("credits", pa.int32()), ("grant", pa.int32())])
_SLOT = [*KEYS, "slot"]


def _slot_effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current, slot = None, None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        flags, done = values_of(batch, "is_alert"), []
        for start, end in runs(batch, _SLOT):
            key = key_at(batch, _SLOT, start)
            if key != current:
                if current is not None:
                    done.append((*current, *slot.row()))
                current, slot = key, SlotSummary(*key_at(batch, CAPS, start))
            slot.feed(flags[start:end])
        if done:
            yield to_batch(done, _EFFECTS)
    if current is not None:
        yield to_batch([(*current, *slot.row())], _EFFECTS)


def _slot_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Follow the slots of each series in order; one small row per slot."""
    current, state = None, start_state()
    for batch in batches:
        entries = []
        for row in batch.to_pylist():
            key = (row["patient_id"], row["unit"])
            if key != current:
                current, state = key, start_state()
            session_id, credits, grant = state
            entries.append((*key, row["slot"], session_id, credits, grant))
            if row["effect"] is None:
                state = _advance(state, row["flags"], row["max_credits"], row["min_credits"])
            else:
                table = np.frombuffer(row["effect"], dtype=np.int64).reshape(-1, 3)
                ends = table[_state_index(credits, grant, row["max_credits"])]
                state = (session_id + int(ends[2]), int(ends[0]), int(ends[1]))
        if entries:
            yield to_batch(entries, _ENTRIES)


def _number_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Session of each record of a slot; the slot's entry state is its first row."""
    state = start_state()
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        is_entry = values_of(batch, "is_entry")
        alert_rows = np.flatnonzero(values_of(batch, "is_alert"))
        closes, ids = np.zeros(n, dtype=bool), np.zeros(n, dtype=np.int64)
        for start, end in runs(batch, _SLOT):
            if is_entry[start]:
                state = key_at(batch, ["session_id", "credits", "grant"], start)
                start += 1
            if start == end:
                continue
            session_id, credits, grant = state
            low, high = np.searchsorted(alert_rows, (start, end))
            ends, credits, grant = session_ends(
                (alert_rows[low:high] - start).tolist(), end - start, credits, grant,
                *key_at(batch, CAPS, start))
            closes[[start + e for e in ends]] = True
            ids[start:end] = session_id + np.cumsum(closes[start:end]) - closes[start:end]
            state = (session_id + len(ends), credits, grant)
        kept = [batch.column(name) for name in (*KEYS, "us", "value")]
        yield pa.RecordBatch.from_arrays(
            [*kept, pa.array(ids), pa.array(closes)],
            names=[*KEYS, "us", "value", "session_id", "closes"]).filter(pa.array(~is_entry))


def _sessions_by_slot(rows: DataFrame, slot: str) -> DataFrame:
    slotted = rows.withColumn("slot", slot_start(F.timestamp_micros("us"), slot))
    effects = (slotted.select(*_SLOT, "us", "value", "is_alert", *CAPS)
               .repartition(*_SLOT).sortWithinPartitions(*_SLOT, "us", "value")
               .mapInArrow(_slot_effects, _EFFECT_SCHEMA))
    entries = (effects.repartition(*KEYS).sortWithinPartitions(*_SLOT)
               .mapInArrow(_slot_entries, _ENTRY_SCHEMA))
    # A slot's entry state travels as one more row of the slot, in front of its
    # records: one shuffle brings both to one task, whatever the sizes.
    state = ["session_id", "credits", "grant"]
    records = slotted.select(*_SLOT, F.lit(False).alias("is_entry"), "us", "value", "is_alert",
                             *CAPS, F.lit(0).cast("bigint").alias("session_id"),
                             F.lit(0).alias("credits"), F.lit(0).alias("grant"))
    states = entries.select(*_SLOT, F.lit(True).alias("is_entry"),
                            F.lit(0).cast("bigint").alias("us"), F.lit(0.0).alias("value"),
                            F.lit(False).alias("is_alert"), F.lit(0).alias(CAPS[0]),
                            F.lit(0).alias(CAPS[1]), *state)
    numbered = (records.unionByName(states).repartition(*_SLOT)
                .sortWithinPartitions(*_SLOT, F.desc("is_entry"), "us", "value")
                .mapInArrow(_number_records,
                             "patient_id string, unit string, us bigint, value double, "
                             "session_id bigint, closes boolean"))
    # A session may span slots; its last record says whether it was full.
    return (numbered.groupBy(*KEYS, "session_id")
            .agg(F.min("us").alias("first_us"), F.max("us").alias("last_us"),
                 F.count("*").alias("n_records"), *_value_aggregates(),
                 F.bool_or("closes").alias("full"))
            .filter("full").drop("full"))
