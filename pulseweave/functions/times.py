"""Time expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

UNITS_US = {"millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
            "hour": 3_600_000_000, "day": 86_400_000_000, "week": 604_800_000_000}


def micros(duration: str) -> int:
    """Length of a text like ``40 seconds`` in microseconds."""
    amount, unit = duration.split()
    return int(amount) * UNITS_US[unit.rstrip("s")]


def to_millis(ts: Column) -> Column:
    return F.unix_millis(ts)


def from_millis(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def truncated(grain: str, ts: Column) -> Column:
    """Start of the hour or day; the partition column of a stored table."""
    return F.date_trunc(grain, ts)


def at(moment: Column | dt.datetime | str) -> Column:
    """A point in time as a column; text is read in the session time zone."""
    if isinstance(moment, Column):
        return moment
    if isinstance(moment, str):
        return F.lit(moment).cast("timestamp")
    return F.lit(moment)


def before(now: Column | dt.datetime | str, duration: str) -> Column:
    """``now`` minus a duration like ``15 minutes``."""
    return at(now) - F.expr(f"INTERVAL {duration}")


def latency_ms(now: Column, ts: Column) -> Column:
    """Milliseconds from a record's own time to the time it was seen."""
    return F.unix_millis(now) - F.unix_millis(ts)


def midpoint(first: Column, last: Column) -> Column:
    """Middle of two moments in whole milliseconds."""
    return F.timestamp_millis(F.shiftright(F.unix_millis(first) + F.unix_millis(last), 1))


def slot_start(ts: Column, duration: str) -> Column:
    """Start of the fixed slot a moment falls in, as epoch microseconds."""
    width = F.lit(micros(duration)).cast("bigint")
    us = F.unix_micros(ts)
    return us - F.pmod(us, width)
