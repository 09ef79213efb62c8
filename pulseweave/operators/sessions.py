"""Inactivity-gap sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from pulseweave.dims import SESSION_GAPS
from pulseweave.functions.times import midpoint
from pulseweave.operators.routing import with_route


def _gap_micros(gaps: dict[str, int], route: Column) -> Column:
    chosen = F.lit(None).cast("bigint")
    for name, seconds in gaps.items():
        chosen = F.when(route == name, F.lit(seconds * 1_000_000).cast("bigint")).otherwise(chosen)
    return chosen


def merge_by_gap(records: DataFrame, keys: list[str], gap_us: Column,
                 ts: str = "ts", value: str = "value") -> DataFrame:
    """Sessions of a table: events at most ``gap_us`` apart belong together.

    Events that share a slot of gap length are always in one session, so each
    slot is reduced to one row first, by map-side aggregation.  What reaches the
    per-key ordering is at most (time range / gap) rows per key however many
    events the key has, so a hot key is no larger than a busy ordinary one.
    """
    us = F.unix_micros(ts)
    slots = (records.withColumn("gap_us", gap_us)
             .groupBy(*keys, "gap_us", (us - F.pmod(us, F.col("gap_us"))).alias("slot"))
             .agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"),
                  F.sum(value).alias("total"), F.count(value).alias("n"),
                  F.min(value).alias("lowest"), F.max(value).alias("highest")))
    by_time = W.partitionBy(*keys).orderBy("first_ts")
    quiet = F.unix_micros("first_ts") - F.unix_micros(F.lag("last_ts").over(by_time))
    opens = F.coalesce((quiet > F.col("gap_us")).cast("bigint"), F.lit(0))
    numbered = (slots.withColumn("opens", opens)
                .withColumn("session_no", F.sum("opens").over(
                    by_time.rowsBetween(W.unboundedPreceding, W.currentRow))))
    # The keys are clustered already: no further exchange.
    return (numbered.groupBy(*keys, "session_no")
            .agg(F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"),
                 F.sum("total").alias("total"), F.sum("n").alias("n_records"),
                 F.min("lowest").alias("min_value"), F.max("highest").alias("max_value"))
            .withColumn("avg_value", F.col("total") / F.col("n_records"))
            .drop("session_no", "total"))


def _stream_sessions(records: DataFrame, keys: list[str], gap: Column) -> DataFrame:
    # The session key must appear as is in the aggregation for the planner to
    # see it; first and last come from the records, since the window's own end
    # is the last record plus the gap.
    return (records.groupBy(*keys, F.session_window("ts", gap).alias("w"))
            .agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
                 F.count("value").alias("n_records"), F.min("value").alias("min_value"),
                 F.max("value").alias("max_value"), F.avg("value").alias("avg_value"))
            .drop("w"))


def gap_sessions(records: DataFrame, keys: list[str], gap_seconds: int) -> DataFrame:
    """Sessions with one gap for all keys, on a table or a stream."""
    if records.isStreaming:
        return _stream_sessions(records, keys, F.lit(f"{gap_seconds} seconds"))
    return merge_by_gap(records, keys, F.lit(gap_seconds * 1_000_000).cast("bigint"))


def _with_midpoint(sessions: DataFrame, keys: list[str]) -> DataFrame:
    return sessions.select(
        *keys, midpoint(F.col("first_ts"), F.col("last_ts")).alias("ts"),
        "avg_value", "min_value", "max_value", "n_records")


def class_sessions(records: DataFrame, classes: DataFrame, route: str,
                   gaps: dict[str, int] = SESSION_GAPS) -> DataFrame:
    """Session aggregates of the units of one class, timed at mid-session."""
    keys = _session_keys(records)
    chosen = with_route(records, classes).filter(F.col("route") == route)
    return _with_midpoint(gap_sessions(chosen, keys, gaps[route]), keys)


def all_sessions(records: DataFrame, classes: DataFrame,
                 gaps: dict[str, int] = SESSION_GAPS) -> DataFrame:
    """Sessions of every class in one pass, each unit with its class's gap.

    Equal to the union of ``class_sessions`` over the classes, with one scan
    and one shuffle instead of one of each per class.
    """
    keys = _session_keys(records)
    chosen = with_route(records, classes).filter(F.col("route").isin(*gaps))
    if records.isStreaming:
        gap = F.lit(None).cast("string")
        for name, seconds in gaps.items():
            gap = F.when(F.col("route") == name, F.lit(f"{seconds} seconds")).otherwise(gap)
        sessions = _stream_sessions(chosen, keys, gap)
    else:
        sessions = merge_by_gap(chosen, keys, _gap_micros(gaps, F.col("route")))
    return _with_midpoint(sessions, keys)


def _session_keys(records: DataFrame) -> list[str]:
    """Records already numbered by credit session are grouped by that too."""
    keys = ["patient_id", "unit"]
    return keys + ["session_id"] if "session_id" in records.columns else keys
