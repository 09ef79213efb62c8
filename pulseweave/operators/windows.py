"""Tumbling-window aggregates; the same code runs on tables and streams.

A stream needs a watermark (``with_event_time``) and append output; a window is
then written once, after it closes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pulseweave.functions.ids import stable_id
from pulseweave.functions.text import is_window_key, window_key, window_key_part


def with_event_time(records: DataFrame, delay: str, column: str = "ts") -> DataFrame:
    """Declare event time and how late a record may be.  No effect on tables."""
    return records.withWatermark(column, delay) if records.isStreaming else records


def patient_windows(records: DataFrame, size: str = "1 minute") -> DataFrame:
    """avg, min, max and count per patient, unit and tumbling window."""
    return (records.groupBy("patient_id", "unit", F.window("ts", size).alias("w"))
            .agg(F.avg("value").alias("avg_value"), F.min("value").alias("min_value"),
                 F.max("value").alias("max_value"), F.count("value").alias("n_records"))
            .select("patient_id", "unit", F.col("w.start").alias("ts"),
                    "avg_value", "min_value", "max_value", "n_records"))


def aggregated_records(aggregates: DataFrame, kind: str = "window") -> DataFrame:
    """Shape window or session aggregates into aggregated records.

    ``kind`` says what was aggregated, such as ``"window 1 minute"``; it is part of
    the id, as a window and a session of one series may have one moment.
    """
    parts = [F.lit("aggregate"), F.lit(kind), F.col("patient_id"), F.col("unit")]
    if "session_id" in aggregates.columns:
        parts.append(F.col("session_id"))
    return aggregates.select(
        stable_id(*parts, F.unix_micros("ts")).alias("id"), "patient_id", "ts", "unit",
        "avg_value", "min_value", "max_value")


def global_averages(records: DataFrame, size: str = "1 minute") -> DataFrame:
    """Average per unit and window over all patients.

    A unit is a hot key by nature; the average is combined inside each map task
    before the shuffle, which then moves one row per task, unit and window.
    """
    return (records.select("unit", "value", "ts")
            .groupBy("unit", F.window("ts", size).alias("w"))
            .agg(F.avg("value").alias("value"))
            .select("unit", F.col("w.start").alias("ts"), F.col("w.end").alias("end_ts"),
                    "value"))


def keyed_global_averages(averages: DataFrame) -> DataFrame:
    """Global averages in topic form: the window key as text, and the value."""
    return averages.select(
        window_key(F.col("unit"), F.unix_millis("ts"), F.unix_millis("end_ts")).alias("key"),
        "value")


def parse_global_averages(keyed: DataFrame) -> DataFrame:
    """Read unit and window start back from the key; other keys are dropped."""
    return keyed.filter(is_window_key(F.col("key"))).select(
        window_key_part(F.col("key"), 1).alias("unit"),
        F.timestamp_millis(window_key_part(F.col("key"), 2).try_cast("bigint")).alias("ts"),
        "value")
