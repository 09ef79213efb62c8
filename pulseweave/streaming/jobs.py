"""The streaming jobs, each from an input stream to a result stream.

Inputs are DataFrames: Kafka topics in production (``pulseweave.sources.kafka``
and ``avro``), file streams in tests.  Nothing here starts a query.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from pulseweave.dims import credit_caps, normal_ranges, unit_classes
from pulseweave.operators import alerts as al, batches, reads, routing, sessions, windows
from pulseweave.sources.tables import read_table
from pulseweave.streaming.processors import (sessionized_records, stream_credit_sessions,
                                             stream_drift)

# How late a record may be for each kind of window.
GLOBAL_GRACE = "30 seconds"
MINUTE_DELAY = "1 minute"
SESSION_GRACE = {"short": "40 seconds", "long": "70 seconds"}


def file_stream(spark: SparkSession, schema: str, path: str,
                files_per_batch: int | None = None) -> DataFrame:
    """A folder or glob of parquet files as a stream; the rate limit is a
    number of files per micro-batch."""
    reader = spark.readStream.schema(schema).format("parquet")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def flatten_job(hub_batches: DataFrame) -> DataFrame:
    return batches.flatten_batches(hub_batches)


def alert_job(records: DataFrame, ranges: DataFrame | None = None) -> DataFrame:
    spark = records.sparkSession
    return al.alerts(records, normal_ranges(spark) if ranges is None else ranges)


def minute_job(records: DataFrame, size: str = "1 minute",
               delay: str = MINUTE_DELAY) -> DataFrame:
    timed = windows.with_event_time(records, delay)
    return windows.aggregated_records(windows.patient_windows(timed, size), f"window {size}")


def global_average_job(records: DataFrame, size: str = "1 minute",
                       grace: str = GLOBAL_GRACE) -> DataFrame:
    timed = windows.with_event_time(records, grace)
    return windows.global_averages(timed, size)


def credit_session_job(records: DataFrame, alerts: DataFrame | None = None,
                       ranges: DataFrame | None = None,
                       caps: DataFrame | None = None) -> DataFrame:
    """Aggregated records of credit sessions, shrunk by alerts.

    Without an alert stream the alerts are found on the way, in the same stream.
    """
    spark = records.sparkSession
    caps = credit_caps(spark) if caps is None else caps
    if alerts is None:
        ranges = normal_ranges(spark) if ranges is None else ranges
        found = stream_credit_sessions(al.with_alert_flag(records, ranges), caps)
    else:
        found = stream_credit_sessions(records, caps, alerts)
    return windows.aggregated_records(found.withColumn("ts", F.col("last_ts")), "credit session")


def session_window_job(records: DataFrame, grace: str = "70 seconds",
                       classes: DataFrame | None = None,
                       caps: DataFrame | None = None,
                       gaps: dict[str, int] = sessions.SESSION_GAPS) -> DataFrame:
    """Gap sessions inside credit sessions, in one chained stateful query."""
    spark = records.sparkSession
    timed = windows.with_event_time(records, grace)
    numbered = sessionized_records(timed, credit_caps(spark) if caps is None else caps)
    return sessions.all_sessions(
        numbered, unit_classes(spark) if classes is None else classes, gaps)


def class_window_job(records: DataFrame, route: str, classes: DataFrame | None = None,
                     caps: DataFrame | None = None,
                     gaps: dict[str, int] = sessions.SESSION_GAPS,
                     graces: dict[str, str] = SESSION_GRACE) -> DataFrame:
    """Gap sessions inside credit sessions of one unit class, with its own grace.

    A query has one watermark, so classes that wait differently are queries of
    their own; ``session_window_job`` takes all classes with the longest grace.
    """
    spark = records.sparkSession
    classes = unit_classes(spark) if classes is None else classes
    chosen = routing.routed(records, classes, route)
    numbered = sessionized_records(windows.with_event_time(chosen, graces[route]),
                                   credit_caps(spark) if caps is None else caps)
    return sessions.class_sessions(numbered, classes, route, gaps)


def drift_job(records: DataFrame, **options) -> DataFrame:
    return stream_drift(records, **options)


def recently_alerted(root: str, window: str = "15 minutes",
                     top: int = 100) -> Callable[[SparkSession], DataFrame]:
    """The patients with most recent alerts, read again on every call: pass it
    to ``sinks.notification_target`` to follow whoever alerts at the moment."""
    def read(spark: SparkSession) -> DataFrame:
        table = read_table(spark, root, "alerts")
        return reads.with_alerts(
            reads.recent_patients(table, F.current_timestamp(), window, top))

    return read
