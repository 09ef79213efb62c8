"""Registered queries over running streams: state that closes, ages out and survives a stop.

The events are laid out in time slices, one per micro-batch.  A last slice holds one late
marker row per unit class, which moves the watermarks past all data, so that every window,
session and timer fires and results equal those of SQL over the table.
"""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F

from pulseweave.dims import credit_caps, normal_ranges
from pulseweave.operators import meters, notify, series
from pulseweave.plans import settings as s
from pulseweave.plans.catalog import (_classes, _ms, _records, _rounded, _subscribers, query)
from pulseweave.schemas import AGGREGATED_RECORDS, ALERTS, SESSION_WINDOWS, TableSpec
from pulseweave.plans.slices import open_slices, slices
from pulseweave.session import shared_dir
from pulseweave.sinks import table_log
from pulseweave.sinks.tables import append_table, read_stored, stored_rows
from pulseweave.sources.tables import as_sensor_records, events, with_arrival
from pulseweave.streaming import sinks
from pulseweave.streaming.jobs import alert_job, class_window_job, minute_job
from pulseweave.streaming.processors import debounced, stream_expiring_sessions

ARRIVING = "patient_id string, unit string, ts timestamp, value double, arrival_ts timestamp"
MARKER = "marker"
AFTER_ALL = "2100-01-01 00:00:00"
SUBSCRIBERS = TableSpec(
    name="subscriptions", columns={"patient_id": "patient_id", "ts": "ts"}, time="ts",
    partition="ts_day", grain="day", cluster="patient_id", trigger="2 seconds")


# --- inputs ---------------------------------------------------------------------------

def _arriving(spark: SparkSession, folder: str) -> DataFrame:
    rows = with_arrival(events(spark, folder))
    return as_sensor_records(rows, "arrival_ts")


def _marker(spark: SparkSession) -> DataFrame:
    units = ", ".join(f"('{u}')" for u in s.CAPS)
    return spark.sql(f"""
        SELECT '{MARKER}' AS patient_id, unit, TIMESTAMP'{AFTER_ALL}' AS ts,
               CAST(50 AS DOUBLE) AS value, TIMESTAMP'{AFTER_ALL}' AS arrival_ts
        FROM VALUES {units} AS t(unit)""")


def _run(rows: DataFrame, target: sinks.Target, checkpoint: str) -> None:
    sinks.fan_out(rows, {"target": target}, {}, checkpoint).awaitTermination()


def _collected(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """What an append stream emits, stored batch by batch."""
    root = shared_dir(spark, "stream")

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")

    _run(rows, keep, shared_dir(spark, "checkpoint"))
    return spark.read.parquet(root).select(rows.columns)


# --- windows and sessions -------------------------------------------------------------

@query
def stream_sessions(spark: SparkSession, folder: str) -> DataFrame:
    """Gap sessions inside credit sessions: one query per unit class, each with its grace,
    into one table; both are stopped after the first slices and started again."""
    laid = slices(spark, _arriving(spark, folder), _marker(spark))
    root = shared_dir(spark, "sessions")
    checks = {route: shared_dir(spark, f"checkpoint-{route}") for route in s.GAPS}
    for parts in ("[01]", "*"):
        for route, check in checks.items():
            found = class_window_job(open_slices(spark, laid, ARRIVING, parts).drop("arrival_ts"), route,
                                     _classes(spark), credit_caps(spark, s.CAPS), s.GAPS)
            _run(found, sinks.table_target(SESSION_WINDOWS, root, route), check)
    found = read_stored(spark, SESSION_WINDOWS, root).filter(F.col("patient_id") != MARKER)
    return _ms(_rounded(found.drop(SESSION_WINDOWS.partition), "avg_value"), "ts")


@query
def stream_resumed(spark: SparkSession, folder: str) -> DataFrame:
    """Daily aggregates of a query that stops with a batch's rows written and not committed,
    and goes on from its checkpoint.  Any failure but that stop is raised."""
    laid = slices(spark, _records(spark, folder), _marker(spark).drop("arrival_ts"))
    root, check = shared_dir(spark, "resumed"), shared_dir(spark, "checkpoint")
    path = table_log.table_path(AGGREGATED_RECORDS, root)
    store = sinks.table_target(AGGREGATED_RECORDS, root, "daily")
    stopped = []

    def stop_half_way(batch: DataFrame, batch_id: int) -> None:
        if batch_id == 2:
            table_log.write_rows(stored_rows(batch, AGGREGATED_RECORDS), AGGREGATED_RECORDS,
                                 path, "daily", batch_id)
            stopped.append(batch_id)
            raise RuntimeError("stopped between data and manifest")
        store(batch, batch_id)

    try:
        _run(minute_job(open_slices(spark, laid), "1 day"), stop_half_way, check)
    except StreamingQueryException:
        if not stopped:
            raise
    if not stopped:
        raise RuntimeError("the query was to stop in its third batch and did not")
    _run(minute_job(open_slices(spark, laid), "1 day"), store, check)
    found = read_stored(spark, AGGREGATED_RECORDS, root).filter(F.col("patient_id") != MARKER)
    return _ms(_rounded(found.drop(AGGREGATED_RECORDS.partition), "avg_v"), "ts")


@query
def stream_expiry(spark: SparkSession, folder: str) -> DataFrame:
    """Credit sessions of series that start anew after two days without records."""
    laid = slices(spark, _arriving(spark, folder), _marker(spark))
    rows = open_slices(spark, laid, ARRIVING).drop("arrival_ts")
    found = _collected(spark, stream_expiring_sessions(rows, credit_caps(spark, s.CAPS),
                                                       s.EXPIRE, "1 minute"))
    found = found.filter(F.col("patient_id") != MARKER)
    return _ms(_rounded(found, "avg_value"), "first_ts", "last_ts", "since")


# --- meters ---------------------------------------------------------------------------

@query
def stream_latency_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Latencies per arrival window of 1 and 15 minutes, percentiles from counts."""
    laid = slices(spark, _arriving(spark, folder), _marker(spark))
    out = None
    for size in ("1 minute", "15 minutes"):
        rows = open_slices(spark, laid, ARRIVING).withWatermark("arrival_ts", s.ARRIVAL_DELAY)
        found = _collected(spark, meters.latency_stats(rows, size))
        found = found.filter(F.col("window_start") < F.lit(AFTER_ALL).cast("timestamp"))
        found = found.withColumn("size", F.lit(size))
        out = found if out is None else out.unionByName(found)
    return _ms(_rounded(out, "avg_latency"), "window_start")


@query
def stream_throughput(spark: SparkSession, folder: str) -> DataFrame:
    """Records per arrival hour and the latest record time so far, carried from window to
    window; arrivals are out of order within the watermark."""
    laid = slices(spark, _arriving(spark, folder), _marker(spark))
    rows = open_slices(spark, laid, ARRIVING).withWatermark("arrival_ts", s.ARRIVAL_DELAY)
    found = _collected(spark, meters.record_throughput(rows, "1 hour"))
    found = found.filter(F.col("window_start") < F.lit(AFTER_ALL).cast("timestamp"))
    return _ms(found, "window_start", "latest_ts")


# --- sinks ----------------------------------------------------------------------------

@query
def stream_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """Alerts stored in chunks of a fixed number of rows, and the size of each; one batch is
    written twice."""
    laid = slices(spark, _records(spark, folder))
    root = shared_dir(spark, "chunks")
    store = sinks.chunk_target(ALERTS, root, "chunks", s.CHUNK_ROWS)

    def twice(batch: DataFrame, batch_id: int) -> None:
        store(batch, batch_id)
        if batch_id == 1:
            store(batch, batch_id)

    twice.reads_again = True  # type: ignore[attr-defined]
    _run(alert_job(open_slices(spark, laid), normal_ranges(spark, s.RANGES)), twice,
         shared_dir(spark, "checkpoint"))
    stored = read_stored(spark, ALERTS, root)
    return stored.groupBy(F.col("batch").cast("bigint").alias("batch"), "chunk").agg(
        F.count("*").alias("n_rows"))


@query
def stream_accepted(spark: SparkSession, folder: str) -> DataFrame:
    """What a table has accepted per writer: a query that fails after a commit and runs on."""
    laid = slices(spark, _records(spark, folder))
    root, check = shared_dir(spark, "accepted"), shared_dir(spark, "checkpoint")
    store = sinks.table_target(ALERTS, root, "alerts", patients=True)

    def fail_after_commit(batch: DataFrame, batch_id: int) -> None:
        store(batch, batch_id)
        if batch_id == 1:
            raise RuntimeError("stopped before the batch was noted as done")

    fail_after_commit.reads_again = True  # type: ignore[attr-defined]
    for target in (fail_after_commit, store):
        rows = alert_job(open_slices(spark, laid), normal_ranges(spark, s.RANGES))
        try:
            _run(rows, target, check)
        except StreamingQueryException:
            pass
    return table_log.accepted(spark, table_log.table_path(ALERTS, root))


@query
def stream_subscriptions(spark: SparkSession, folder: str) -> DataFrame:
    """Alerts of patients who are subscribed when the batch comes: the set grows at every
    slice, and a batch that is tried again after it has grown keeps its own set."""
    laid = slices(spark, _records(spark, folder))
    root = shared_dir(spark, "polled")
    people = _records(spark, folder).select("patient_id").distinct()
    third = F.pmod(F.crc32("patient_id"), F.lit(3))

    def subscribe(batch_id: int) -> None:
        chosen = people.filter(third == batch_id % 3).withColumn(
            "ts", F.lit(s.HALF).cast("timestamp"))
        append_table(chosen, SUBSCRIBERS, root)

    def send(rows: DataFrame, batch_id: int) -> None:
        rows.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").parquet(
            f"{root}/sent/batch_id={batch_id}")

    push = sinks.notification_target(
        notify.alert_events, sinks.subscribed_at(SUBSCRIBERS, root, "push"), send,
        per_batch=True)

    def poll(batch: DataFrame, batch_id: int) -> None:
        push(batch, batch_id)
        subscribe(batch_id + 1)
        if batch_id == 1:
            push(batch, batch_id)

    poll.reads_again = True  # type: ignore[attr-defined]
    subscribe(0)
    _run(alert_job(open_slices(spark, laid), normal_ranges(spark, s.RANGES)), poll,
         shared_dir(spark, "checkpoint"))
    sent = spark.read.parquet(f"{root}/sent")
    return _ms(sent.select("id", "channel", "ts", F.col("batch").cast("bigint").alias("batch")),
               "ts")


@query
def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Points of a stream that sends every record twice, kept once within the bound."""
    laid = slices(spark, _records(spark, folder))
    again = open_slices(spark, laid).withColumn("twice", F.explode(F.array(F.lit(0), F.lit(1))))
    found = series.dedup_within(again.drop("twice"), ["patient_id", "unit", "ts"], "1 hour")
    return _ms(_collected(spark, found), "ts")


@query
def stream_debounced(spark: SparkSession, folder: str) -> DataFrame:
    """Bursts of subscribed patients' records, sent once the patient has been quiet."""
    laid = slices(spark, _arriving(spark, folder), _marker(spark))
    watched = _subscribers(_records(spark, folder))
    rows = notify.subscribed(open_slices(spark, laid, ARRIVING), watched.union(
        spark.sql(f"SELECT '{MARKER}' AS patient_id")))
    found = _collected(spark, debounced(rows, f"{s.QUIET_SECONDS} seconds", s.ARRIVAL_DELAY))
    return _ms(found.filter(F.col("patient_id") != MARKER).select(
        F.col("patient_id").alias("channel"), F.lit(notify.NEW_RECORDS).alias("event"),
        "sent_ts", "n_records"), "sent_ts")
