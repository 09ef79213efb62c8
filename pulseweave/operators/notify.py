"""Notifications for subscribed patients."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pulseweave.operators.meters import ARRIVAL
from pulseweave.operators.sessions import gap_sessions

# Event names, the debounce time and the reporting period.
NEW_ALERT = "newAlert"
NEW_RECORDS = "newRecords"
DEBOUNCE_SECONDS = 10
REPORT_PERIOD = "10 seconds"


def subscribed(rows: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Rows of patients that someone listens to."""
    return rows.join(subscriptions.select("patient_id"), "patient_id", "left_semi")


def alert_events(alerts: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """One event per alert."""
    return subscribed(alerts, subscriptions).select(
        F.col("patient_id").alias("channel"), F.lit(NEW_ALERT).alias("event"),
        "id", "ts", "unit", "value")


def record_events(records: DataFrame, subscriptions: DataFrame,
                  quiet_seconds: int = DEBOUNCE_SECONDS) -> DataFrame:
    """One event per patient and burst, sent once the patient has been quiet.

    A burst is an inactivity session on arrival time.
    """
    chosen = subscribed(records, subscriptions).select(
        "patient_id", F.col(ARRIVAL).alias("ts"), F.lit(1.0).alias("value"))
    bursts = gap_sessions(chosen, ["patient_id"], quiet_seconds)
    return bursts.select(
        F.col("patient_id").alias("channel"), F.lit(NEW_RECORDS).alias("event"),
        (F.col("last_ts") + F.make_dt_interval(secs=F.lit(quiet_seconds))).alias("sent_ts"),
        "n_records")


def sent_per_period(events: DataFrame, period: str = REPORT_PERIOD,
                    sent: str = "sent_ts") -> DataFrame:
    """Number of notifications per reporting period."""
    return (events.groupBy(F.window(sent, period).alias("w"))
            .agg(F.count("*").alias("n_sent"))
            .select(F.col("w.start").alias("window_start"), "n_sent"))
