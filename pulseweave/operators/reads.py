"""The read queries over stored tables.

Inputs have stored column names (``ts``, ``u``, ``v``, ...).  Tables written by
``pulseweave.sinks`` are partitioned by a truncated time; a bound on the time
column is repeated on that column, as files are pruned by the latter only.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from pulseweave.functions.times import at, before, to_millis
from pulseweave.schemas import AGGREGATED_RECORDS, ALERTS, DRIFT_ALERTS, TableSpec

Moment = Column | dt.datetime | str

SHORTEST_FRAGMENT = 3


def in_time_range(table: DataFrame, spec: TableSpec, low: Moment | None,
                  high: Moment | None) -> DataFrame:
    """Both ends inclusive; None leaves an end open."""
    for bound, compare in ((low, "__ge__"), (high, "__le__")):
        if bound is None:
            continue
        table = table.filter(getattr(F.col(spec.time), compare)(at(bound)))
        if spec.partition in table.columns:
            start = F.date_trunc(spec.grain, at(bound))
            table = table.filter(getattr(F.col(spec.partition), compare)(start))
    return table


def _time_bounds(now: Moment, low_ms: int | None, high_ms: int | None) -> tuple[Column, Column]:
    """Requested bounds in ms; a missing or zero bound means the last hour."""
    low = F.timestamp_millis(F.lit(low_ms)) if low_ms else before(now, "1 hour")
    high = F.timestamp_millis(F.lit(high_ms)) if high_ms else at(now)
    return low, high


def _one_patient(table: DataFrame, spec: TableSpec, patient_id: str, now: Moment,
                 low_ms: int | None, high_ms: int | None) -> DataFrame:
    low, high = _time_bounds(now, low_ms, high_ms)
    rows = table.filter(F.col("patient_id") == F.lit(patient_id))
    return in_time_range(rows, spec, low, high)


def patient_records(table: DataFrame, patient_id: str, now: Moment,
                    low_ms: int | None = None, high_ms: int | None = None) -> DataFrame:
    """Aggregated records of one patient."""
    return _one_patient(table, AGGREGATED_RECORDS, patient_id, now, low_ms, high_ms).select(
        "id", "patient_id", to_millis(F.col("ts")).alias("ts"), "u", "avg_v", "min_v", "max_v")


def patient_alerts(table: DataFrame, patient_id: str, now: Moment,
                   low_ms: int | None = None, high_ms: int | None = None) -> DataFrame:
    """Alerts of one patient."""
    return _one_patient(table, ALERTS, patient_id, now, low_ms, high_ms).select(
        "id", "patient_id", to_millis(F.col("ts")).alias("ts"), "u", "v")


def patient_drifts(table: DataFrame, patient_id: str, now: Moment,
                   low_ms: int | None = None, high_ms: int | None = None) -> DataFrame:
    """Drifts of one patient that start in the range."""
    return _one_patient(table, DRIFT_ALERTS, patient_id, now, low_ms, high_ms).select(
        "id", "patient_id", "u", to_millis(F.col("f")).alias("f"),
        to_millis(F.col("t")).alias("t"))


# Names of stored columns in the answers shown to a user.
SHOWN_AS = {"ts": "timestamp", "u": "unit", "v": "value", "avg_v": "avg_value",
            "min_v": "min_value", "max_v": "max_value", "f": "from", "t": "to"}


def shown(rows: DataFrame) -> DataFrame:
    """Stored column names replaced by the ones shown."""
    return rows.withColumnsRenamed({k: v for k, v in SHOWN_AS.items() if k in rows.columns})


def alert_counts(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("patient_id").agg(F.count("*").alias("alert_count"))


def with_alerts(patients: DataFrame) -> DataFrame:
    """Patients with at least one alert."""
    return patients.filter(F.col("alert_count") > 0)


def recent_patients(alerts: DataFrame, now: Moment, window: str = "15 minutes",
                    top: int = 100) -> DataFrame:
    """The patients with most alerts lately; equal counts are ordered by id."""
    recent = in_time_range(alerts, ALERTS, before(now, window), None)
    return alert_counts(recent).orderBy(F.desc("alert_count"), "patient_id").limit(top)


def matching_patients(patient_ids: DataFrame, fragment: str) -> DataFrame:
    """Ids that contain a fragment of three characters or more, taken literally.

    Ids are lower case, so a fragment in upper case finds nothing.
    """
    ids = patient_ids.select("patient_id")
    if len(fragment) < SHORTEST_FRAGMENT:
        return ids.filter(F.lit(False))
    return ids.filter(F.col("patient_id").contains(F.lit(fragment)))


def matching_patients_by_ngram(gram_table: DataFrame, fragment: str) -> DataFrame:
    """The same search over ``patients.ngram_table``: the fragment's leading gram
    chooses rows, the rest is checked on the ids.

    The table must hold grams of the shortest fragment's length (three).  A stored index
    is ``gram_index``.
    """
    ids = gram_table.select("patient_id").distinct()
    if len(fragment) < SHORTEST_FRAGMENT:
        return ids.filter(F.lit(False))
    gram = fragment[:SHORTEST_FRAGMENT]
    return (gram_table.filter((F.col("gram") == F.lit(gram))
                              & F.col("patient_id").contains(F.lit(fragment)))
            .select("patient_id").distinct())


def search_patients(patient_ids: DataFrame, records: DataFrame, alerts: DataFrame,
                    fragment: str, now: Moment, window: str = "24 hours") -> DataFrame:
    """Matching patients with recent records and how many alerts they have had.

    Fewest alerts first, patients without any at the end.  The fragment is
    tested on the records and alerts before they are aggregated, and both are
    down to one row per patient before they are joined.
    """
    candidates = matching_patients(patient_ids, fragment)
    has_fragment = F.col("patient_id").contains(F.lit(fragment))
    active = (in_time_range(records, AGGREGATED_RECORDS, before(now, window), None)
              .filter(has_fragment).select("patient_id").distinct()
              .join(candidates, "patient_id", "left_semi"))
    counts = alert_counts(alerts.filter(has_fragment))
    return active.join(counts, "patient_id", "left").orderBy(
        F.asc_nulls_last("alert_count"), "patient_id")


def zero_for_none(patients: DataFrame) -> DataFrame:
    return patients.withColumn("alert_count", F.coalesce("alert_count", F.lit(0)))
