"""Preparing stored rows for display as series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pulseweave.functions.text import unit_label
from pulseweave.functions.times import UNITS_US, slot_start

# Fixed value: where the chart floor starts.
HIGHEST_FLOOR = 1000.0


def one_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key, the least by ``order`` and then by its other columns.

    Without an order this is the plain ``dropDuplicates``, for rows that do not
    differ within a key and for streams.
    """
    if not order or rows.isStreaming:
        return rows.dropDuplicates(list(keys))
    rest = [c for c in rows.columns if c not in keys and c not in order]
    best = rows.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("best"))
    return best.select(*keys, "best.*").select(*rows.columns)


def dedup_within(rows: DataFrame, keys: Sequence[str], within: str,
                 time: str = "ts") -> DataFrame:
    """One row per key of a stream whose repeats come at most ``within`` apart in event time.

    Keys leave the state once the watermark (``within`` behind the newest row) has passed
    them, so the state holds a stretch of the stream instead of all of it.  A repeat that comes
    later than that is dropped as late or stays, as any late row.
    """
    return rows.withWatermark(time, within).dropDuplicatesWithinWatermark(list(keys))


def dedup_points(rows: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """One row per patient, unit and time."""
    return one_per_key(rows, ["patient_id", "unit", "ts"], order)


def dedup_by_id(rows: DataFrame) -> DataFrame:
    return one_per_key(rows, ["id"])


def chart_floor(aggregates: DataFrame) -> DataFrame:
    """Lowest value per series, never above 1000."""
    return (aggregates.groupBy("patient_id", "unit")
            .agg(F.least(F.lit(HIGHEST_FLOOR), F.min("min_value")).alias("floor")))


def since_latest(rows: DataFrame, latest_of: DataFrame, now: Column | str | None = None,
                 default: str = "15 minutes") -> DataFrame:
    """Rows at or after the latest time in ``latest_of``: an incremental read.

    With nothing seen yet, the rows of the ``default`` range before ``now`` (the
    present unless given).
    """
    # A scalar subquery: evaluated first, then an ordinary filter on the scan.
    latest = latest_of.agg(F.max("ts")).scalar()
    present = F.current_timestamp() if now is None else (
        now if isinstance(now, Column) else F.lit(now).cast("timestamp"))
    return rows.filter(F.col("ts") >= F.coalesce(latest, present - F.expr(f"INTERVAL {default}")))


def chart_series(aggregates: DataFrame, alerts: DataFrame,
                 drifts: DataFrame | None = None) -> DataFrame:
    """Everything a chart shows, in long form: (patient, unit, series, ts, y).

    Aggregates give the series min, avg and max; alerts give points; a drift
    gives its two ends at the floor of its series.  Sort with ``in_chart_order``.
    """
    values = F.explode(F.array(*[
        F.struct(F.lit(name).alias("series"), F.col(f"{name}_value").alias("y"))
        for name in ("min", "avg", "max")])).alias("p")
    points = aggregates.select("patient_id", "unit", "ts", values)
    series = points.select("patient_id", "unit", "p.series", "ts", "p.y").unionByName(
        alerts.select("patient_id", "unit", F.lit("alert").alias("series"), "ts",
                      F.col("value").alias("y")))
    if drifts is not None:
        ends = drifts.select("patient_id", "unit", F.explode(F.array("from", "to")).alias("ts"))
        floored = (ends.join(chart_floor(aggregates), ["patient_id", "unit"], "left")
                   .select("patient_id", "unit", F.lit("drift").alias("series"), "ts",
                           F.coalesce("floor", F.lit(HIGHEST_FLOOR)).alias("y")))
        series = series.unionByName(floored)
    return series.withColumn("unit", unit_label(F.col("unit")))


def in_chart_order(series: DataFrame) -> DataFrame:
    return series.orderBy("unit", "series", "ts")


def drift_overlay(records: DataFrame, drifts: DataFrame, slot: str = "1 hour") -> DataFrame:
    """Records that lie inside a drift of their own series, once per drift.

    The range condition becomes an equality on time slots: a drift is repeated
    for each slot it touches, a record has exactly one slot.
    """
    width = F.lit(UNITS_US[slot.split()[1].rstrip("s")] * int(slot.split()[0])).cast("bigint")
    slots = F.explode(F.sequence(slot_start(F.col("from"), slot),
                                 slot_start(F.col("to"), slot), width)).alias("slot")
    touched = drifts.select("patient_id", "unit", F.col("id").alias("drift_id"), "from", "to",
                            slots)
    placed = records.withColumn("slot", slot_start(F.col("ts"), slot))
    return (placed.join(touched, ["patient_id", "unit", "slot"])
            .filter(F.col("ts").between(F.col("from"), F.col("to")))
            .drop("slot"))
