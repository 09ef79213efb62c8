"""Readings outside their normal range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pulseweave.functions.ids import stable_id, value_part


def with_alert_flag(records: DataFrame, ranges: DataFrame) -> DataFrame:
    """Every record, with ``is_alert``; a unit without a range never alerts.

    NaN compares above every bound and so is outside.
    """
    inside = F.col("value").between(F.col("lo"), F.col("hi"))
    return (records.join(ranges, "unit", "left")
            .withColumn("is_alert", F.coalesce(~inside, F.lit(False)))
            .drop("lo", "hi"))


def out_of_range(records: DataFrame, ranges: DataFrame) -> DataFrame:
    """Records outside their range.  A map-side lookup: no shuffle."""
    return (records.join(ranges, "unit")
            .filter(~F.col("value").between(F.col("lo"), F.col("hi")))
            .drop("lo", "hi"))


def alerts(records: DataFrame, ranges: DataFrame, id_column: Column | None = None) -> DataFrame:
    """One alert per out-of-range record."""
    if id_column is None:
        id_column = stable_id(F.lit("alert"), F.col("patient_id"), F.col("unit"),
                              F.unix_micros("ts"), value_part(F.col("value")))
    return out_of_range(records, ranges).select(
        id_column.alias("id"), "patient_id", "ts", "unit", "value")


def above_threshold(records: DataFrame, unit: str, bound: float) -> DataFrame:
    """Records of one unit above a fixed value."""
    return records.filter((F.col("unit") == F.lit(unit)) & (F.col("value") > F.lit(bound)))


def range_coverage(records: DataFrame, ranges: DataFrame) -> DataFrame:
    """Per unit: its range, and how many records lie inside and outside it."""
    inside = F.col("value").between(F.col("lo"), F.col("hi"))
    return (records.join(ranges, "unit")
            .groupBy("unit", "lo", "hi")
            .agg(F.count("*").alias("n_records"),
                 F.count_if(inside).alias("n_inside"),
                 F.count_if(~inside).alias("n_outside")))
