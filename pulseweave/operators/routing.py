"""Splitting a stream of records by unit class."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

UNMATCHED = "other"


def with_route(records: DataFrame, classes: DataFrame) -> DataFrame:
    """Add ``route``: the class of the unit, or ``other``.  Classes are unique
    per unit, so the first match is the only one."""
    return (records.join(classes.withColumnRenamed("unit_class", "route"), "unit", "left")
            .withColumn("route", F.coalesce("route", F.lit(UNMATCHED))))


def routed(records: DataFrame, classes: DataFrame, route: str) -> DataFrame:
    """Records of one route, without the route column."""
    if route == UNMATCHED:
        return records.join(classes, "unit", "left_anti")
    return records.join(classes.filter(F.col("unit_class") == route), "unit", "left_semi")
