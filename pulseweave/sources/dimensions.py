"""Dimension files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def parse_ranges(texts: DataFrame) -> DataFrame:
    """Rows (unit, lo, hi) from JSON objects ``{unit: {"max": .., "min": ..}}``.

    ``texts`` has one column ``value``.  A unit without both bounds is an error.
    """
    units = texts.select(F.explode(
        F.from_json("value", "map<string, struct<max: double, min: double>>")))
    bad = F.concat(F.lit("range without both bounds: "), F.col("key"))
    complete = F.col("value.min").isNotNull() & F.col("value.max").isNotNull()
    return units.select(
        F.when(complete, F.col("key")).otherwise(F.raise_error(bad)).alias("unit"),
        F.col("value.min").alias("lo"), F.col("value.max").alias("hi"))


def read_ranges(spark: SparkSession, path: str) -> DataFrame:
    """Normal ranges from a JSON file on storage that all nodes see."""
    return parse_ranges(spark.read.text(path, wholetext=True))
