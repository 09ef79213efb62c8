"""Stored tables and the ``events`` table as sensor records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pulseweave.functions.ids import uuid_from_long
from pulseweave.schemas import TABLES
from pulseweave.session import use_utc
from pulseweave.sinks.tables import read_stored

EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The rows of a stored table by its name, as they are now."""
    return read_stored(spark, TABLES[name], root)


def known_patients(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/patient_ids").select("patient_id")


def known_patients_jdbc(spark: SparkSession, url: str, table: str = "patient_ids",
                        partitions: int = 16, **options: str) -> DataFrame:
    """The ids from a SQL store, read by ranges of their first hex digit."""
    digits = "0123456789abcdef"
    step = max(1, len(digits) // partitions)
    edges = [digits[i] for i in range(0, len(digits), step)]
    predicates = []
    for i, low in enumerate(edges):
        part = f"patient_id >= '{low}'" if i else "1 = 1"
        if i + 1 < len(edges):
            part += f" AND patient_id < '{edges[i + 1]}'"
        predicates.append(part)
    return spark.read.jdbc(url, f"(SELECT patient_id FROM {table}) AS ids",
                           predicates=predicates, properties=options)


def events(spark: SparkSession, folder: str) -> DataFrame:
    """The ``events`` table.  Naming the schema saves the inference job and
    reads zone-less times as instants, so that time filters reach the file."""
    return use_utc(spark).read.schema(EVENTS_SCHEMA).parquet(f"{folder}/events.parquet")


def as_sensor_records(rows: DataFrame, *extra: str) -> DataFrame:
    """Events as sensor records: user -> patient, event type -> unit."""
    return rows.select(uuid_from_long(F.col("user_id")).alias("patient_id"),
                       F.col("event_type").alias("unit"), "ts", "value", *extra)


def with_arrival(rows: DataFrame) -> DataFrame:
    """Arrival time of an event: its time plus ``k`` seconds from ``props``."""
    seconds = F.get_json_object("props", "$.k").cast("bigint")
    return rows.withColumn(
        "arrival_ts", F.timestamp_micros(F.unix_micros("ts") + seconds * 1_000_000))


def user_of(patient_id: str) -> int:
    """The user number behind a patient id, to filter on the stored column."""
    return int(patient_id.replace("-", ""), 16)
