"""Avro messages with registry framing.  Needs the spark-avro package.

A framed message is one zero byte, a 4-byte schema number and the Avro body.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.avro.functions import from_avro, to_avro

from pulseweave.functions.ids import bytes_from_uuid, uuid_from_bytes

HEADER_BYTES = 5


def record_schema(name: str, fields: dict[str, str | dict]) -> str:
    return json.dumps({"type": "record", "name": name,
                       "fields": [{"name": n, "type": t} for n, t in fields.items()]})


# Wire fields of the messages.
SENSOR_RECORD = record_schema(
    "SensorRecord", {"Timestamp": "long", "Value": "double", "Unit": "string"})
ALERT = record_schema(
    "Alert", {"Id": "bytes", "PatientId": "bytes", "Timestamp": "long", "Unit": "string",
              "Value": "double"})
AGGREGATED_RECORD = record_schema(
    "AggregatedRecord", {"Id": "bytes", "PatientId": "bytes", "Timestamp": "long",
                         "Unit": "string", "AvgValue": "double", "MinValue": "double",
                         "MaxValue": "double"})
DRIFT_ALERT = record_schema(
    "AdwinAlert", {"Id": "bytes", "PatientId": "bytes", "Unit": "string", "From": "long",
                   "To": "long"})
HUB_RECORD_BATCH = record_schema("HubRecordBatch", {"Batch": {"type": "array", "items": {
    "type": "record", "name": "HubRecord", "fields": [
        {"name": "PatientId", "type": "bytes"},
        {"name": "Records", "type": {"type": "array", "items": json.loads(SENSOR_RECORD)}}]}}})


# --- framing --------------------------------------------------------------------

def body(framed: Column) -> Column:
    return F.substring(framed, HEADER_BYTES + 1, 2_147_483_647)


def schema_number(framed: Column) -> Column:
    """The registry number a message was written with; null without framing."""
    is_framed = (F.length(framed) >= HEADER_BYTES) & (F.hex(F.substring(framed, 1, 1)) == "00")
    return F.when(is_framed, F.conv(F.hex(F.substring(framed, 2, 4)), 16, 10).cast("bigint"))


def framed(encoded: Column, schema_number: int) -> Column:
    return F.concat(F.unhex(F.lit(f"00{schema_number:08x}")), encoded)


def parsed(messages: DataFrame, schemas: str | dict[int, str]) -> DataFrame:
    """Messages with their fields in ``r``.

    ``schemas`` is one writer schema, or those of several registry numbers with the
    same fields; a message of another number has a null ``r``.
    """
    if isinstance(schemas, str):
        return messages.withColumn("r", from_avro(body(F.col("value")), schemas))
    number = schema_number(F.col("value"))
    return messages.withColumn("r", F.coalesce(*[
        F.when(number == n, from_avro(body(F.col("value")), text))
        for n, text in schemas.items()]))


# --- fields of the messages, between wire and engine form ------------------------------

def _in_ids() -> list[Column]:
    return [uuid_from_bytes(F.col("r.Id")).alias("id"),
            uuid_from_bytes(F.col("r.PatientId")).alias("patient_id")]


def sensor_rows(parsed: DataFrame) -> DataFrame:
    return parsed.select(
        uuid_from_bytes(F.col("key")).alias("patient_id"), F.col("r.Unit").alias("unit"),
        F.timestamp_millis("r.Timestamp").alias("ts"), F.col("r.Value").alias("value"),
        "arrival_ts")


def alert_rows(parsed: DataFrame) -> DataFrame:
    return parsed.select(*_in_ids(), F.timestamp_millis("r.Timestamp").alias("ts"),
                         F.col("r.Unit").alias("unit"), F.col("r.Value").alias("value"),
                         "arrival_ts")


def aggregated_rows(parsed: DataFrame) -> DataFrame:
    return parsed.select(*_in_ids(), F.timestamp_millis("r.Timestamp").alias("ts"),
                         F.col("r.Unit").alias("unit"), F.col("r.AvgValue").alias("avg_value"),
                         F.col("r.MinValue").alias("min_value"),
                         F.col("r.MaxValue").alias("max_value"), "arrival_ts")


def drift_rows(parsed: DataFrame) -> DataFrame:
    return parsed.select(*_in_ids(), F.col("r.Unit").alias("unit"),
                         F.timestamp_millis("r.From").alias("from"),
                         F.timestamp_millis("r.To").alias("to"), "arrival_ts")


def _out_ids() -> dict[str, Column]:
    return {"Id": bytes_from_uuid(F.col("id")), "PatientId": bytes_from_uuid(F.col("patient_id"))}


def sensor_fields() -> dict[str, Column]:
    return {"Timestamp": F.unix_millis("ts"), "Value": F.col("value"), "Unit": F.col("unit")}


def alert_fields() -> dict[str, Column]:
    return {**_out_ids(), "Timestamp": F.unix_millis("ts"), "Unit": F.col("unit"),
            "Value": F.col("value")}


def aggregated_fields() -> dict[str, Column]:
    return {**_out_ids(), "Timestamp": F.unix_millis("ts"), "Unit": F.col("unit"),
            "AvgValue": F.col("avg_value"), "MinValue": F.col("min_value"),
            "MaxValue": F.col("max_value")}


def drift_fields() -> dict[str, Column]:
    return {**_out_ids(), "Unit": F.col("unit"), "From": F.unix_millis("from"),
            "To": F.unix_millis("to")}


def packed(fields: dict[str, Column]) -> Column:
    return F.struct(*[c.alias(n) for n, c in fields.items()])


# --- messages -----------------------------------------------------------------------

def decode_hub_batches(messages: DataFrame,
                       schemas: str | dict[int, str] = HUB_RECORD_BATCH) -> DataFrame:
    """Messages as hub record batches, for ``batches.flatten_batches``."""
    return parsed(messages, schemas).select("r.Batch", "arrival_ts")


def decode_sensor_records(messages: DataFrame,
                          schemas: str | dict[int, str] = SENSOR_RECORD) -> DataFrame:
    """Messages keyed by patient as sensor records."""
    return sensor_rows(parsed(messages, schemas))


def decode_alerts(messages: DataFrame, schemas: str | dict[int, str] = ALERT) -> DataFrame:
    return alert_rows(parsed(messages, schemas))


def decode_aggregated_records(messages: DataFrame,
                              schemas: str | dict[int, str] = AGGREGATED_RECORD) -> DataFrame:
    return aggregated_rows(parsed(messages, schemas))


def decode_drifts(messages: DataFrame, schemas: str | dict[int, str] = DRIFT_ALERT) -> DataFrame:
    return drift_rows(parsed(messages, schemas))


def _messages(rows: DataFrame, fields: dict[str, Column], schema: str, number: int) -> DataFrame:
    """Messages keyed by patient."""
    return rows.select(bytes_from_uuid(F.col("patient_id")).alias("key"),
                       framed(to_avro(packed(fields), schema), number).alias("value"))


def encode_sensor_records(records: DataFrame, schema_number: int) -> DataFrame:
    return _messages(records, sensor_fields(), SENSOR_RECORD, schema_number)


def encode_hub_batches(batches: DataFrame, schema_number: int) -> DataFrame:
    """Batches as ``batches.pack_batches`` makes them; without a key."""
    return batches.select(F.lit(None).cast("binary").alias("key"), framed(
        to_avro(F.struct("Batch"), HUB_RECORD_BATCH), schema_number).alias("value"))


def encode_alerts(alerts: DataFrame, schema_number: int) -> DataFrame:
    return _messages(alerts, alert_fields(), ALERT, schema_number)


def encode_aggregated_records(records: DataFrame, schema_number: int) -> DataFrame:
    return _messages(records, aggregated_fields(), AGGREGATED_RECORD, schema_number)


def encode_drifts(drifts: DataFrame, schema_number: int) -> DataFrame:
    return _messages(drifts, drift_fields(), DRIFT_ALERT, schema_number)
