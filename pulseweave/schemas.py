"""Record types.

Patient and row ids are lower-case UUID text inside the engine and 16
big-endian bytes on the wire; wire times are epoch milliseconds.
"""

from __future__ import annotations

from dataclasses import dataclass

# Wire form of what a patient's hub sends.
HUB_RECORD_BATCH = (
    "Batch array<struct<PatientId: binary, "
    "Records: array<struct<Timestamp: bigint, Value: double, Unit: string>>>>"
)

SENSOR_RECORD = "patient_id string, unit string, ts timestamp, value double"
SESSIONIZED_RECORD = (
    "patient_id string, unit string, session_id bigint, ts timestamp, value double"
)
ALERT = "id string, patient_id string, ts timestamp, unit string, value double"
AGGREGATED_RECORD = (
    "id string, patient_id string, ts timestamp, unit string, "
    "avg_value double, min_value double, max_value double"
)
DRIFT_ALERT = "id string, patient_id string, unit string, from timestamp, to timestamp"
GLOBAL_AVERAGE = "unit string, ts timestamp, value double"


@dataclass(frozen=True)
class TableSpec:
    """How one record kind is stored.

    ``columns`` maps a record column to its stored name, ``time`` is the stored
    time column, ``partition`` the derived partition column with ``grain`` as
    its truncation, ``cluster`` the column that rows are laid out by.
    """

    name: str
    columns: dict[str, str]
    time: str
    partition: str
    grain: str
    cluster: str
    trigger: str


AGGREGATED_RECORDS = TableSpec(
    name="aggregated_records",
    columns={"id": "id", "patient_id": "patient_id", "ts": "ts", "unit": "u",
             "avg_value": "avg_v", "min_value": "min_v", "max_value": "max_v"},
    time="ts", partition="ts_hour", grain="hour", cluster="patient_id",
    trigger="2 seconds",
)
ALERTS = TableSpec(
    name="alerts",
    columns={"id": "id", "patient_id": "patient_id", "ts": "ts", "unit": "u",
             "value": "v"},
    time="ts", partition="ts_day", grain="day", cluster="patient_id",
    trigger="100 milliseconds",
)
DRIFT_ALERTS = TableSpec(
    name="adwin_alerts",
    columns={"id": "id", "patient_id": "patient_id", "unit": "u", "from": "f", "to": "t"},
    time="f", partition="f_hour", grain="hour", cluster="patient_id",
    trigger="1 second",
)
GLOBAL_AVERAGES = TableSpec(
    name="global_averages",
    columns={"ts": "ts", "unit": "u", "value": "v"},
    time="ts", partition="ts_day", grain="day", cluster="u",
    trigger="100 milliseconds",
)
SESSION_WINDOWS = TableSpec(
    name="session_windows",
    columns={c: c for c in ("patient_id", "unit", "session_id", "ts", "avg_value", "min_value",
                            "max_value", "n_records")},
    time="ts", partition="ts_day", grain="day", cluster="patient_id",
    trigger="2 seconds",
)

TABLES = {t.name: t for t in (AGGREGATED_RECORDS, ALERTS, DRIFT_ALERTS, GLOBAL_AVERAGES)}
