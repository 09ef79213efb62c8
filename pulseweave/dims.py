"""Per-unit dimensions.

They are built with SQL ``VALUES`` so that the planner sees a local relation
of known size and broadcasts it by its own size check.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

# Unit -> (lowest normal, highest normal).  StepCount has none.
NORMAL_RANGES = {
    "BloodGlucose/mmol_L": (4.0, 6.0),
    "BloodPressure.Diastolic/mmHg": (60.0, 80.0),
    "BloodPressure.Systolic/mmHg": (90.0, 120.0),
    "BodyTemperature/C": (36.8, 37.3),
    "ForcedExpiratoryVolume/Litres": (1.30, 1.45),
    "HeartRate/Bpm": (80.0, 120.0),
    "PeakExpiratoryFlowRate/L_min": (400.0, 530.0),
    "Respiratory/Bpm": (12.0, 18.0),
}

# Unit -> (most credits, fewest credits) of a session.
CREDIT_CAPS = {
    "BloodGlucose/mmol_L": (1, 1),
    "BloodPressure.Diastolic/mmHg": (6, 1),
    "BloodPressure.Systolic/mmHg": (6, 1),
    "BodyTemperature/C": (20, 1),
    "ForcedExpiratoryVolume/Litres": (40, 1),
    "HeartRate/Bpm": (20, 1),
    "PeakExpiratoryFlowRate/L_min": (5, 1),
    "Respiratory/Bpm": (10, 1),
    "StepCount/Count": (40, 1),
}

# Unit -> class; the class picks the session gap.
UNIT_CLASSES = {
    "BloodGlucose/mmol_L": "long",
    "BloodPressure.Diastolic/mmHg": "short",
    "BloodPressure.Systolic/mmHg": "short",
    "BodyTemperature/C": "short",
    "ForcedExpiratoryVolume/Litres": "short",
    "HeartRate/Bpm": "short",
    "PeakExpiratoryFlowRate/L_min": "long",
    "Respiratory/Bpm": "short",
    "StepCount/Count": "short",
}

# Session gaps by unit class, in seconds.
SESSION_GAPS = {"short": 40, "long": 70}

# Units whose drift sensitivity stays constant.
STEADY_DRIFT_UNITS = ("HeartRate/Bpm", "Respiratory/Bpm", "StepCount/Count")


def _literal(value: object) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(value, float):
        return f"{value!r}D"
    if isinstance(value, int):
        return f"{value}L"
    raise TypeError(f"no literal for {value!r}")


def local_table(spark: SparkSession, columns: str, rows: Iterable[tuple]) -> DataFrame:
    """A small constant table the planner knows the size of."""
    values = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({columns})")


def normal_ranges(spark: SparkSession,
                  ranges: Mapping[str, tuple[float, float]] = NORMAL_RANGES) -> DataFrame:
    return local_table(spark, "unit, lo, hi",
                       [(u, float(lo), float(hi)) for u, (lo, hi) in ranges.items()])


def credit_caps(spark: SparkSession,
                caps: Mapping[str, tuple[int, int]] = CREDIT_CAPS) -> DataFrame:
    return local_table(spark, "unit, max_credits, min_credits",
                       [(u, int(hi), int(lo)) for u, (hi, lo) in caps.items()])


def unit_classes(spark: SparkSession,
                 classes: Mapping[str, str] = UNIT_CLASSES) -> DataFrame:
    return local_table(spark, "unit, unit_class", list(classes.items()))
