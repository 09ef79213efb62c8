import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from pulseweave import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("pulseweave-tests", "local[8]", {
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "6g",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture
def records(spark):
    """Build sensor records from (patient, unit, seconds, value) tuples."""
    def build(rows):
        frame = spark.createDataFrame(
            [(p, u, int(round(sec * 1_000_000)), float(v)) for p, u, sec, v in rows],
            "patient_id string, unit string, us bigint, value double")
        return frame.selectExpr("patient_id", "unit", "timestamp_micros(us) AS ts", "value")
    return build
