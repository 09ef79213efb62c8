"""Buckets of series: one call for many, the same results for any number of them."""

import random
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pulseweave.dims import credit_caps
from pulseweave.operators.drift import detect_drift
from pulseweave.schemas import ALERTS
from pulseweave.session import ROCKSDB_PROVIDER
from pulseweave.sinks import table_log
from pulseweave.sinks.tables import stored_rows
from pulseweave.streaming import jobs, processors
from pulseweave.streaming.processors import (CreditSessions, ExpiringCreditSessions,
                                             NumberBySession, stream_credit_sessions,
                                             stream_drift, stream_expiring_sessions)

SCHEMA = "patient_id string, unit string, ts timestamp, value double"


class Listed:
    """A list state that counts its uses."""

    def __init__(self):
        self.rows, self.uses = [], 0

    def get(self):
        self.uses += 1
        return iter(list(self.rows))

    def put(self, rows):
        self.uses += 1
        self.rows = rows

    def clear(self):
        self.rows = []


class Handle:
    def __init__(self):
        self.listed, self.timers = Listed(), set()

    def getListState(self, name, schema, ttl=None):
        return self.listed

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)


def frame(rows):
    return pd.DataFrame([(0, p, "u", us, 1.0, False, processors.RECORD, 3, 1) for p, us in rows],
                        columns=["bucket", "patient_id", "unit", "us", "value", "is_alert",
                                 "kind", "max_credits", "min_credits"])


def at(ms):
    return SimpleNamespace(getCurrentProcessingTimeInMs=lambda: ms,
                           getCurrentWatermarkInMs=lambda: ms)


def call(processor, rows, ms=0):
    return [tuple(r) for out in processor.handleInputRows((0,), iter([frame(rows)]), at(ms))
            for r in out.itertuples(index=False)]


def test_a_call_reads_and_writes_its_state_once():
    processor, handle = CreditSessions(), Handle()
    processor.init(handle)
    found = call(processor, [(f"p{i}", i) for i in range(300)])
    assert len(found) == 300 and len(handle.listed.rows) == 300 and handle.listed.uses == 2


def test_numbering_reads_and_writes_its_state_once():
    processor, handle = NumberBySession(), Handle()
    processor.init(handle)
    rows = frame([(f"p{i}", i) for i in range(300)]).assign(ts=lambda f: f["us"])
    for _ in range(2):
        found = pd.concat(processor.handleInputRows((0,), iter([rows]), at(0)))
    assert len(found) == 300 and set(found["session_id"]) == {2} and handle.listed.uses == 4


def test_a_series_too_old_begins_anew_beside_others():
    processor, handle = CreditSessions(ttl_ms=100), Handle()
    processor.init(handle)
    call(processor, [("old", 1), ("new", 1)], 0)
    call(processor, [("new", 2)], 60)
    found = call(processor, [("old", 3), ("new", 3), ("new", 4)], 120)
    assert sorted((r[0], r[2]) for r in found) == [("new", 3), ("old", 1)]


def test_calls_and_the_timer_free_expired_series():
    processor, handle = ExpiringCreditSessions(10_000), Handle()
    processor.init(handle)
    call(processor, [("a", 1_000), ("b", 9_000)])
    call(processor, [("b", 16_000)], 12)
    assert [row[0] for row in handle.listed.rows] == ["b"] and handle.timers == {27}
    list(processor.handleExpiredTimer((0,), at(27), SimpleNamespace(getExpiryTimeInMs=lambda: 27)))
    assert handle.listed.rows == []


@pytest.fixture(scope="module")
def made(tmp_path_factory):
    rng = random.Random(5)
    rows = sorted((rng.randrange(400) * 3600, f"p{rng.randrange(40)}", rng.choice("uv"),
                   rng.random() + 50 * rng.randrange(2)) for _ in range(1200))
    return [(p, u, t + i / 1000, v) for i, (t, p, u, v) in enumerate(rows)], tmp_path_factory


def emitted(frame, tmp_path, name):
    out = []
    frame.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    (frame.writeStream.outputMode("append" if name.startswith("expire") else "update")
     .foreachBatch(lambda batch, _: out.extend(tuple(r) for r in batch.collect()))
     .option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
     .awaitTermination())
    return sorted(out, key=str)


def test_results_do_not_depend_on_the_number_of_buckets(spark, records, made, tmp_path):
    rows = made[0]
    for i in range(3):
        records(rows[i * 400:i * 400 + 400]).coalesce(1).write.parquet(f"{tmp_path}/in/part{i}")
    found = {}
    for n in (1, 64):
        stream = jobs.file_stream(spark, SCHEMA, f"{tmp_path}/in/part*/*.parquet", 1)
        caps = credit_caps(spark, {"u": (3, 1), "v": (2, 1)})
        flagged = stream.withColumn("is_alert", F.col("value") > 50.9)
        found[n] = [emitted(stream_credit_sessions(flagged, caps, buckets=n), tmp_path, f"credit{n}"),
                    emitted(stream_expiring_sessions(stream, caps, "1 day", "1 minute", buckets=n),
                            tmp_path, f"expire{n}"),
                    emitted(stream_drift(stream, F.lit(True), "per_drift", buckets=n), tmp_path,
                            f"drift{n}")]
    assert found[1] == found[64] and len(found[1][0]) > 200 and len(found[1][1]) > 200


def test_a_missing_key_or_time_leaves_other_series_as_they_are(spark, records, tmp_path):
    steps = [("p", "u", i, 0 if i < 60 else 100) for i in range(120)]
    odd = spark.sql("SELECT 'q' patient_id, 'u' unit, CAST(NULL AS TIMESTAMP) ts, 1D value "
                    "UNION ALL SELECT NULL, 'u', TIMESTAMP'2024-01-01', 1D")
    whole = records(steps).unionByName(odd)
    whole.coalesce(1).write.parquet(f"{tmp_path}/in/part0")
    stream = jobs.file_stream(spark, SCHEMA, f"{tmp_path}/in/part*/*.parquet", 1)
    found = emitted(stream_drift(stream, F.lit(True), "per_drift", buckets=1), tmp_path, "odd")
    expected = sorted((tuple(r) for r in detect_drift(records(steps), F.lit(True)).collect()), key=str)
    assert found == expected and found


def test_a_commit_gathers_file_bounds_in_parallel(spark, records, tmp_path):
    """What the aggregation of a partition keeps is not held for all of them in one task."""
    context, tracker = spark.sparkContext, spark.sparkContext.statusTracker()
    rows = records([("p", "u", i, 1) for i in range(9)]).withColumn("id", F.lit("x")).coalesce(1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    context.setJobGroup("bounds", "bounds")
    try:
        made = table_log.write_rows(stored_rows(rows, ALERTS), ALERTS, str(tmp_path / "t"), "w", 0)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    jobs_run = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("bounds")]
    tasks = [tracker.getStageInfo(s).numTasks for j in jobs_run for s in j.stageIds
             if tracker.getStageInfo(s)]
    assert made.rows == 9 and int(spark.conf.get("spark.sql.shuffle.partitions")) in tasks
