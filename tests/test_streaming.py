"""Streams against tables: parity, late data, restart."""

import uuid

import pytest
from pyspark.sql import functions as F

from pulseweave.dims import credit_caps, normal_ranges, unit_classes
from pulseweave.operators import alerts as al, credits, drift, meters, sessions, windows
from pulseweave.schemas import AGGREGATED_RECORDS, ALERTS, SENSOR_RECORD
from pulseweave.sinks.tables import read_stored
from pulseweave.sources.tables import as_sensor_records, events
from pulseweave.streaming import jobs, sinks
from pulseweave.streaming.processors import stream_credit_sessions, stream_drift

RANGES = {"click": (5.0, 100.0), "error": (5.0, 100.0), "purchase": (4.0, 140.0)}
CAPS = {"click": (20, 1), "error": (6, 1), "purchase": (10, 1), "signup": (1, 1), "view": (40, 1)}
CLASSES = {"click": "short", "view": "short", "purchase": "short", "error": "long"}
GAPS = {"short": 86_400, "long": 172_800}


@pytest.fixture(scope="module")
def source(spark, small, tmp_path_factory):
    """Sensor records, and a folder that holds them in time order in 5 files."""
    records = as_sensor_records(events(spark, small)).cache()
    folder = tmp_path_factory.mktemp("in")
    edges = [f"2024-01-{d:02d}" for d in (1, 7, 13, 19, 25)] + ["2024-02-01"]
    for i, (low, high) in enumerate(zip(edges, edges[1:])):
        (records.filter((F.col("ts") >= low) & (F.col("ts") < high)).coalesce(1)
         .write.mode("overwrite").parquet(str(folder / f"part{i}")))
    return records, str(folder)


def stream(spark, folder, files=None):
    return jobs.file_stream(spark, SENSOR_RECORD, f"{folder}/part*/*.parquet", files)


def run(frame, tmp_path, mode="append"):
    """All rows a query emits until its input is used up."""
    out = []

    def keep(batch, batch_id):
        out.extend(tuple(r) for r in batch.collect())

    query = (frame.writeStream.outputMode(mode).foreachBatch(keep)
             .option("checkpointLocation", str(tmp_path / uuid.uuid4().hex))
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return sorted(out)


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


def rounded(found):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in found)


def test_alerts(spark, source, tmp_path):
    records, folder = source
    ranges = normal_ranges(spark, RANGES)
    assert run(jobs.alert_job(stream(spark, folder, 1), ranges), tmp_path) == \
        rows(al.alerts(records, ranges))


@pytest.mark.parametrize("files", [1, None])
def test_closed_windows(spark, source, tmp_path, files):
    records, folder = source
    found = run(jobs.minute_job(stream(spark, folder, files), "1 day"), tmp_path)
    table = rows(windows.aggregated_records(windows.patient_windows(records, "1 day"),
                                            "window 1 day"))
    newest = max(r[2] for r in table)
    assert rounded(found) == rounded([r for r in table if r[2] < newest])


def test_global_averages(spark, source, tmp_path):
    records, folder = source
    found = run(jobs.global_average_job(stream(spark, folder, 1), "1 day"), tmp_path)
    table = rows(windows.global_averages(records, "1 day"))
    newest = max(r[1] for r in table)
    assert rounded(found) == rounded([r for r in table if r[1] < newest])


def test_gap_sessions(spark, source, tmp_path):
    records, folder = source
    classes = unit_classes(spark, CLASSES)
    timed = windows.with_event_time(stream(spark, folder, 1), "1 minute")
    found = rounded(run(sessions.all_sessions(timed, classes, GAPS), tmp_path))
    table = rounded(rows(sessions.all_sessions(records, classes, GAPS)))
    assert found and set(found) <= set(table)
    # What is left open ends less than a gap before the end of the stream.
    assert len(table) - len(found) < len(table) / 2


@pytest.mark.parametrize("files", [1, None])
def test_credit_sessions(spark, source, tmp_path, files):
    records, folder = source
    ranges, caps = normal_ranges(spark, RANGES), credit_caps(spark, CAPS)
    flagged = al.with_alert_flag(stream(spark, folder, files), ranges)
    found = run(stream_credit_sessions(flagged, caps), tmp_path, "update")
    table = credits.credit_sessions_with_alerts(al.with_alert_flag(records, ranges), caps)
    assert rounded(found) == rounded(rows(table))


def test_credit_sessions_with_an_alert_stream(spark, source, tmp_path):
    records, folder = source
    ranges, caps = normal_ranges(spark, RANGES), credit_caps(spark, CAPS)
    alert_stream = al.out_of_range(stream(spark, folder, 1), ranges)
    found = run(stream_credit_sessions(stream(spark, folder, 1), caps, alert_stream),
                tmp_path, "update")
    table = credits.credit_sessions_with_alerts(al.with_alert_flag(records, ranges), caps)
    assert rounded(found) == rounded(rows(table))


def test_sessionized_windows(spark, source, tmp_path):
    records, folder = source
    caps, classes = credit_caps(spark, CAPS), unit_classes(spark, CLASSES)
    found = rounded(run(jobs.session_window_job(
        stream(spark, folder, 1), "1 minute", classes, caps, GAPS), tmp_path))
    numbered = credits.with_session_id(records, caps).select(
        "patient_id", "unit", "session_id", "ts", "value")
    table = rounded(rows(sessions.all_sessions(numbered, classes, GAPS)))
    assert found and set(found) <= set(table)


def patient_series(frame):
    return frame.withColumn("unit", F.lit("all"))


def test_drift_in_one_batch_equals_the_table(spark, source, tmp_path):
    records, folder = source
    for emit in ("per_drift", "per_batch"):
        found = run(stream_drift(patient_series(stream(spark, folder)), F.lit(True), emit),
                    tmp_path, "update")
        assert found == rows(drift.detect_drift(patient_series(records), F.lit(True), emit))


def test_drift_over_batches_carries_state(spark, source, tmp_path):
    records, folder = source
    found = run(stream_drift(patient_series(stream(spark, folder, 1)), F.lit(True), "per_drift"),
                tmp_path, "update")
    # No series is long enough here to be trimmed between batches.
    assert found == rows(drift.detect_drift(patient_series(records), F.lit(True)))


def test_late_record_does_not_change_a_closed_window(spark, tmp_path, records):
    folder = str(tmp_path / "late")
    batches = [
        [("p", "u", 86_400 * 10 + 5, 1.0), ("p", "u", 86_400 * 10 + 20, 3.0)],
        [("p", "u", 86_400 * 10 + 600, 9.0)],
        [("p", "u", 86_400 * 10 + 700, 9.0)],
        [("p", "u", 86_400 * 10 + 30, 1000.0), ("p", "u", 86_400 * 10 + 1200, 5.0)],
    ]
    for i, batch in enumerate(batches):
        records(batch).coalesce(1).write.parquet(f"{folder}/part{i}")
    found = run(jobs.minute_job(stream(spark, folder, 1)), tmp_path)
    assert [r[4] for r in found][0] == 2.0
    assert found and all(r[6] < 1000 for r in found)


def test_restart_neither_loses_nor_repeats(spark, source, tmp_path):
    records, folder = source
    table, checkpoint = str(tmp_path / "table"), str(tmp_path / "check")
    caps, ranges = credit_caps(spark, CAPS), normal_ranges(spark, RANGES)
    total = None
    for visible in ("part[0-1]", "part*"):
        incoming = jobs.file_stream(spark, SENSOR_RECORD, f"{folder}/{visible}/*.parquet", 1)
        frame = jobs.credit_session_job(incoming, None, ranges, caps)
        query = sinks.fan_out(
            frame, {"table": sinks.table_target(AGGREGATED_RECORDS, table, "credits")}, {},
            checkpoint, mode="update")
        query.awaitTermination()
        total = read_stored(spark, AGGREGATED_RECORDS, table).count()
    whole = credits.credit_sessions_with_alerts(al.with_alert_flag(records, ranges), caps)
    assert total == whole.count()


def test_fan_out_to_tables_patients_and_notifications(spark, source, tmp_path):
    from pulseweave.operators import notify

    records, folder = source
    root = str(tmp_path / "out")
    ranges = normal_ranges(spark, RANGES)
    accepted, sent, skipped = sinks.Accepted(), [], []
    subscribed = records.filter("patient_id < '00000000-0000-0000-0000-000000000003'")
    targets = {
        "table": sinks.table_target(ALERTS, root, "alerts", patients=True, accepted=accepted),
        "push": sinks.notification_target(
            notify.alert_events, lambda s: subscribed.select("patient_id").distinct(),
            lambda frame, i: sent.extend(frame.collect())),
        "off": lambda batch, i: skipped.append(i),
    }
    query = sinks.fan_out(jobs.alert_job(stream(spark, folder, 1), ranges), targets,
                          {"off": False}, str(tmp_path / "check"))
    query.awaitTermination()
    expected = al.alerts(records, ranges)
    stored = read_stored(spark, ALERTS, root)
    assert stored.count() == accepted.rows == expected.count()
    assert (accepted.batches, accepted.last_batch) == (5, 4)
    ids = spark.read.parquet(f"{root}/patient_ids")
    assert ids.count() == ids.distinct().count() == accepted.new_patients
    assert ids.count() == expected.select("patient_id").distinct().count()
    assert len(sent) == expected.join(subscribed.select("patient_id").distinct(),
                                      "patient_id", "left_semi").count()
    assert skipped == []


def test_native_table_stream(spark, source, tmp_path):
    records, folder = source
    ranges = normal_ranges(spark, RANGES)
    query = sinks.table_stream(jobs.alert_job(stream(spark, folder, 2), ranges), ALERTS,
                               str(tmp_path), str(tmp_path / "check"), {"availableNow": True})
    query.awaitTermination()
    assert read_stored(spark, ALERTS, str(tmp_path)).count() == al.alerts(records, ranges).count()


def arriving(frame):
    late = F.timestamp_micros(F.unix_micros("ts") + F.crc32(F.col("patient_id")) % 90 * 1000000)
    return frame.withColumn("arrival_ts", late)


@pytest.mark.parametrize("meter", [meters.record_throughput, meters.alert_throughput,
                                   meters.period_counts, meters.latency_per_window])
def test_meters(spark, source, tmp_path, meter):
    records, folder = source
    timed = windows.with_event_time(arriving(stream(spark, folder, 1)), "1 hour", "arrival_ts")
    found = run(meter(timed, "6 hours"), tmp_path)
    table = rows(meter(arriving(records), "6 hours"))
    assert len(found) >= len(table) - 2
    assert found == table[:len(found)]


def test_patient_table_from_a_stream(spark, source, tmp_path):
    records, folder = source
    root, accepted = str(tmp_path / "ids"), sinks.Accepted()
    for i in range(2):  # a second query starts without state but finds the table
        query = sinks.patient_stream(stream(spark, folder, 2), root, str(tmp_path / f"c{i}"),
                                     accepted, {"availableNow": True})
        query.awaitTermination()
    ids = spark.read.parquet(f"{root}/patient_ids")
    expected = records.select("patient_id").distinct().count()
    assert ids.count() == ids.distinct().count() == accepted.new_patients == expected


def test_following_recently_alerted_patients(spark, source, tmp_path):
    from pulseweave.schemas import ALERTS as SPEC
    from pulseweave.sinks.tables import append_table

    records, folder = source
    now = records.withColumn("ts", F.current_timestamp()).filter(
        "patient_id <= '00000000-0000-0000-0000-000000000004'")
    append_table(al.alerts(now, normal_ranges(spark, RANGES)), SPEC, str(tmp_path))
    assert jobs.recently_alerted(str(tmp_path))(spark).count() == 5


def test_latency_stats(spark, source, tmp_path):
    records, folder = source

    timed = windows.with_event_time(arriving(stream(spark, folder, 1)), "2 days", "arrival_ts")
    found = rounded(run(meters.latency_stats(timed, "1 day"), tmp_path))
    table = rounded(rows(meters.latency_stats(arriving(records), "1 day")))
    assert found and set(found) <= set(table)


@pytest.mark.parametrize("kept", [[0, 1], [1, 2], [0, 2], []])
def test_batches_without_rows(spark, tmp_path, records, kept):
    folder, root = str(tmp_path / "in"), str(tmp_path / "out")
    for i in range(3):
        value = 500.0 if i in kept else 100.0
        records([("p", "HeartRate/Bpm", 1000 + 60 * i, value)]).coalesce(1).write.parquet(
            f"{folder}/part{i}")
    accepted = sinks.Accepted()
    for n, frame in enumerate((
            jobs.alert_job(stream(spark, folder, 1)),
            jobs.alert_job(stream(spark, folder, 1)).dropDuplicates(["id"]))):
        target = sinks.table_target(ALERTS, root, f"q{n}", patients=True, accepted=accepted)
        query = sinks.fan_out(frame, {"t": target}, {}, str(tmp_path / f"check{n}"))
        query.awaitTermination()
        assert query.exception() is None
        accepted.last_batch = -1
    assert accepted.rows == 2 * len(kept) and accepted.new_patients == (1 if kept else 0)
    if kept:
        assert read_stored(spark, ALERTS, root).count() == accepted.rows


def test_writers_of_one_table(spark, source, tmp_path):
    from pulseweave.sinks.tables import append_table, compact, replace_batch

    records, folder = source
    ranges, root = normal_ranges(spark, RANGES), str(tmp_path / "out")
    rows_ = al.alerts(records, ranges)
    for i in range(2):
        query = sinks.table_stream(jobs.alert_job(stream(spark, folder, 2), ranges), ALERTS, root,
                                   str(tmp_path / f"check{i}"), {"availableNow": True})
        query.awaitTermination()
        append_table(rows_, ALERTS, root)
        for _ in range(2):  # a retry
            replace_batch(rows_, ALERTS, root, "batch", 7)
    expected = sorted(r.id for r in rows_.collect())
    assert sorted(r.id for r in read_stored(spark, ALERTS, root).collect()) == sorted(5 * expected)
    last = rows_.agg(F.max("ts").cast("string")).first()[0]
    assert compact(spark, ALERTS, root, "2100-01-01 00:00:00") > 2
    assert sorted(r.id for r in read_stored(spark, ALERTS, root).collect()) == sorted(5 * expected)
    assert compact(spark, ALERTS, root, last) == 0
    replace_batch(rows_, ALERTS, root, "batch", 7)  # taken in by the compaction
    assert read_stored(spark, ALERTS, root).count() == 5 * len(expected)


def test_each_class_waits_for_its_own_grace(spark, tmp_path, records):
    folder = str(tmp_path / "in")
    rows = [[("p", "HeartRate/Bpm", 1000.0, 1.0), ("p", "BloodGlucose/mmol_L", 1000.0, 1.0)],
            [("q", "HeartRate/Bpm", 1090.0, 1.0), ("q", "BloodGlucose/mmol_L", 1090.0, 1.0)],
            [("q", "HeartRate/Bpm", 1091.0, 1.0), ("q", "BloodGlucose/mmol_L", 1091.0, 1.0)]]
    for i, batch in enumerate(rows):
        records(batch).coalesce(1).write.parquet(f"{folder}/part{i}")
    found = {route: run(jobs.class_window_job(stream(spark, folder, 1), route), tmp_path)
             for route in ("short", "long")}
    # 1091 - 40 is past the end 1000 + 40 of the short session; 1091 - 70 is not.
    assert [r[:2] for r in found["short"]] == [("p", "HeartRate/Bpm")]
    assert found["long"] == []
