"""Boundary cases of the relational operators."""

import random

import pytest
from pyspark.sql import functions as F

from pulseweave.dims import local_table, normal_ranges, unit_classes
from pulseweave.functions import ids, text, times
from pulseweave.operators import (alerts as al, batches, meters, notify, patients, reads, routing,
                                  series, sessions, windows)
from pulseweave.operators.ordering import with_position
from pulseweave.schemas import AGGREGATED_RECORDS, ALERTS, TABLES
from pulseweave.sinks.tables import append_table, read_stored, replace_batch, stored_rows
from pulseweave.sinks.text import as_lines, write_lines
from pulseweave.sources.dimensions import parse_ranges, read_ranges

P = "00000000-0000-0000-0000-00000000000"


def test_range_bounds_are_normal(spark, records):
    frame = records([("p", "HeartRate/Bpm", i, v) for i, v in enumerate(
        [80, 120, 79.999, 120.001, float("nan"), 100])] + [("p", "StepCount/Count", 9, 1e9)])
    found = al.alerts(frame, normal_ranges(spark)).collect()
    assert sorted(int(r.ts.timestamp()) for r in found) == [2, 3, 4]
    flags = al.with_alert_flag(frame, normal_ranges(spark))
    assert flags.count() == 7 and flags.filter("is_alert").count() == 3


def test_alert_ids_are_stable_and_distinct(spark, records):
    frame = records([("p", "HeartRate/Bpm", i, 10) for i in range(20)])
    one, two = (sorted(r.id for r in al.alerts(frame, normal_ranges(spark)).collect())
                for _ in range(2))
    assert one == two and len(set(one)) == 20


def test_random_id_has_the_same_form(spark):
    value = spark.range(1).select(ids.random_id()).first()[0]
    assert len(value) == 36


def test_ranges_from_json(spark, tmp_path):
    path = tmp_path / "ranges.json"
    path.write_text('{"a/b": {"max": 2, "min": 1},\n "c": {"max": 3.5, "min": -1}}')
    found = {r.unit: (r.lo, r.hi) for r in read_ranges(spark, str(path)).collect()}
    assert found == {"a/b": (1.0, 2.0), "c": (-1.0, 3.5)}


def test_range_without_a_bound_is_an_error(spark):
    with pytest.raises(Exception, match="without both bounds"):
        parse_ranges(spark.sql("""SELECT '{"a": {"max": 1}}' AS value""")).collect()


def test_dimension_is_broadcast_by_size(spark, records):
    plan = al.alerts(records([("p", "u", 0, 1)]), normal_ranges(spark))
    assert "BroadcastHashJoin" in plan._jdf.queryExecution().executedPlan().toString()


def test_text_with_quotes_in_a_local_table(spark):
    assert local_table(spark, "a, n", [("it's \\ here", 1)]).first().a == "it's \\ here"


def test_flatten_edge_shapes(spark):
    frame = spark.sql("""
        SELECT array() AS Batch
        UNION ALL SELECT array(named_struct('PatientId', unhex('0000000000000000000000000000000a'),
                                            'Records', array()))
        UNION ALL SELECT array(
            named_struct('PatientId', unhex('0000000000000000000000000000000b'), 'Records',
                array(named_struct('Timestamp', 1000L, 'Value', 1.5D, 'Unit', 'u'),
                      named_struct('Timestamp', 1000L, 'Value', 2.5D, 'Unit', 'u'))),
            named_struct('PatientId', unhex('ff00000000000000000000000000000c'), 'Records',
                array(named_struct('Timestamp', 2000L, 'Value', 3.5D, 'Unit', ''))))""")
    found = sorted((r.patient_id, r.unit, r.ts.timestamp(), r.value)
                   for r in batches.flatten_batches(frame).collect())
    assert found == [("00000000-0000-0000-0000-00000000000b", "u", 1.0, 1.5),
                     ("00000000-0000-0000-0000-00000000000b", "u", 1.0, 2.5),
                     ("ff000000-0000-0000-0000-00000000000c", "", 2.0, 3.5)]


def test_pack_then_flatten_is_identity_and_bounded(records):
    rng = random.Random(1)
    rows = [(P + str(rng.randint(0, 3)), "u", round(rng.random() * 5, 3), rng.randint(0, 9))
            for _ in range(400)]
    frame = records(rows)
    packed = batches.pack_batches(frame, "1 second", limit=7, batch_size=3, lanes=2)
    sizes = packed.select(F.size("Batch").alias("n"),
                          F.expr("max(0) OVER ()"),
                          F.array_max(F.transform("Batch", lambda h: F.size(h.Records))).alias("m"))
    top = sizes.agg(F.max("n").alias("n"), F.max("m").alias("m")).first()
    assert top.n <= 3 and top.m <= 7
    key = ["patient_id", "unit", "ts", "value"]
    assert sorted(map(tuple, batches.flatten_batches(packed).select(key).collect())) == \
        sorted(map(tuple, frame.select(key).collect()))


def test_routes(spark, records):
    frame = records([("p", "HeartRate/Bpm", 0, 1), ("p", "BloodGlucose/mmol_L", 0, 1),
                     ("p", "?", 0, 1)])
    classes = unit_classes(spark)
    assert {r.unit: r.route for r in routing.with_route(frame, classes).collect()} == {
        "HeartRate/Bpm": "short", "BloodGlucose/mmol_L": "long", "?": "other"}
    for route, unit in (("short", "HeartRate/Bpm"), ("long", "BloodGlucose/mmol_L"), ("other", "?")):
        assert [r.unit for r in routing.routed(frame, classes, route).collect()] == [unit]


def test_row_on_a_minute_edge_and_negative_values(records):
    frame = records([("p", "u", 59.999, -5), ("p", "u", 60, -7), ("p", "u", 119, -9)])
    found = {r.ts.timestamp(): (r.avg_value, r.min_value, r.max_value, r.n_records)
             for r in windows.patient_windows(frame).collect()}
    assert found == {0.0: (-5, -5, -5, 1), 60.0: (-8, -9, -7, 2)}


def test_global_average_is_the_weighted_mean_of_patient_averages(records):
    rng = random.Random(2)
    frame = records([(f"p{rng.randint(0, 5)}", "u", rng.randint(0, 600), rng.random())
                     for _ in range(300)])
    per = windows.patient_windows(frame)
    merged = {r.ts: r.v for r in per.groupBy("ts").agg(
        (F.sum(F.col("avg_value") * F.col("n_records")) / F.sum("n_records")).alias("v")).collect()}
    for r in windows.global_averages(frame).collect():
        assert r.value == pytest.approx(merged[r.ts])


def test_window_key_roundtrip_and_bad_keys(spark, records):
    keyed = windows.keyed_global_averages(
        windows.global_averages(records([("p", "HeartRate/Bpm", 61, 80)])))
    assert keyed.first().key == "[HeartRate/Bpm@60000/120000]"
    bad = spark.sql("SELECT 'nonsense' AS key, 1.0D AS value UNION ALL SELECT 'x[a@1/2]', 2.0D")
    parsed = windows.parse_global_averages(keyed.unionByName(bad)).collect()
    assert [(r.unit, r.ts.timestamp(), r.value) for r in parsed] == [("HeartRate/Bpm", 60.0, 80.0)]


def test_gap_boundaries(spark, records):
    short, long = "HeartRate/Bpm", "BloodGlucose/mmol_L"
    frame = records([("a", short, 0, 1), ("a", short, 40, 3), ("b", short, 0, 1),
                     ("b", short, 40.001, 3), ("c", long, 0, 1), ("c", long, 70, 3),
                     ("d", long, 0, 1), ("d", long, 70.001, 3), ("e", "?", 0, 1)])
    found = sessions.all_sessions(frame, unit_classes(spark))
    counts = {}
    for r in found.collect():
        counts.setdefault(r.patient_id, []).append((r.ts.timestamp(), r.avg_value, r.n_records))
    assert counts["a"] == [(20.0, 2.0, 2)]
    assert sorted(counts["b"]) == [(0.0, 1.0, 1), (40.001, 3.0, 1)]
    assert counts["c"] == [(35.0, 2.0, 2)]
    assert len(counts["d"]) == 2 and "e" not in counts


def brute_sessions(points, gap):
    out, current = [], []
    for t, v in sorted(points):
        if current and t - current[-1][0] > gap:
            out.append(current)
            current = []
        current.append((t, v))
    return out + [current]


def test_gap_sessions_with_one_dominant_series(records):
    """A third of all rows in one series, in dense and sparse stretches."""
    rng = random.Random(4)
    rows = [("hot", "u", rng.choice([rng.random() * 500, 5000 + rng.random() * 20000]), rng.random())
            for _ in range(3000)]
    rows += [(f"p{i % 150}", "u", rng.random() * 25000, rng.random()) for i in range(6000)]
    rows = [(p, u, round(t, 6), v) for p, u, t, v in rows]
    found = sessions.gap_sessions(records(rows), ["patient_id", "unit"], 40)
    got = sorted((r.patient_id, round(r.first_ts.timestamp(), 6), round(r.last_ts.timestamp(), 6),
                  r.n_records, r.min_value, r.max_value) for r in found.collect())
    expected = []
    for p in {r[0] for r in rows}:
        for s in brute_sessions([(r[2], r[3]) for r in rows if r[0] == p], 40):
            values = [v for _, v in s]
            expected.append((p, s[0][0], s[-1][0], len(s), min(values), max(values)))
    assert got == sorted(expected)


def test_union_of_classes_equals_one_pass(spark, records):
    rng = random.Random(6)
    frame = records([(f"p{i % 3}", rng.choice(["HeartRate/Bpm", "BloodGlucose/mmol_L", "?"]),
                      rng.randint(0, 4000), rng.random()) for i in range(200)])
    classes = unit_classes(spark)
    both = sessions.class_sessions(frame, classes, "short").unionByName(
        sessions.class_sessions(frame, classes, "long"))
    assert sorted(map(tuple, both.collect())) == \
        sorted(map(tuple, sessions.all_sessions(frame, classes).collect()))


@pytest.mark.parametrize("slot", ["1 second", "1 minute", "1 day"])
def test_position(records, slot):
    rng = random.Random(7)
    rows = [("hot" if i % 3 == 0 else f"p{i % 10}", "u", rng.random() * 300, rng.random())
            for i in range(600)]
    placed = with_position(records(rows), ["patient_id", "unit"], slot).collect()
    for p in {r[0] for r in rows}:
        mine = sorted((r for r in placed if r.patient_id == p), key=lambda r: (r.ts, r.value))
        assert [r.position for r in mine] == list(range(1, len(mine) + 1))


def arrivals(records, rows):
    """(arrival second, latency seconds) pairs as records with arrival_ts."""
    frame = records([("p", "u", a - late, late) for a, late in rows])
    return frame.withColumn("arrival_ts", F.timestamp_micros(
        F.unix_micros("ts") + (F.col("value") * 1_000_000).cast("bigint")))


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 10, 29, 30, 1000])
def test_percentiles_are_nearest_rank(records, n):
    rng = random.Random(n)
    late = [round(rng.random() * rng.choice([1, 100]), 3) for _ in range(n)]
    stats = meters.latency_stats(arrivals(records, [(1000.5, x) for x in late]), "1 minute").first()
    ms = sorted(round(x * 1000) for x in late)
    # Latency is a difference of two rounded-down times.
    for p in (20, 50, 80):
        assert abs(stats[f"p{p}"] - ms[-(-p * n // 100) - 1]) <= 1
    assert stats.n_records == n and abs(stats.max_latency - ms[-1]) <= 1


def test_running_max_over_blocks(spark):
    rng = random.Random(9)
    rows = [(i * 3600, rng.randint(0, 1000) - i) for i in range(400) if rng.random() < 0.4]
    frame = spark.createDataFrame(rows, "s bigint, v bigint").selectExpr(
        "timestamp_seconds(s) AS at", "v")
    found = {int(r["at"].timestamp()): r.top
             for r in meters.with_running_max(frame, "v", "at", "top").collect()}
    best = None
    for s, v in rows:
        best = v if best is None else max(best, v)
        assert found[s] == best


def test_period_counts_after_a_gap(records):
    frame = arrivals(records, [(1, 0), (2, 0), (11, 0), (35, 0)])
    found = {r.window_start.timestamp(): (r.n_records, r.n_previous)
             for r in meters.period_counts(frame).collect()}
    assert found == {0.0: (2, 0), 10.0: (1, 2), 30.0: (1, 0)}


def test_debounce(spark, records):
    frame = arrivals(records, [(0, 0), (9, 0), (30, 0)])
    listening = spark.sql("SELECT 'p' AS patient_id")
    found = sorted((r.sent_ts.timestamp(), r.n_records)
                   for r in notify.record_events(frame, listening).collect())
    assert found == [(19.0, 2), (40.0, 1)]
    assert notify.record_events(frame, listening.filter("false")).count() == 0


def stored(spark, rows):
    return spark.createDataFrame(rows, "id string, patient_id string, s double, u string, v double") \
        .selectExpr("id", "patient_id", "timestamp_millis(cast(s * 1000 AS bigint)) AS ts", "u", "v")


def test_read_range_ends_are_inclusive_and_zero_means_default(spark):
    table = stored(spark, [("a", "p", 100.0, "u", 1.0), ("b", "p", 200.0, "u", 1.0),
                           ("c", "p", 200.001, "u", 1.0), ("d", "q", 150.0, "u", 1.0)])
    found = reads.patient_alerts(table, "p", "1970-01-01 00:10:00", 100_000, 200_000)
    assert sorted(r.id for r in found.collect()) == ["a", "b"]
    for low in (0, None):
        last_hour = reads.patient_alerts(table, "p", "1970-01-01 01:03:20", low, 0)
        assert sorted(r.id for r in last_hour.collect()) == ["b", "c"]


def test_partition_bounds_prune_files(spark, records, tmp_path):
    rows = [("p", "HeartRate/Bpm", d * 86_400 + 60, 10) for d in range(1, 10)]
    for i in range(0, 9, 3):
        append_table(al.alerts(records(rows[i:i + 3]), normal_ranges(spark)), ALERTS,
                     str(tmp_path))
    table = read_stored(spark, ALERTS, str(tmp_path))
    found = reads.patient_alerts(table, "p", "1970-02-01", 3 * 86_400_000, 5 * 86_400_000)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(ts_day)" in plan.split("PushedFilters")[1]
    assert found.count() == 2
    part = read_stored(spark, ALERTS, str(tmp_path), since="1970-01-06", until="1970-01-06")
    assert part.count() == 1 and len(part.inputFiles()) < len(table.inputFiles())


def test_recent_patients_ties_and_limit(spark):
    table = stored(spark, [(str(i), p, 1000.0, "u", 1.0) for i, p in
                           enumerate(["b", "a", "a", "b", "c", "d", "d", "d"])])
    found = reads.recent_patients(table, "1970-01-01 00:20:00", "15 minutes", top=3).collect()
    assert [(r.patient_id, r.alert_count) for r in found] == [("d", 3), ("a", 2), ("b", 2)]


@pytest.mark.parametrize("fragment, expected", [
    ("ab", []), ("abc", ["xxabcxx", "yabc"]), ("ABC", []), ("%ab", []), ("zzz", [])])
def test_search_fragments(spark, fragment, expected):
    people = spark.createDataFrame([("xxabcxx",), ("yabc",), ("abd",)], "patient_id string")
    assert sorted(r[0] for r in reads.matching_patients(people, fragment).collect()) == expected
    grams = patients.ngram_table(people)
    assert sorted(r[0] for r in reads.matching_patients_by_ngram(grams, fragment).collect()) == \
        expected


def test_ngrams_of_short_text(spark):
    found = spark.sql("SELECT 'ABcd' AS t UNION ALL SELECT 'ab'").select(text.ngrams(F.col("t")))
    assert sorted(tuple(r[0]) for r in found.collect()) == [(), ("abc", "bcd", "abcd")]


def test_search_keeps_patients_without_alerts_last(spark):
    records_ = stored(spark, [("1", "pab1", 1000.0, "u", 1.0), ("2", "pab2", 1000.0, "u", 1.0),
                              ("3", "pab3", 0.5, "u", 1.0)])
    alerts = stored(spark, [("4", "pab2", 1.0, "u", 1.0)])
    found = reads.search_patients(records_.select("patient_id"), records_, alerts, "pab",
                                  "1970-01-01 00:20:00", "15 minutes")
    assert [tuple(r) for r in found.collect()] == [("pab2", 1), ("pab1", None)]
    assert [r.alert_count for r in reads.zero_for_none(found).collect()] == [1, 0]


def test_dedup_picks_by_order(records):
    frame = records([("p", "u", 1, 5), ("p", "u", 1, 3), ("p", "u", 2, 9)])
    found = series.dedup_points(frame, ["value"])
    assert sorted((r.ts.timestamp(), r.value) for r in found.collect()) == [(1.0, 3.0), (2.0, 9.0)]


def test_chart_floor_is_at_most_1000(records):
    frame = windows.patient_windows(records([("p", "u", 0, 5000), ("q", "u", 0, -3)]))
    assert {r.patient_id: r.floor for r in series.chart_floor(frame).collect()} == {
        "p": 1000.0, "q": -3.0}


def test_overlay_includes_both_ends(spark, records):
    frame = records([("p", "u", s, s) for s in range(0, 20_000, 1000)])
    drifts = spark.sql("""SELECT 'd' AS id, 'p' AS patient_id, 'u' AS unit,
        timestamp_seconds(3000) AS `from`, timestamp_seconds(9000) AS `to`""")
    found = sorted(r.value for r in series.drift_overlay(frame, drifts).collect())
    assert found == [float(s) for s in range(3000, 9001, 1000)]


def test_new_patients(spark, records):
    frame = records([("a", "u", 0, 1), ("a", "u", 1, 1), ("b", "u", 0, 1)])
    known = spark.sql("SELECT 'b' AS patient_id")
    assert [r[0] for r in patients.new_patients(frame, known).collect()] == ["a"]


def test_replaced_batch_leaves_one_copy(spark, records, tmp_path):
    frame = al.alerts(records([("p", "HeartRate/Bpm", i * 50_000, 10) for i in range(20)]),
                      normal_ranges(spark))
    for batch in (0, 1, 1, 0):
        replace_batch(frame, ALERTS, str(tmp_path), "w", batch)
    table = read_stored(spark, ALERTS, str(tmp_path))
    assert table.count() == 40
    assert table.select("ts_day").distinct().count() == 11


@pytest.mark.parametrize("layout", ["range", "rebalance"])
def test_appended_rows_are_all_there(spark, records, tmp_path, layout):
    """With most rows in one patient and one day."""
    rows = [("hot", "HeartRate/Bpm", 86_400 + i, 10) for i in range(500)]
    rows += [(f"p{i}", "HeartRate/Bpm", i * 40_000, 10) for i in range(30)]
    frame = al.alerts(records(rows), normal_ranges(spark))
    append_table(frame, ALERTS, str(tmp_path), layout)
    back = read_stored(spark, ALERTS, str(tmp_path))
    assert sorted(r.id for r in back.select("id").collect()) == \
        sorted(r.id for r in frame.select("id").collect())
    if layout == "range":
        hot = back.filter("patient_id = 'hot'").select(F.input_file_name()).distinct().count()
        assert hot > 1


def test_stored_columns(spark, records):
    aggregates = windows.aggregated_records(windows.patient_windows(records([("p", "u", 3700, 1)])))
    row = stored_rows(aggregates, AGGREGATED_RECORDS).first()
    assert (row.u, row.avg_v, row.ts_hour.timestamp()) == ("u", 1.0, 3600.0)
    assert set(TABLES) == {"aggregated_records", "alerts", "adwin_alerts", "global_averages"}


def test_text_sink(spark, tmp_path):
    frame = spark.sql("SELECT 5 AS latency, 'x' AS unit UNION ALL SELECT NULL, 'y'")
    write_lines(frame, str(tmp_path / "log"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "log")).collect()) == [
        "latency=5, unit=x", "latency=null, unit=y"]
    assert as_lines(frame).columns == ["value"]


def test_ids_and_times(spark):
    row = spark.sql("SELECT unhex('00112233445566778899AABBCCDDEEFF') AS raw, "
                    "timestamp_millis(1700000000123) AS ts").select(
        ids.uuid_from_bytes(F.col("raw")).alias("u"), F.col("raw"),
        ids.bytes_from_uuid(ids.uuid_from_bytes(F.col("raw"))).alias("again"),
        times.to_millis(F.col("ts")).alias("ms"),
        text.unit_label(F.lit("a/b/c")).alias("label"),
        times.midpoint(times.from_millis(F.lit(1)), times.from_millis(F.lit(4))).alias("mid")).first()
    assert row.u == "00112233-4455-6677-8899-aabbccddeeff"
    assert row.raw == row.again and row.ms == 1700000000123
    assert row.label == "a / b / c" and row.mid.timestamp() == 0.002


def test_two_readings_at_one_instant_are_two_alerts(spark, records):
    frame = records([(P + "1", "HeartRate/Bpm", 5, 500.0), (P + "1", "HeartRate/Bpm", 5, 600.0),
                     (P + "1", "HeartRate/Bpm", 5, float("nan"))])
    found = al.alerts(frame, normal_ranges(spark))
    assert series.dedup_by_id(found.unionByName(found)).count() == 3


def test_parts_of_ids_do_not_run_together(spark):
    from pulseweave.functions.ids import stable_id

    rows = [("a:b", "c"), ("a", "b:c"), (None, "c"), ("-", "c"), ("", "c"), ("c", None)]
    frame = spark.createDataFrame(rows, "x string, y string")
    assert frame.select(stable_id(F.col("x"), F.col("y"))).distinct().count() == len(rows)


def test_windows_and_sessions_have_ids_of_their_own(records):
    found = windows.patient_windows(records([("p", "u", 0, 1.0)]), "1 minute")
    ids = {windows.aggregated_records(found, kind).first().id
           for kind in ("window 1 minute", "window 1 day", "credit session")}
    assert len(ids) == 3


def test_first_incremental_read(records):
    frame = records([("p", "u", 86_400.0 * d, 1.0) for d in range(20)])
    none = frame.limit(0)
    assert series.since_latest(frame, none, "1970-01-20 00:00:00", "3 days").count() == 4
    assert series.since_latest(frame, frame.filter("ts < '1970-01-06'")).count() == 16


def test_records_without_latency_are_left_out(spark):
    frame = spark.sql("SELECT * FROM VALUES (TIMESTAMP'1970-01-02', TIMESTAMP'1970-01-02'), "
                      "(NULL, TIMESTAMP'1970-01-02'), (TIMESTAMP'1970-01-02', NULL) "
                      "AS t(ts, arrival_ts)")
    assert [r.n_records for r in meters.latency_stats(frame, "1 day").collect()] == [1]


def test_lanes_follow_the_hubs_of_a_tick(spark, records):
    frame = records([(P[:-2] + f"{i:02d}", "u", 5.0 + i % 3, 1.0) for i in range(90)]
                    + [(P + "1", "u", 100.0, 1.0)])
    packed = batches.pack_batches(frame, "1 minute", batch_size=2)
    sizes = [len(r.Batch) for r in packed.collect()]
    assert sum(sizes) == 91 and max(sizes) <= 2 and len(sizes) < 91 / 2 + 10
    with pytest.raises(ValueError):
        batches.pack_batches(spark.readStream.format("rate").load().selectExpr(
            "'p' AS patient_id", "'u' AS unit", "timestamp AS ts", "1D AS value"))
