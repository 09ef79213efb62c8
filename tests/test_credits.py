import random

import numpy as np
import pytest

from pulseweave.dims import credit_caps, normal_ranges
from pulseweave.operators.alerts import with_alert_flag
from pulseweave.operators.credits import (SessionScan, SlotEffect, credit_sessions,
                                          SlotSummary, _table_bytes, credit_sessions_with_alerts,
                                          session_ends, _advance, _state_index)


def lengths(cap, n, alerts=()):
    scan, out = SessionScan(cap, 1), []
    for i in range(1, n + 1):
        done = scan.step(i, 1.0)
        if done:
            out.append(done[3])
        if i in alerts:
            scan.alert()
    return out


def test_known_lengths():
    assert lengths(1, 12) == [1] * 12
    assert lengths(6, 22) == [1, 1, 2, 3, 4, 5, 6]
    assert lengths(6, 22, {8}) == [1, 1, 2, 3, 2, 4, 5]
    assert lengths(6, 12, set(range(1, 13))) == [1] * 12


def rows_of(n, patients=4, seed=5):
    rng = random.Random(seed)
    return [(f"p{p}", u, i * 10.0, float(rng.randint(60, 130)))
            for p in range(patients) for u in ("HeartRate/Bpm", "BloodPressure.Systolic/mmHg")
            for i in range(n)]


CAPS = {"HeartRate/Bpm": 20, "BloodPressure.Systolic/mmHg": 6}
LIMITS = {"HeartRate/Bpm": (80, 120), "BloodPressure.Systolic/mmHg": (90, 120)}


def expected(rows, with_alerts):
    out = []
    for p, u in sorted({r[:2] for r in rows}):
        scan = SessionScan(CAPS[u], 1)
        for r in sorted((r for r in rows if r[:2] == (p, u)), key=lambda r: r[2]):
            done = scan.step(int(r[2]), r[3])
            if done:
                out.append((p, u, done[0], done[1], done[2], done[3], round(done[4], 6), *done[5:]))
            if with_alerts and not LIMITS[u][0] <= r[3] <= LIMITS[u][1]:
                scan.alert()
    return sorted(out)


def collected(frame):
    return sorted((r.patient_id, r.unit, r.session_id, int(r.first_ts.timestamp()),
                   int(r.last_ts.timestamp()), r.n_records, round(r.avg_value, 6),
                   r.min_value, r.max_value) for r in frame.collect())


@pytest.mark.parametrize("slot", ["1 minute", "1 hour", "7 days"])
def test_closed_form_over_slots(spark, records, slot):
    rows = rows_of(300)
    found = credit_sessions(records(rows), credit_caps(spark), slot=slot)
    assert collected(found) == expected(rows, False)


def test_scan_with_alerts(spark, records):
    rows = rows_of(300)
    flagged = with_alert_flag(records(rows), normal_ranges(spark))
    assert collected(credit_sessions_with_alerts(flagged, credit_caps(spark))) == \
        expected(rows, True)


@pytest.mark.parametrize("slot", ["1 minute", "10 minutes", "1 hour"])
def test_a_dominant_series_spreads_over_its_slots(spark, records, slot):
    rows = rows_of(300) + [("busy", "HeartRate/Bpm", i * 3.0, 70.0 + i % 60) for i in range(3000)]
    flagged = with_alert_flag(records(rows), normal_ranges(spark))
    found = credit_sessions_with_alerts(flagged, credit_caps(spark), slot=slot)
    assert collected(found) == expected(rows, True)


@pytest.mark.parametrize("cap", [1, 2, 6])
def test_both_encodings_of_a_slot_have_one_effect(cap):
    rng = random.Random(cap)
    n = _table_bytes(cap) + 1
    flags = np.array([rng.random() < 0.1 for _ in range(n)])
    short, long = SlotSummary(cap, 1), SlotSummary(cap, 1)
    short.feed(flags[:-1])
    long.feed(flags)
    assert short.row()[3] is None and long.row()[2] is None
    table = np.frombuffer(long.row()[3], dtype=np.int64).reshape(-1, 3)
    for credits in range(cap + 1):
        for grant in range(1, cap + 1):
            walked = _advance((1, credits, grant), flags.astype(np.uint8).tobytes(), cap, 1)
            found = table[_state_index(credits, grant, cap)]
            assert walked == (1 + found[2], found[0], found[1])


def odd_rows(seed):
    rng = random.Random(seed)
    odd = [None, float("nan"), 70.0, 200.0, 100.0, 100.0]
    return [(p, "HeartRate/Bpm" if u else None, None if rng.random() < 0.05 else i,
             rng.choice(odd)) for p, u in (("p", 1), (None, 1), ("q", 0), ("busy", 1))
            for i in range(150 if p != "busy" else 900)]


@pytest.mark.parametrize("seed", range(3))
def test_one_rule_for_null_and_nan(spark, seed):
    rows = odd_rows(seed)
    frame = spark.createDataFrame(rows, "patient_id string, unit string, sec int, value double") \
        .selectExpr("patient_id", "unit", "timestamp_seconds(sec) AS ts", "value")
    key = lambda r: tuple("nan" if v != v else v for v in r)
    plain, with_flags = [], []
    for out, raises in ((plain, False), (with_flags, True)):
        for p in ("busy", "p"):
            scan = SessionScan(20, 1)
            ordered = sorted(((r[2], float("inf") if r[3] is None or r[3] != r[3] else r[3])
                              for r in rows if r[0] == p and r[1] and r[2] is not None))
            for sec, value in ordered:
                value = float("nan") if value == float("inf") else value
                done = scan.step(sec, value)
                if done:
                    out.append(key((p, *done[:4], round(done[4], 6), *done[5:])))
                if raises and value == 200.0:
                    scan.alert()
    flagged = frame.withColumn("is_alert", frame.value == 200.0).na.fill(False, ["is_alert"])
    closed_form = credit_sessions(frame, credit_caps(spark), slot="1 minute")
    got = lambda f: sorted(key((*r[:1], *r[2:])) for r in collected(f))
    assert got(closed_form) == sorted(plain)
    for slot in ("1 minute", "1 day"):
        assert got(credit_sessions_with_alerts(flagged, credit_caps(spark), slot=slot)) == \
            sorted(with_flags)


@pytest.mark.parametrize("cap", [1, 2, 5, 12])
def test_slot_effect_agrees_with_every_start(cap):
    rng = random.Random(cap)
    flags = [rng.random() < 0.2 for _ in range(400)]
    effect = SlotEffect(cap, 1)
    for flag in flags:
        effect.step(flag)
    table = effect.table()
    for c in range(cap + 1):
        for g in range(1, cap + 1):
            scan = SessionScan(cap, 1, (1, c, g))
            for flag in flags:
                scan.step(0, 0.0)
                if flag:
                    scan.alert()
            at = c * cap + g - 1
            assert tuple(table[at]) == (scan.credits, scan.grant, scan.session_id - 1)


def test_unknown_unit_uses_the_default_cap(spark, records):
    found = credit_sessions(records([("p", "new", i, 1.0) for i in range(8)]),
                            credit_caps(spark), default_cap=2)
    assert [r.n_records for r in found.orderBy("session_id").collect()] == [1, 1, 2, 2, 2]


def test_no_records(spark, records):
    flagged = with_alert_flag(records([("p", "u", 0, 1.0)]).filter("value > 5"),
                              normal_ranges(spark))
    assert credit_sessions_with_alerts(flagged, credit_caps(spark)).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_session_ends_agree_with_single_steps(seed):
    rng = random.Random(seed)
    for _ in range(60):
        cap, n = rng.randint(1, 12), rng.randint(0, 80)
        flags = [rng.random() < rng.choice([0, 0.05, 0.4, 1]) for _ in range(n)]
        credits, grant = rng.randint(0, cap), rng.randint(1, cap)
        scan = SessionScan(cap, 1, (1, credits, grant))
        ends = []
        for i, flag in enumerate(flags):
            if scan.step(i, 0.0):
                ends.append(i)
            if flag:
                scan.alert()
        assert session_ends([i for i, f in enumerate(flags) if f], n, credits, grant, cap, 1) == \
            (ends, scan.credits, scan.grant)


@pytest.mark.parametrize("rows_per_batch", ["1", "7", "64"])
def test_sessions_span_arrow_batches(spark, records, rows_per_batch):
    rows = rows_of(60, patients=2)
    flagged = with_alert_flag(records(rows), normal_ranges(spark))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows_per_batch)
    try:
        found = collected(credit_sessions_with_alerts(flagged, credit_caps(spark)))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found == expected(rows, True)
