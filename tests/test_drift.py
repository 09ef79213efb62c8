import json
import random

import pytest
from pyspark.sql import functions as F

from pulseweave.operators.drift import DriftCall, DriftWindow, detect_drift, detect_drift_in_slices


def step_value(i, step):
    return 100.0 + (1 if i % 2 else -1) + (10 if step and i >= 40 else 0)


def run(step, adaptive, n=80):
    window, found = DriftWindow(adaptive), []
    for i in range(n):
        if window.add(step_value(i, step), i * 1000):
            found.append((i, window.starts(), window.ends(), window.width))
    return window, found


def test_flat_series_never_drifts():
    window, found = run(False, False)
    assert found == []
    assert (window.width, window.total, round(window.variance, 6)) == (80, 8000.0, 80.0)
    assert [len(r) for r in window.rows] == [4, 4, 5, 4, 1]


def test_short_window_is_not_tested():
    window, _ = run(False, False, 16)
    assert [len(r) for r in window.rows] == [4, 4, 1]


def test_step_is_found():
    window, found = run(True, False)
    assert found == [(57, 16000, 57000, 42), (67, 32000, 67000, 36), (75, 40000, 75000, 36)]
    assert (window.width, window.total, round(window.variance, 6)) == (40, 4400.0, 79.184586)


def test_step_is_found_sooner_with_adaptive_sensitivity():
    window, found = run(True, True)
    assert [f[0] for f in found] == [51, 59, 67, 75]
    assert round(window.variance, 6) == 79.118881


def test_published_variance_differs():
    ours, published = DriftWindow(False), DriftWindow(False, published=True)
    for i in range(80):
        ours.add(step_value(i, True), i)
        published.add(step_value(i, True), i)
    assert ours.variance != published.variance
    assert published.variance >= 0


def test_state_survives_storage():
    rng = random.Random(3)
    values = [rng.gauss(50 + 30 * (i // 100), 5) for i in range(600)]
    whole = DriftWindow(True)
    resumed = DriftWindow(True)
    for i, v in enumerate(values):
        a = whole.add(v, i)
        b = resumed.add(v, i)
        assert a == b
        if i % 37 == 0:
            resumed = DriftWindow.load(json.loads(json.dumps(resumed.dump())), True)
    assert whole.dump() == resumed.dump()


def brute_force(values, times, adaptive):
    """The rules applied to a window kept as plain lists of bucket dicts,
    recomputing every total from the buckets where the rules allow it."""
    import math
    rows, out = [[]], []
    variance, delta, ratio, relative = 0.0, 0.3, 1.0, 0.0
    high, low = 5e-324, math.inf
    total = 0.0

    def width():
        return sum(len(r) * 2 ** i for i, r in enumerate(rows))

    for v, t in zip(values, times):
        rows[0].append({"s": v, "v": 0.0, "t": t})
        w = width()
        high, low = max(high, v), min(low, v)
        if adaptive and len(rows[0]) > 1 and high > low:
            diff = abs(rows[0][-1]["s"] - rows[0][-2]["s"])
            relative = 0.3 * (diff / (high - low)) + 0.7 * relative
            if 0.15 < relative < 0.4:
                small = diff < 0.4
                delta = min(0.8 if small else 0.6, 0.3 + (relative - 0.08) * 3)
                ratio = (max(0.35, 1 - relative * 3.5) if small else max(0.5, 1 - relative * 2.5))
                relative -= 0.0 if small else 0.015
            elif relative >= 0.4:
                relative -= 0.1
        if w > 1:
            variance += (w - 1) / w * (v - total / (w - 1)) * (v - total / (w - 1))
        total += v
        i = 0
        while i < len(rows) and len(rows[i]) == 6:
            if i + 1 == len(rows):
                rows.append([])
            a, b = rows[i][:2]
            n = 2.0 ** i
            gap = a["s"] / n - b["s"] / n
            rows[i + 1].append({"s": a["s"] + b["s"],
                                "v": a["v"] + b["v"] + n * n * gap * gap / (2 * n),
                                "t": min(a["t"], b["t"])})
            rows[i] = rows[i][2:]
            i += 1
        changed = False
        again = w > 16
        while again:
            again = False
            top = len(rows) - 1
            if top == 0:
                break
            size = 2 ** top
            for k in range(len(rows[top]) - 1):
                n0 = (k + 1) * size
                n1 = width() - n0
                u0, u1 = 0.0, total
                for b in rows[top][:k + 1]:
                    u0 += b["s"]
                    u1 -= b["s"]
                if n0 < 5 or n1 < 5:
                    continue
                dd = math.log(2 * math.log(width()) / delta)
                m = 1 / (n0 - 4) + 1 / (n1 - 4)
                x = 2 * m * (variance / width()) * dd
                if x < 0:
                    continue
                if abs(u0 / n0 - u1 / n1) > (math.sqrt(x) + 2 / 3 * dd * m) * ratio:
                    for _ in range(k + 1):
                        top = len(rows) - 1
                        n = 2 ** top
                        b = rows[top][0]
                        rows[top] = rows[top][1:]
                        if not rows[top]:
                            rows.pop()
                        left = width()
                        total -= b["s"]
                        off = b["s"] / n - total / left
                        variance -= (b["v"] + n * left * off * off) / (n + left)
                    changed = again = True
                    break
        if changed:
            out.append((rows[-1][0]["t"], rows[0][-1]["t"], v, width()))
    return out


@pytest.mark.parametrize("adaptive", [False, True])
@pytest.mark.parametrize("seed", range(4))
def test_against_brute_force(seed, adaptive):
    rng = random.Random(seed)
    values = [rng.gauss(20 + 15 * (i // 80 % 2), 3) - (30 if seed == 2 else 0)
              for i in range(500)]
    call = DriftCall(DriftWindow(adaptive), "per_drift")
    found = [row[:4] for row in call.feed(values, list(range(500)))]
    assert found == brute_force(values, list(range(500)), adaptive)
    assert found


def series(records, n=400, patients=5):
    rng = random.Random(11)
    rows = []
    for p in range(patients):
        for i in range(n):
            rows.append((f"p{p}", "all", i * 60.0, rng.gauss(50 + 40 * (i // 90 % 2), 4)))
    rng.shuffle(rows)
    return rows, records(rows)


def test_series_span_arrow_batches(spark, records):
    rows, frame = series(records)
    default = detect_drift(frame, F.lit(False)).orderBy("id").collect()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        tiny = detect_drift(frame, F.lit(False)).orderBy("id").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert default and default == tiny


def test_table_scan_equals_brute_force(records):
    rows, frame = series(records)
    found = sorted((r.patient_id, r["from"].timestamp(), r["to"].timestamp(), r.value, r.width)
                   for r in detect_drift(frame, F.lit(True)).collect())
    expected = []
    for p in sorted({r[0] for r in rows}):
        mine = sorted((r for r in rows if r[0] == p), key=lambda r: r[2])
        for a, b, v, w in brute_force([r[3] for r in mine], [r[2] for r in mine], True):
            expected.append((p, a, b, v, w))
    assert found == sorted(expected)


def test_per_batch_keeps_the_last_drift(records):
    rows, frame = series(records)
    each = detect_drift(frame, F.lit(False)).collect()
    last = {r.patient_id: r for r in detect_drift(frame, F.lit(False), emit="per_batch").collect()}
    for p in last:
        newest = max((r for r in each if r.patient_id == p), key=lambda r: r["to"])
        assert (last[p]["from"], last[p]["to"]) == (newest["from"], newest["to"])
        assert last[p].value == max((r for r in rows if r[0] == p), key=lambda r: r[2])[3]


@pytest.mark.parametrize("seed", range(3))
def test_edges_of_slices_do_not_matter(records, seed):
    rng = random.Random(seed)
    rows = [("p", "u", i * 60.0, 50.0 + rng.random() + 30 * (i // 250 % 2)) for i in range(800)]
    edges = sorted(f"1970-01-01 {rng.randint(0, 12):02d}:{rng.randint(0, 59):02d}:00"
                   for _ in range(3))
    frame = records(rows)
    whole = sorted(map(tuple, detect_drift(frame, F.lit(False)).collect()))
    assert whole and sorted(map(tuple, detect_drift_in_slices(
        frame, edges, F.lit(False)).collect())) == whole


def test_slices_equal_calls_with_stored_state(spark, records):
    """Each slice with readings of a series is one call on its stored window."""
    rows, _ = series(records)
    # One series pauses for the whole middle slice.
    rows = [r for r in rows if r[0] != "p1" or not 5400 <= r[2] < 14400]
    edges = ["1970-01-01 01:30:00", "1970-01-01 04:00:00"]
    found = detect_drift_in_slices(records(rows), edges, F.lit(False), calls="per_slice")
    expected = []
    for p in sorted({r[0] for r in rows}):
        mine = sorted((r for r in rows if r[0] == p), key=lambda r: r[2])
        window = None
        for low, high in ((0, 5400), (5400, 14400), (14400, 1e9)):
            part = [r for r in mine if low <= r[2] < high]
            if not part:
                continue
            if window is None:
                window = DriftWindow(False)
            else:
                window.trim()
            expected += [(p, r[0], r[1]) for r in DriftCall(window, "per_drift").feed(
                [r[3] for r in part], [int(r[2]) for r in part])]
    got = sorted((r.patient_id, int(r["from"].timestamp()), int(r["to"].timestamp()))
                 for r in found.collect())
    assert got == sorted(expected) and found.count() > 0


def test_trim_drops_one_bucket_of_a_wide_window():
    window = DriftWindow(False)
    for i in range(120):
        window.add(50.0 + i % 2, i)
    oldest = 1 << (len(window.rows) - 1)
    again = DriftWindow.load(window.dump(), False)
    call = DriftCall(again, "per_drift", resumed=True)
    call.feed([], [])
    assert again.width == 120
    call.feed([50.0], [120])
    assert again.width == 121 - oldest
