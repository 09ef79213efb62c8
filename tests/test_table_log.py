"""The table log: what readers see while writers come, stop half-way, and compact."""

import threading

import pytest
from pyspark.sql import functions as F

from pulseweave.dims import normal_ranges
from pulseweave.operators import alerts as al
from pulseweave.schemas import ALERTS
from pulseweave.sinks import table_log
from pulseweave.sinks.tables import (append_table, compact, ranged, read_stored, replace_batch,
                                     stored_rows)

DAY = 86_400


@pytest.fixture
def day_of(spark, records):
    """Ten alerts of a day."""
    def build(day, n=10):
        rows = [(f"p{i % 3}", "HeartRate/Bpm", day * DAY + 60 * i, 10) for i in range(n)]
        return al.alerts(records(rows), normal_ranges(spark))
    return build


def count(spark, root, **bounds):
    return read_stored(spark, ALERTS, root, **bounds).count()


def test_stop_between_data_and_manifest(spark, day_of, tmp_path):
    """Rows without a manifest are never seen; the retry is; vacuum takes them away."""
    root = str(tmp_path)
    path = append_table(day_of(1), ALERTS, root)
    table_log.write_rows(stored_rows(day_of(2), ALERTS), ALERTS, path, "w", 0)
    assert count(spark, root) == 10
    replace_batch(day_of(2), ALERTS, root, "w", 0)
    assert count(spark, root) == 20
    assert table_log.vacuum(spark, path, keep_seconds=3600) == 0
    assert table_log.vacuum(spark, path, keep_seconds=-10) == 1
    assert count(spark, root) == 20


def test_snapshots_do_not_change(spark, day_of, tmp_path):
    root = str(tmp_path)
    for day in range(3):
        path = append_table(day_of(day), ALERTS, root)
    before = read_stored(spark, ALERTS, root)
    version = table_log.snapshot(spark, path).version
    replace_batch(day_of(3), ALERTS, root, "w", 0)
    assert compact(spark, ALERTS, root, "1970-01-03 12:00:00") == 3
    assert before.count() == count(spark, root, version=version) == 30
    assert count(spark, root) == 40
    assert len(table_log.snapshot(spark, path).live) == 2


def test_compaction_takes_whole_pasts_of_writers(spark, day_of, tmp_path):
    """A batch that is taken in is not added again; one that stays is still replaced."""
    root = str(tmp_path)
    for batch, day in enumerate((0, 1, 9, 2)):
        replace_batch(day_of(day), ALERTS, root, "w", batch)
    assert compact(spark, ALERTS, root, "1970-01-05 00:00:00") == 2  # not the one after day 9
    for batch, day in enumerate((0, 1, 9, 2)):
        replace_batch(day_of(day), ALERTS, root, "w", batch)
    assert count(spark, root) == 40
    rows = table_log.accepted(spark, f"{root}/alerts").collect()
    assert [(r.writer, r.batches, r.n_rows) for r in rows] == [("w", 4, 40)]


def test_two_compactions_at_once(spark, day_of, tmp_path):
    """The one that comes second finds its commits gone and leaves nothing behind."""
    root = str(tmp_path)
    for day in range(4):
        path = append_table(day_of(day), ALERTS, root)
    seen = {}

    def place_then_lose(rows, spec):
        if not seen:
            seen["first"] = True
            seen["other"] = compact(spark, ALERTS, root, "1970-01-05 00:00:00")
        return ranged(rows, spec)

    assert table_log.compact(spark, ALERTS, path, "1970-01-05 00:00:00", place_then_lose) == 0
    assert seen["other"] == 4 and count(spark, root) == 40


def test_writers_at_once(spark, day_of, tmp_path):
    """Every writer gets a version of its own, over several bases of the log."""
    root, errors = str(tmp_path), []
    path = append_table(day_of(0), ALERTS, root)
    schema = table_log.snapshot(spark, path).live.popitem()[1].schema

    def write(name):
        try:
            for batch in range(20):
                table_log.commit(spark, path, table_log.Commit(
                    f"{name}-{batch}", name, batch, schema, rows=0, new_patients=1))
        except Exception as error:  # shown by the assertion below
            errors.append(error)

    threads = [threading.Thread(target=write, args=(f"w{i}",)) for i in range(3)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert errors == []
    now = table_log.snapshot(spark, path)
    assert now.version == 60 and len(now.live) == 61
    assert {w: n for w, n in now.counts.items() if w != "append"} == {
        f"w{i}": [20, 0, 20] for i in range(3)}


def test_time_bounds_choose_files(spark, day_of, tmp_path):
    root = str(tmp_path)
    frame = day_of(0)
    for day in range(1, 6):
        frame = frame.union(day_of(day))
    append_table(frame, ALERTS, root, layout="range", tasks=4)
    append_table(day_of(2), ALERTS, root)
    part = read_stored(spark, ALERTS, root, since="1970-01-03 00:00:00",
                       until="1970-01-03 00:00:00")
    assert part.count() == 20 and len(part.inputFiles()) < len(
        read_stored(spark, ALERTS, root).inputFiles())
    assert count(spark, root, since="1971-01-01") == 0
    assert part.select(F.countDistinct("ts_day")).first()[0] == 1


def test_pinned_version(spark, day_of, tmp_path):
    root = str(tmp_path)
    path = append_table(day_of(0), ALERTS, root)
    first = table_log.pinned(spark, path, "reader", 0)
    append_table(day_of(1), ALERTS, root)
    assert table_log.pinned(spark, path, "reader", 0) == first
    assert table_log.pinned(spark, path, "reader", 1) == first + 1


def test_nothing_committed(spark, tmp_path, day_of):
    with pytest.raises(FileNotFoundError):
        read_stored(spark, ALERTS, str(tmp_path))
    append_table(day_of(0).limit(0), ALERTS, str(tmp_path))
    assert count(spark, str(tmp_path)) == 0
