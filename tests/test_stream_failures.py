"""A failure of a stream, or a table that lost a part of itself, is an error and no result."""

import os

import pytest
from pyspark.errors import StreamingQueryException

from pulseweave.plans import streams
from pulseweave.schemas import ALERTS
from pulseweave.sinks import table_log
from pulseweave.sinks.tables import append_table, read_stored, replace_batch

DAY = 86_400


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """An events table of thirty days, some in each time slice."""
    path = str(tmp_path_factory.mktemp("events"))
    (spark.range(240).selectExpr(
        "id AS event_id", f"timestamp_seconds(1704067200 + id * {DAY} div 8) AS ts",
        "id % 5 AS user_id", "element_at(array('click', 'view'), CAST(id % 2 AS INT) + 1)"
        " AS event_type", "CAST(id AS DOUBLE) AS value", """'{"k": 1}' AS props""")
     .coalesce(1).write.parquet(f"{path}/events.parquet"))
    return path


def failing(monkeypatch, run, batch):
    """Every ``store`` of this run of the query fails at this batch; returns the runs."""
    real, runs = streams._run, []

    def watched(rows, target, check):
        runs.append(target)

        def broken(frame, batch_id):
            if len(runs) == run and batch_id == batch:
                raise OSError("the store is out of order")
            target(frame, batch_id)

        real(rows, broken, check)

    monkeypatch.setattr(streams, "_run", watched)
    return runs


def test_resumed_has_all_windows(spark, folder):
    found = streams.stream_resumed(spark, folder).collect()
    assert len(found) == 240  # a row for each patient, unit and day
    assert len({r.id for r in found}) == 240


@pytest.mark.parametrize("run, batch", [(1, 1), (2, 2), (2, 3)])
def test_resumed_shows_other_failures(spark, folder, monkeypatch, run, batch):
    """Only the stop that the query makes itself is expected, and only in its first run."""
    runs = failing(monkeypatch, run, batch)
    with pytest.raises(StreamingQueryException, match="out of order"):
        streams.stream_resumed(spark, folder)
    assert len(runs) == run


def test_resumed_must_have_stopped(spark, folder, monkeypatch):
    """A first run that ends without its stop is not the query that was asked for."""
    monkeypatch.setattr(streams, "_run", lambda *_: None)
    with pytest.raises(RuntimeError, match="stop"):
        streams.stream_resumed(spark, folder)


@pytest.fixture
def stored(spark, records, tmp_path):
    """Alerts in three commits; (root, path of the table)."""
    root = str(tmp_path)
    for day in range(3):
        rows = records([("p", "u", day * DAY + i, 1) for i in range(10)])
        rows = rows.selectExpr("CAST(value AS STRING) AS id", "*")
        if day:
            replace_batch(rows, ALERTS, root, "w", day)
        else:
            append_table(rows, ALERTS, root)
    return root, f"{root}/alerts"


def data_files(path):
    return sorted(os.path.join(d, n) for d, _, names in os.walk(f"{path}/data") for n in names
                  if n.endswith(".parquet") and not d.endswith("_files"))


BOUNDS = [{}, {"since": "1970-01-01 00:00:00", "until": "1970-01-03 00:00:00"}]


@pytest.mark.parametrize("bounds", BOUNDS)
def test_lost_file_is_an_error(spark, stored, bounds):
    root, path = stored
    assert read_stored(spark, ALERTS, root, **bounds).count() == 30
    os.remove(data_files(path)[1])
    with pytest.raises(FileNotFoundError, match="lost"):
        read_stored(spark, ALERTS, root, **bounds)


@pytest.mark.parametrize("bounds", BOUNDS)
def test_lost_file_is_an_error_whatever_the_session_ignores(spark, stored, bounds):
    """A file that goes after the table was opened, or is broken, is not left out either."""
    root, path = stored
    names = ("spark.sql.files.ignoreMissingFiles", "spark.sql.files.ignoreCorruptFiles")
    for name in names:
        spark.conf.set(name, "true")
    try:
        found = read_stored(spark, ALERTS, root, **bounds)
        file = data_files(path)[1]
        with open(file, "wb") as out:
            out.write(b"not parquet")
        with pytest.raises(Exception, match="not a Parquet file|FAILED_READ_FILE"):
            found.count()
    finally:
        for name in names:
            spark.conf.unset(name)


def test_lost_bounds_are_an_error(spark, stored):
    """The files' own list must agree with the manifest."""
    root, path = stored
    lists = [os.path.join(d, n) for d, _, names in os.walk(f"{path}/data") for n in names
             if n.endswith(".parquet") and d.endswith("_files")]
    os.remove(lists[0])
    with pytest.raises(FileNotFoundError, match="lost"):
        read_stored(spark, ALERTS, root)


@pytest.mark.parametrize("lost", [0, 1])
def test_lost_manifest_is_an_error(spark, stored, lost):
    """The log's versions come one after the other from a base on."""
    root, path = stored
    os.remove(sorted(n.path for n in os.scandir(f"{path}/_log") if n.name[0] != ".")[lost])
    with pytest.raises(FileNotFoundError, match="log"):
        read_stored(spark, ALERTS, root)


def test_version_to_come_is_an_error(spark, stored):
    root, path = stored
    last = table_log.snapshot(spark, path).version
    assert read_stored(spark, ALERTS, root, version=last).count() == 30
    with pytest.raises(FileNotFoundError, match="version"):
        read_stored(spark, ALERTS, root, version=last + 1)
