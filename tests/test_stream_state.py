"""State that ages, fires timers and numbers rows, whatever the cut into micro-batches."""

import random

import pytest
from pyspark.sql import functions as F

from pulseweave.dims import credit_caps
from pulseweave.plans.slices import open_slices, slices
from pulseweave.schemas import ALERTS
from pulseweave.session import ROCKSDB_PROVIDER
from pulseweave.sinks.tables import in_chunks, read_stored, replace_chunks
from pulseweave.streaming import jobs
from pulseweave.streaming.processors import debounced, stream_expiring_sessions

DAY = 86_400
SCHEMA = "patient_id string, unit string, ts timestamp, value double"


def run(frame, tmp_path, name):
    spark, out = frame.sparkSession, []

    def keep(batch, batch_id):
        out.extend(tuple(r) for r in batch.collect())

    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    (frame.writeStream.foreachBatch(keep).option("checkpointLocation", str(tmp_path / name))
     .trigger(availableNow=True).start().awaitTermination())
    return sorted(out, key=str)


def laid(records, folder, rows, batches):
    """``rows`` (by time) in so many files, then a marker that closes everything."""
    step = -(-len(rows) // batches)
    for i in range(0, len(rows), step):
        records(rows[i:i + step]).coalesce(1).write.parquet(f"{folder}/part{i // step}")
    records([("end", "view", 4_000_000_000, 1)]).coalesce(1).write.parquet(f"{folder}/part{batches}")
    return folder


def test_expiry_does_not_depend_on_batches(spark, records, tmp_path):
    """Silence over the bound within a batch and between batches, at the bound and after it."""
    rng, rows, at = random.Random(3), [], 0
    for i in range(120):
        at += rng.choice([60, 600, 2 * DAY, 2 * DAY + 1, 5 * DAY])
        rows.append((f"p{i % 3}", "view", at, i))
    found = []
    for batches in (1, 7):
        folder = laid(records, str(tmp_path / f"in{batches}"), rows, batches)
        stream = jobs.file_stream(spark, SCHEMA, f"{folder}/part*/*.parquet", 1)
        found.append(run(stream_expiring_sessions(
            stream, credit_caps(spark, {"view": (3, 1)}), "4 days", "1 minute"), tmp_path,
            f"check{batches}"))
    assert found[0] == found[1] and len(found[0]) > 20
    lives = {(r[0], r[-1]) for r in found[0]}
    assert len(lives) > 6
    assert all(min(r[2] for r in found[0] if (r[0], r[-1]) == life) == 1 for life in lives)


def test_debounce_does_not_depend_on_batches(spark, records, tmp_path):
    # Not from time 0 on: the first watermark is there, and what is not after it is late.
    rows = [("p", "view", 1000 + t, 1) for t in (0, 5, 9, 20, 29, 100, 109, 120, 500)]
    found = []
    for batches in (1, 4):
        folder = laid(records, str(tmp_path / f"in{batches}"), rows, batches)
        stream = jobs.file_stream(spark, SCHEMA, f"{folder}/part*/*.parquet", 1)
        sent = debounced(stream, "10 seconds", "1 second", "ts").filter("patient_id = 'p'")
        found.append([(r[1].timestamp() - 1000, r[2]) for r in run(sent, tmp_path, f"c{batches}")])
    assert found[0] == found[1] == [(19.0, 3), (39.0, 2), (119.0, 2), (130.0, 1), (510.0, 1)]


@pytest.mark.parametrize("rows, size", [(0, 10), (1, 10), (10, 10), (11, 10), (1000, 7)])
def test_chunks_are_full(spark, tmp_path, rows, size):
    frame = spark.range(rows, numPartitions=5).repartition(3)
    chunks = sorted(in_chunks(frame.persist(), size).groupBy("chunk").count().collect())
    full, rest = divmod(rows, size)
    assert [tuple(c) for c in chunks] == [(i, size) for i in range(full)] + (
        [(full, rest)] if rest else [])


def test_chunks_are_files_and_are_replaced(spark, records, tmp_path):
    frame = records([("p", "u", i, 1) for i in range(95)]).withColumn("id", F.lit("x"))
    for _ in range(2):
        replace_chunks(frame.persist(), ALERTS, str(tmp_path), "w", 3, 20)
    stored = read_stored(spark, ALERTS, str(tmp_path))
    sizes = stored.groupBy("batch", "chunk").agg(
        F.count("*"), F.countDistinct(F.input_file_name())).orderBy("chunk").collect()
    assert [tuple(r) for r in sizes] == [(3, i, 20 if i < 4 else 15, 1) for i in range(5)]


def test_slices_keep_all_rows_in_equal_files(spark, records):
    rows = [("p", "u", 1_704_067_200 + i * 500, 1) for i in range(5000)]
    frame = records(rows).union(spark.sql("SELECT 'q', 'u', CAST(NULL AS TIMESTAMP), 1D"))
    path, files = slices(spark, frame, tasks=3)
    assert files > 1
    read = spark.read.parquet(path + "/part*").withColumn("f", F.input_file_name())
    assert read.count() == 5001 and read.select("f").distinct().count() == 4 * files
    assert open_slices(spark, (path, files)).isStreaming
