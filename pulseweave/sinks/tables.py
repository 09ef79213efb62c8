"""Time-partitioned tables.

Appends, replaced micro-batches, streams and compaction may go to one table at the same
time: each is a commit of the table's log (``table_log``), every reader sees a
snapshot of all commits, and a batch that is written again replaces itself and nothing
else.  Rows keep their time partition as a column; files hold narrow ranges of it, and a
time-bounded read opens the files that can have rows in its bounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pulseweave.operators.patients import distinct_patients, new_patients
from pulseweave.schemas import TableSpec
from pulseweave.sinks import table_log
from pulseweave.sinks.table_log import APPEND, table_path


def stored_rows(records: DataFrame, spec: TableSpec) -> DataFrame:
    """Record columns under their stored names, plus the partition column."""
    renamed = records.select(*[F.col(c).alias(s) for c, s in spec.columns.items()])
    return renamed.withColumn(spec.partition, F.date_trunc(spec.grain, spec.time))


def rebalanced(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows of one partition in few files, sorted by patient or unit.

    ``rebalance`` keeps a partition together for as long as it fits in one task
    and lets the adaptive planner split the ones that do not, so neither a busy
    hour nor a busy patient ends up in one task.  The input is computed once.
    """
    return (rows.hint("rebalance", spec.partition)
            .sortWithinPartitions(spec.partition, spec.cluster, spec.time))


def ranged(rows: DataFrame, spec: TableSpec, tasks: int | None = None) -> DataFrame:
    """Rows in equal ranges of (partition, patient or unit, time).

    Bounds come from a sample, so a busy hour or patient is cut into as many
    ranges as its share of the rows calls for, and every file covers a narrow
    range of patients.  Sampling computes the input a second time.
    """
    order = (spec.partition, spec.cluster, spec.time)
    if tasks is None:
        tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order)


def _placed(rows: DataFrame, spec: TableSpec, layout: str = "rebalance",
            tasks: int | None = None) -> DataFrame:
    return ranged(rows, spec, tasks) if layout == "range" else rebalanced(rows, spec)


def append_table(records: DataFrame, spec: TableSpec, root: str, layout: str = "rebalance",
                 tasks: int | None = None) -> str:
    """Append a table of records; returns where.

    ``layout="range"`` makes files of narrow patient ranges, for inputs that are
    cheap to compute twice.
    """
    path = table_path(spec, root)
    table_log.append(_placed(stored_rows(records, spec), spec, layout, tasks), spec, path,
                     "append", APPEND)
    return path


def replace_batch(records: DataFrame, spec: TableSpec, root: str, writer: str,
                  batch_id: int, added_patients: int = 0) -> str:
    """Write one micro-batch; writing it again replaces it.

    A retry after a failure leaves neither gaps nor copies.  ``writer`` names the query;
    keep it with the query's checkpoint.
    """
    path = table_path(spec, root)
    table_log.append(_placed(stored_rows(records, spec), spec), spec, path, writer, batch_id,
                     added_patients)
    return path


def in_chunks(rows: DataFrame, size: int) -> DataFrame:
    """Add ``chunk``, 0, 1, ...: chunks of exactly ``size`` rows, the last one of what is left.

    Rows are numbered within their partition and partitions begin after the rows of earlier
    ones; only one count per partition is ordered.  The rows must come in the same
    partitions each time they are computed: pass a persisted or stored frame.
    """
    low_bits = 33  # of monotonically_increasing_id: the row number within a partition
    numbered = rows.withColumn("_at", F.monotonically_increasing_id())
    part, row = F.shiftright("_at", low_bits), F.col("_at").bitwiseAND((1 << low_bits) - 1)
    numbered = numbered.withColumn("_part", part)
    starts = (numbered.groupBy("_part").agg(F.count("*").alias("_n"))
              .selectExpr("_part", "sum(_n) OVER (ORDER BY _part) - _n AS _start"))
    place = row + F.col("_start")
    return (numbered.join(starts, "_part")
            .withColumn("chunk", F.floor(place / size)).drop("_at", "_part", "_start"))


def replace_chunks(records: DataFrame, spec: TableSpec, root: str, writer: str, batch_id: int,
                   size: int) -> str:
    """Write one micro-batch as chunks of ``size`` rows, one file each; writing it again
    replaces them.  The stored rows keep their ``batch`` and ``chunk``."""
    path = table_path(spec, root)
    chunks = in_chunks(stored_rows(records, spec), size).withColumn("batch", F.lit(batch_id))
    count = -(-records.count() // size)
    placed = chunks.repartitionByRange(max(1, count), "chunk").sortWithinPartitions("chunk")
    table_log.append(placed, spec, path, writer, batch_id, maxRecordsPerFile=size)
    return path


def read_stored(spark: SparkSession, spec: TableSpec, root: str, version: int | None = None,
                since: str | None = None, until: str | None = None) -> DataFrame:
    """The rows of a table, whoever wrote them; ``since`` and ``until`` bound the time
    partition and choose the files.  What is there is all that was committed up to the
    version: a lost manifest or file, or a version to come, raises FileNotFoundError."""
    return table_log.read(spark, spec, table_path(spec, root), version, since, until)


def compact(spark: SparkSession, spec: TableSpec, root: str, before: str) -> int:
    """Rewrite the commits that lie before ``before`` ('yyyy-MM-dd HH:mm:ss') as one, in
    files of narrow ranges; returns how many they were."""
    return table_log.compact(spark, spec, table_path(spec, root), before, ranged)


def add_new_patients(records: DataFrame, root: str) -> int:
    """Append ids that the ``patient_ids`` table lacks; returns how many.

    One writer at a time: run it from a single query.  Run again on the same
    records it adds nothing.  The table is only read when there are records.
    """
    spark = records.sparkSession
    path = f"{root.rstrip('/')}/patient_ids"
    ids = distinct_patients(records).persist()
    try:
        if ids.isEmpty():
            return 0
        files = table_log.Files(spark, path)
        found = ids
        if files.fs.exists(files.path(path)):
            found = new_patients(ids, spark.read.schema("patient_id string").parquet(path))
        found = found.persist()
        try:
            added = found.count()
            if added:
                found.write.mode("append").parquet(path)
            return added
        finally:
            found.unpersist()
    finally:
        ids.unpersist()
