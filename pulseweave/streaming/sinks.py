"""Writing streams to tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from pulseweave.operators.patients import distinct_patients
from pulseweave.schemas import TableSpec
from pulseweave.sinks import table_log
from pulseweave.sinks.tables import (add_new_patients, read_stored, replace_batch,
                                     replace_chunks)

Target = Callable[[DataFrame, int], None]


@dataclass
class Accepted:
    """How many rows a sink's batches held, and how many patients were new.

    Running totals; a batch that is tried again is not counted again.
    """

    rows: int = 0
    new_patients: int = 0
    batches: int = 0
    last_batch: int = -1

    def add(self, batch_id: int, rows: int) -> None:
        if batch_id > self.last_batch:
            self.rows += rows
            self.batches += 1
            self.last_batch = batch_id


def table_stream(records: DataFrame, spec: TableSpec, root: str, checkpoint: str,
                 trigger: dict | None = None, writer: str | None = None) -> StreamingQuery:
    """Append to a partitioned table; a batch that is tried again replaces itself.

    ``writer`` names the query in the table and has to stay the same over
    restarts; by default it follows from the checkpoint's place.
    """
    name = writer or f"stream-{hashlib.md5(checkpoint.encode()).hexdigest()[:12]}"
    return fan_out(records, {"table": table_target(spec, root, name)}, {}, checkpoint,
                   trigger or {"processingTime": spec.trigger})


def table_target(spec: TableSpec, root: str, writer: str, patients: bool = False,
                 accepted: Accepted | None = None) -> Target:
    """A target that stores each micro-batch once, however often it is tried.

    The table's log keeps how many rows and new patients each batch brought
    (``table_log.accepted``), also over restarts; ``accepted`` counts this process's own."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.count()
        if rows:
            added = add_new_patients(batch, root) if patients else 0
            replace_batch(batch, spec, root, writer, batch_id, added)
            if accepted is not None:
                accepted.new_patients += added
        if accepted is not None:
            accepted.add(batch_id, rows)

    write.reads_again = True  # type: ignore[attr-defined]
    return write


def patient_stream(records: DataFrame, root: str, checkpoint: str,
                   accepted: Accepted | None = None,
                   trigger: dict | None = None) -> StreamingQuery:
    """Keep the ``patient_ids`` table up to date from a stream.

    State remembers the ids this query has seen, so the table is consulted only
    for ids that are new to the query, which is rare once it has run for a while.
    """
    def add(batch: DataFrame, batch_id: int) -> None:
        added = add_new_patients(batch, root)
        if accepted is not None:
            accepted.new_patients += added

    return (distinct_patients(records).writeStream.outputMode("append").foreachBatch(add)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "2 seconds"})).start())


def chunk_target(spec: TableSpec, root: str, writer: str, size: int) -> Target:
    """A target that stores each micro-batch in chunks of ``size`` rows: the trigger bounds
    how long rows wait, the size how many go into one write."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            replace_chunks(batch, spec, root, writer, batch_id, size)

    write.reads_again = True  # type: ignore[attr-defined]
    return write


def notification_target(make: Callable[[DataFrame, DataFrame], DataFrame],
                        subscriptions: Callable[..., DataFrame],
                        write: Callable[[DataFrame, int], None],
                        per_batch: bool = False) -> Target:
    """Notifications of a micro-batch for whoever is subscribed at that time.

    ``subscriptions`` is called, and so read again, for every micro-batch; with ``per_batch``
    it is given the batch id too, so that a batch that is tried again finds the same set
    (see ``subscribed_at``).
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        now = (subscriptions(batch.sparkSession, batch_id) if per_batch
               else subscriptions(batch.sparkSession))
        write(make(batch, now), batch_id)

    return run


def subscribed_at(spec: TableSpec, root: str, reader: str
                  ) -> Callable[[SparkSession, int], DataFrame]:
    """Subscriptions from a stored table, polled at each micro-batch: the newest snapshot the
    first time, and the same one whenever the batch is tried again."""

    def read(spark: SparkSession, batch_id: int) -> DataFrame:
        version = table_log.pinned(spark, table_log.table_path(spec, root), reader, batch_id)
        return read_stored(spark, spec, root, version).select("patient_id").distinct()

    return read


def fan_out(records: DataFrame, targets: dict[str, Target], enabled: dict[str, bool],
            checkpoint: str, trigger: dict | None = None,
            mode: str = "append") -> StreamingQuery:
    """Give each micro-batch to every enabled target.

    The batch is cached while it is read more than once, so the stream is computed
    once per batch.
    """
    active = [t for name, t in targets.items() if enabled.get(name, True)]
    keep = len(active) > 1 or any(getattr(t, "reads_again", False) for t in active)

    def run(batch: DataFrame, batch_id: int) -> None:
        if keep:
            batch = batch.persist()
        try:
            for target in active:
                target(batch, batch_id)
        finally:
            if keep:
                batch.unpersist()

    writer: DataStreamWriter = (records.writeStream.outputMode(mode).foreachBatch(run)
                                .option("checkpointLocation", checkpoint))
    return writer.trigger(**(trigger or {"availableNow": True})).start()
