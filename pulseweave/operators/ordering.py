"""Positions within long series, without gathering a series in one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W, functions as F

from pulseweave.functions.times import slot_start


def with_position(records: DataFrame, keys: list[str], slot: str = "1 hour",
                  tie_break: tuple[str, ...] = ("value",)) -> DataFrame:
    """Add ``position``, 1, 2, ... by time within the keys.

    Rows are numbered inside (key, time slot) and each slot starts after the
    rows of the key's earlier slots.  The records are shuffled once, by key
    *and* slot, so one busy key spreads over as many tasks as it has slots;
    only one count per slot is ever ordered per key.
    """
    slotted = records.withColumn("slot", slot_start(F.col("ts"), slot))
    by_slot = W.partitionBy(*keys).orderBy("slot")
    starts = (slotted.groupBy(*keys, "slot").agg(F.count("*").alias("n"))
              .withColumn("earlier", F.coalesce(
                  F.sum("n").over(by_slot.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
              .drop("n"))
    in_slot = W.partitionBy(*keys, "slot").orderBy("ts", *tie_break)
    return (slotted.withColumn("in_slot", F.row_number().over(in_slot))
            .join(starts, [*keys, "slot"])
            .withColumn("position", F.col("in_slot") + F.col("earlier"))
            .drop("slot", "in_slot", "earlier"))


def runs(batch: pa.RecordBatch, columns: list[str]) -> Iterator[tuple[int, int]]:
    """Start and end of each run of equal keys in a sorted Arrow batch."""
    n = batch.num_rows
    change = np.zeros(n, dtype=bool)
    for name in columns:
        column = batch.column(name)
        change[1:] |= pc.not_equal(column.slice(1), column.slice(0, n - 1)).to_numpy(
            zero_copy_only=False)
    starts = [0, *np.flatnonzero(change).tolist(), n]
    return zip(starts[:-1], starts[1:])


def key_at(batch: pa.RecordBatch, columns: list[str], row: int) -> tuple:
    return tuple(batch.column(name)[row].as_py() for name in columns)


def values_of(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(column, type=field.type) for column, field in zip(columns, schema)],
        schema=schema)
