"""A table laid out in time slices, which a file stream reads one per micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pulseweave.plans import settings as s
from pulseweave.schemas import SENSOR_RECORD
from pulseweave.session import ROCKSDB_PROVIDER, shared_dir
from pulseweave.streaming.jobs import file_stream

#: Rows of a slice for each file, at least.
FILE_ROWS = 1000


def slices(spark: SparkSession, rows: DataFrame, marker: DataFrame | None = None,
           tasks: int = 8) -> tuple[str, int]:
    """Lay ``rows`` out for a file stream: a folder, and how many files make a slice.

    The slices come one after the other in time; rows without a time are in the first, and
    ``marker`` rows in a slice of their own at the end.  All slices have the same number of
    files, so that a micro-batch is a slice; rows are dealt evenly, in as many tasks as the
    smallest slice fills, ``tasks`` at most.
    """
    path = shared_dir(spark, "slices")
    edges = [F.lit(x).cast("timestamp") for x in s.SLICES]
    cut = [(F.col("ts") >= low) & (F.col("ts") < high) for low, high in zip(edges, edges[1:])]
    cut[0] = F.col("ts").isNull() | cut[0]
    sizes = rows.agg(*[F.count_if(c) for c in cut]).first()
    # Rows are dealt round robin, so a file stays empty only if there are very few.
    files = max(1, min(tasks, min(sizes) // FILE_ROWS))
    for i, where in enumerate(cut):
        part = rows.filter(where)
        (part.repartition(files) if files > 1 else part.coalesce(1)).write.parquet(
            f"{path}/part{i}")
    if marker is not None:
        marker.coalesce(1).write.parquet(f"{path}/part{len(cut)}")
    return path, files


def open_slices(spark: SparkSession, laid: tuple[str, int], schema: str = SENSOR_RECORD,
                parts: str = "*") -> DataFrame:
    """The slices (or those whose number matches ``parts``) as a stream."""
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKSDB_PROVIDER:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    path, files = laid
    return file_stream(spark, schema, f"{path}/part{parts}/*.parquet", files)
