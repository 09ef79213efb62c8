"""Text and console output."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter


def as_lines(rows: DataFrame) -> DataFrame:
    """One line per row: ``name=value, name=value``."""
    parts = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("null")))
             for c in rows.columns]
    return rows.select(F.concat_ws(", ", *parts).alias("value"))


def write_lines(rows: DataFrame, path: str) -> None:
    as_lines(rows).write.mode("append").text(path)


def stream_lines(rows: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    return (as_lines(rows).writeStream.format("text").option("path", path)
            .option("checkpointLocation", checkpoint))


def stream_console(rows: DataFrame, mode: str = "append") -> DataStreamWriter:
    return rows.writeStream.format("console").option("truncate", "false").outputMode(mode)
