"""Kafka streams.  Needs the Spark Kafka connector on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter


# Fixed value: what one micro-batch takes unless told otherwise; it bounds the rows
# of one key that a stateful operator holds.
MAX_OFFSETS = 500_000


def kafka_options(servers: str, topics: str, starting: str = "latest",
                  max_offsets: int | None = MAX_OFFSETS, **extra: str) -> dict[str, str]:
    """Reader options; ``max_offsets`` caps what one micro-batch takes."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topics,
               "startingOffsets": starting}
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return {**options, **extra}


def read_topic(spark: SparkSession, servers: str, topics: str, **kwargs) -> DataFrame:
    """Columns key, value and arrival_ts (the broker's time of the message)."""
    return (spark.readStream.format("kafka").options(**kafka_options(servers, topics, **kwargs))
            .load().select("key", "value", F.col("timestamp").alias("arrival_ts")))


def write_topic(messages: DataFrame, servers: str, topic: str, checkpoint: str,
                mode: str = "append") -> DataStreamWriter:
    """A writer for rows with key and value; call ``start`` on the result."""
    return (messages.select("key", "value").writeStream.format("kafka").outputMode(mode)
            .option("kafka.bootstrap.servers", servers).option("topic", topic)
            .option("checkpointLocation", checkpoint))


def text_messages(keyed: DataFrame) -> DataFrame:
    """Rows of (key text, number), such as keyed global averages, as messages."""
    return keyed.select(F.col("key").cast("string").alias("key"),
                        F.col("value").cast("string").alias("value"))


def from_text_messages(messages: DataFrame) -> DataFrame:
    return messages.select(F.col("key").cast("string").alias("key"),
                           F.col("value").cast("string").cast("double").alias("value"))
