"""Packing sensor records into hub batches and flattening them again."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from pulseweave.functions.ids import bytes_from_uuid, uuid_from_bytes
from pulseweave.functions.times import from_millis, slot_start, to_millis

# Ticks of a patient's hub, and the most records it sends at once.
HUB_TICK = "500 milliseconds"
HUB_LIMIT = 20


#: Batches that one lane of a tick fills.
LANE_BATCHES = 10


def flatten_batches(batches: DataFrame) -> DataFrame:
    """Batch -> hub record -> sensor record, keyed by patient.  No shuffle."""
    hubs = batches.select(F.explode("Batch").alias("hub"))
    records = hubs.select("hub.PatientId", F.explode("hub.Records").alias("r"))
    return records.select(
        uuid_from_bytes(F.col("PatientId")).alias("patient_id"),
        F.col("r.Unit").alias("unit"),
        from_millis(F.col("r.Timestamp")).alias("ts"),
        F.col("r.Value").alias("value"),
    )


def pack_hub_records(records: DataFrame, tick: str = HUB_TICK,
                     limit: int = HUB_LIMIT) -> DataFrame:
    """One row per patient, tick and at most ``limit`` records.

    On a stream a tick is one row whatever its size, since numbering rows is
    not available there; on a table a fuller tick becomes several rows, so no
    array outgrows ``limit``.
    """
    wire = records.select(
        "patient_id",
        slot_start(F.col("ts"), tick).alias("tick_us"),
        to_millis(F.col("ts")).alias("Timestamp"),
        F.col("value").alias("Value"),
        F.col("unit").alias("Unit"),
        *(["ts"] if records.isStreaming else []),
    )
    record = F.struct("Timestamp", "Value", "Unit")
    if records.isStreaming:
        return (wire.groupBy("patient_id", F.window("ts", tick).alias("w"))
                .agg(F.sort_array(F.collect_list(record)).alias("Records"))
                .select("patient_id", F.col("w.start").alias("tick"),
                        F.lit(0).alias("part"), "Records"))
    order = W.partitionBy("patient_id", "tick_us").orderBy("Timestamp", "Unit", "Value")
    numbered = wire.withColumn(
        "part", F.floor((F.row_number().over(order) - 1) / limit).cast("int"))
    # Same clustering as the window above, so this adds no exchange.
    return (numbered.groupBy("patient_id", "tick_us", "part")
            .agg(F.sort_array(F.collect_list(record)).alias("Records"))
            .select("patient_id", F.timestamp_micros("tick_us").alias("tick"),
                    "part", "Records"))


def pack_batches(records: DataFrame, tick: str = HUB_TICK, limit: int = HUB_LIMIT,
                 batch_size: int = 100, lanes: int | None = None) -> DataFrame:
    """Hub records of a table collected into wire batches of at most ``batch_size``.

    Batches form per tick and lane; a lane is a hash of the patient.  Unless
    ``lanes`` is given, a tick has one lane for every ``LANE_BATCHES`` batches that its
    hubs fill, so a tick in which every patient reports spreads over as many tasks as
    it needs.
    """
    if records.isStreaming:
        raise ValueError("hubs of a tick cannot be numbered on a stream; pack its stored records")
    hubs = pack_hub_records(records, tick, limit).select(
        "tick", F.xxhash64("patient_id", "part").alias("spread"),
        F.struct(bytes_from_uuid(F.col("patient_id")).alias("PatientId"),
                 F.col("Records")).alias("hub"),
    )
    if lanes is None:
        # One row per tick; records are counted per patient before the shuffle.
        sizes = (records.groupBy(slot_start(F.col("ts"), tick).alias("tick_us"), "patient_id")
                 .agg(F.ceil(F.count("*") / limit).alias("hubs"))
                 .groupBy(F.timestamp_micros("tick_us").alias("tick"))
                 .agg(F.ceil(F.sum("hubs") / (batch_size * LANE_BATCHES)).alias("lanes")))
        hubs = hubs.join(sizes, "tick")
    else:
        hubs = hubs.withColumn("lanes", F.lit(lanes).cast("bigint"))
    hubs = hubs.select("tick", F.pmod("spread", "lanes").alias("lane"), "hub")
    order = W.partitionBy("tick", "lane").orderBy("hub.PatientId")
    return (hubs.withColumn("chunk", F.floor((F.row_number().over(order) - 1) / batch_size))
            .groupBy("tick", "lane", "chunk")
            .agg(F.collect_list("hub").alias("Batch"))
            .select("Batch"))
