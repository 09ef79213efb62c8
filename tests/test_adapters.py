"""Adapters whose packages are missing here: only what they build is tested."""

import json

import pytest

from pulseweave.sources import avro, kafka


def test_kafka_options():
    options = kafka.kafka_options("h:9092", "records", max_offsets=500)
    assert options == {"kafka.bootstrap.servers": "h:9092", "subscribe": "records",
                       "startingOffsets": "latest", "maxOffsetsPerTrigger": "500"}


def test_avro_schemas_are_valid_json():
    for schema in (avro.SENSOR_RECORD, avro.ALERT, avro.AGGREGATED_RECORD, avro.DRIFT_ALERT,
                   avro.HUB_RECORD_BATCH):
        parsed = json.loads(schema)
        assert parsed["type"] == "record" and parsed["fields"]


def test_framing(spark):
    from pyspark.sql import functions as F

    row = spark.range(1).select(avro.framed(F.unhex(F.lit("abcd")), 258).alias("m")).select(
        "m", avro.body(F.col("m")).alias("b")).first()
    assert row.m.hex() == "0000000102abcd" and row.b.hex() == "abcd"


def test_keyed_averages_as_text_messages(spark):
    keyed = spark.sql("SELECT '[u@0/60000]' AS key, 1.25D AS value")
    back = kafka.from_text_messages(kafka.text_messages(keyed)).first()
    assert tuple(back) == ("[u@0/60000]", 1.25)


def test_text_stream(spark, small, tmp_path):
    from pulseweave.sinks.text import stream_console, stream_lines
    from pulseweave.sources.tables import EVENTS_SCHEMA
    from pulseweave.streaming.jobs import file_stream

    rows = file_stream(spark, EVENTS_SCHEMA, f"{small}/events*.parquet")
    query = (stream_lines(rows.select("event_id", "value"), str(tmp_path / "out"),
                          str(tmp_path / "check")).trigger(availableNow=True).start())
    query.awaitTermination()
    lines = spark.read.text(str(tmp_path / "out"))
    assert lines.count() == 1000
    assert lines.first().value.startswith("event_id=")
    console = stream_console(rows.filter("event_id < 3").select("event_id")).trigger(
        availableNow=True).start()
    console.awaitTermination()
    assert console.exception() is None


MOMENT = "timestamp_millis(1700000000123) AS ts"
ID = "'01234567-89ab-cdef-0123-456789abcdef'"
KINDS = {
    "sensor": (f"SELECT {ID} AS patient_id, 'u' AS unit, {MOMENT}, 1.5D AS value",
               avro.sensor_fields, avro.sensor_rows, avro.SENSOR_RECORD),
    "alert": (f"SELECT {ID} AS id, {ID} AS patient_id, {MOMENT}, 'u' AS unit, 1.5D AS value",
              avro.alert_fields, avro.alert_rows, avro.ALERT),
    "aggregate": (f"SELECT {ID} AS id, {ID} AS patient_id, {MOMENT}, 'u' AS unit, 1D AS avg_value, "
                  "2D AS min_value, 3D AS max_value", avro.aggregated_fields,
                  avro.aggregated_rows, avro.AGGREGATED_RECORD),
    "drift": (f"SELECT {ID} AS id, {ID} AS patient_id, 'u' AS unit, "
              "timestamp_millis(5) AS `from`, timestamp_millis(9) AS `to`",
              avro.drift_fields, avro.drift_rows, avro.DRIFT_ALERT),
}
WIRE = {"long": "bigint", "double": "double", "string": "string", "bytes": "binary"}


@pytest.mark.parametrize("kind", sorted(KINDS))
def test_fields_of_messages(spark, kind):
    """Wire fields have the schema's names, order and types, and read back the same."""
    from pyspark.sql import functions as F

    sql, fields, rows, schema = KINDS[kind]
    frame = spark.sql(sql)
    message = frame.select(avro.packed(fields()).alias("r"),
                           avro.bytes_from_uuid(F.col("patient_id")).alias("key"),
                           F.lit(None).cast("timestamp").alias("arrival_ts"))
    wire = [(f.name, f.dataType.simpleString()) for f in message.schema["r"].dataType]
    assert wire == [(f["name"], WIRE[f["type"]]) for f in json.loads(schema)["fields"]]
    back = rows(message).drop("arrival_ts")
    assert back.columns == frame.columns and back.collect() == frame.collect()


def test_schema_number(spark):
    from pyspark.sql import functions as F

    row = spark.range(1).select(
        avro.schema_number(avro.framed(F.unhex(F.lit("abcd")), 70_000)).alias("n"),
        avro.schema_number(F.unhex(F.lit("01000000ff"))).alias("other"),
        avro.schema_number(F.unhex(F.lit("00"))).alias("short")).first()
    assert tuple(row) == (70_000, None, None)


def test_rate_limit_is_on_by_default():
    assert kafka.kafka_options("h:9092", "records")["maxOffsetsPerTrigger"] == "500000"


def test_chain_of_jobs_over_files(spark, records, tmp_path):
    """Every job from files to files, each reading what the ones before it wrote."""
    from pyspark.sql import functions as F

    from pulseweave.dims import normal_ranges
    from pulseweave.operators import alerts as al, batches
    from pulseweave.streaming.jobs import file_stream
    from pulseweave.streaming.wiring import JOBS, run_job

    rows = [(f"00000000-0000-0000-0000-00000000000{p}", "HeartRate/Bpm", 1e6 + 7 * i + p,
             70.0 + (i * 13 + p) % 60) for p in range(3) for i in range(120)]
    frame = records(rows)
    batches.pack_batches(frame, "1 minute").write.parquet(str(tmp_path / "hub_batches"))
    schemas = {}

    def read(topic):
        path = str(tmp_path / topic)
        schema = spark.read.option("recursiveFileLookup", "true").parquet(path).schema
        return (spark.readStream.schema(schema).option("recursiveFileLookup", "true")
                .parquet(path))

    def write(stream, topic, mode):
        schemas[topic] = stream.schema

        def keep(batch, batch_id):
            batch.write.mode("overwrite").parquet(str(tmp_path / topic / f"{name}-{batch_id}"))

        return (stream.writeStream.outputMode(mode).foreachBatch(keep)
                .option("checkpointLocation", str(tmp_path / f"check-{name}"))
                .trigger(availableNow=True).start())

    for name in JOBS:  # in the order of the chain
        run_job(name, read, write).awaitTermination()
    out = lambda t: spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / t))
    assert sorted(map(tuple, out("records").select(*frame.columns).collect())) == \
        sorted(map(tuple, frame.collect()))
    assert out("alerts").count() == al.alerts(frame, normal_ranges(spark)).count() > 0
    assert set(schemas) == {j.output for j in JOBS.values()}
    assert out("aggregated_records").filter("avg_value IS NULL").count() == 0
    assert out("aggregated_records").select("id").distinct().count() == \
        out("aggregated_records").count() > 0
    assert out("global_averages").filter(F.col("value").isNull()).count() == 0
