"""The registered queries: operators applied to the ``events`` table.

Every query is a function of (spark, folder).  ``pulseweave.plans.checks`` holds
equivalent SQL under the same names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from pulseweave.dims import credit_caps, normal_ranges, unit_classes
from pulseweave.functions.ids import bytes_from_uuid, stable_id, uuid_from_bytes
from pulseweave.functions.times import from_millis, to_millis
from pulseweave.operators import (alerts as al, batches, credits, drift, gram_index, meters, notify,
                                  patients, reads, routing, series, sessions, windows)
from pulseweave.plans import settings as s
from pulseweave.plans.slices import open_slices, slices
from pulseweave.schemas import (AGGREGATED_RECORDS, ALERTS, DRIFT_ALERTS, GLOBAL_AVERAGES,
                                TableSpec)
from pulseweave.session import shared_dir
from pulseweave.sinks.tables import append_table, read_stored, replace_batch, stored_rows
from pulseweave.sources.dimensions import parse_ranges
from pulseweave.sources.tables import (EVENTS_SCHEMA, as_sensor_records, events, user_of,
                                       with_arrival)
from pulseweave.streaming.jobs import alert_job, file_stream, global_average_job, minute_job
from pulseweave.streaming.processors import (stream_credit_sessions as stream_credits,
                                             stream_drift as drift_stream)
from pulseweave.streaming.sinks import (fan_out, notification_target, patient_stream,
                                        table_stream, table_target)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- inputs ---------------------------------------------------------------------

def _records(spark: SparkSession, folder: str) -> DataFrame:
    return as_sensor_records(events(spark, folder))


def _arrivals(spark: SparkSession, folder: str) -> DataFrame:
    return as_sensor_records(with_arrival(events(spark, folder)), "arrival_ts")


def _one_user(spark: SparkSession, folder: str) -> DataFrame:
    """Records of the looked-up patient; the id is tested on the stored column."""
    rows = events(spark, folder)
    return as_sensor_records(rows.filter(F.col("user_id") == user_of(s.PATIENT)))


def _alerts(records: DataFrame) -> DataFrame:
    return al.alerts(records, normal_ranges(records.sparkSession, s.RANGES))


def _flagged(records: DataFrame) -> DataFrame:
    return al.with_alert_flag(records, normal_ranges(records.sparkSession, s.RANGES))


def _alert_arrivals(spark: SparkSession, folder: str) -> DataFrame:
    return al.out_of_range(_arrivals(spark, folder), normal_ranges(spark, s.RANGES))


def _daily(records: DataFrame) -> DataFrame:
    return windows.aggregated_records(windows.patient_windows(records, "1 day"), "window 1 day")


def _classes(spark: SparkSession) -> DataFrame:
    return unit_classes(spark, s.CLASSES)


def _bursts(records: DataFrame) -> DataFrame:
    """Stand-in drifts that plain SQL can produce: gap sessions of 3 or more."""
    found = sessions.gap_sessions(records, ["patient_id", "unit"], s.GAPS["short"])
    return found.filter("n_records >= 3").select(
        stable_id(F.lit("burst"), F.col("patient_id"), F.col("unit"),
                  F.unix_micros("first_ts")).alias("id"),
        "patient_id", "unit", F.col("first_ts").alias("from"), F.col("last_ts").alias("to"))


def _ms(rows: DataFrame, *names: str) -> DataFrame:
    """Moments as epoch milliseconds, the form in which results leave."""
    return rows.withColumns({n: to_millis(F.col(n)) for n in names})


def _rounded(rows: DataFrame, *names: str) -> DataFrame:
    """Sums of floats depend on their order in the last digits."""
    return rows.withColumns({n: F.round(n, 9) for n in names})


# --- alerts, routing, batches -----------------------------------------------------

@query
def alerts(spark: SparkSession, folder: str) -> DataFrame:
    return _ms(_alerts(_records(spark, folder)), "ts")


@query
def alert_flags(spark: SparkSession, folder: str) -> DataFrame:
    return _ms(_flagged(_records(spark, folder)), "ts")


@query
def range_coverage(spark: SparkSession, folder: str) -> DataFrame:
    text = spark.sql(f"SELECT '{s.RANGES_JSON}' AS value")
    return al.range_coverage(_records(spark, folder), parse_ranges(text))


@query
def threshold_filter(spark: SparkSession, folder: str) -> DataFrame:
    above = al.above_threshold(_arrivals(spark, folder), "click", 120.0)
    return _ms(meters.with_latency(above), "ts", "arrival_ts")


@query
def route_units(spark: SparkSession, folder: str) -> DataFrame:
    return _ms(routing.with_route(_records(spark, folder), _classes(spark)), "ts")


@query
def routed_other(spark: SparkSession, folder: str) -> DataFrame:
    return _ms(routing.routed(_records(spark, folder), _classes(spark), "other"), "ts")


@query
def pack_hub_records(spark: SparkSession, folder: str) -> DataFrame:
    hubs = batches.pack_hub_records(_records(spark, folder), "7 days", limit=4)
    return _ms(hubs, "tick").select(
        "patient_id", "tick", "part", F.size("Records").cast("bigint").alias("n_records"),
        F.col("Records")[0]["Timestamp"].alias("first_ms"))


@query
def pack_batches(spark: SparkSession, folder: str) -> DataFrame:
    packed = batches.pack_batches(_records(spark, folder), "1 day", batch_size=8)
    per_batch = packed.select(
        F.size("Batch").alias("hubs"),
        F.aggregate(F.transform("Batch", lambda h: F.size(h["Records"])), F.lit(0),
                    lambda a, n: a + n).alias("records"))
    return per_batch.agg(F.sum("hubs").alias("n_hubs"), F.sum("records").alias("n_records"),
                         (F.max("hubs") <= 8).alias("within_limit"))


@query
def flatten_batches(spark: SparkSession, folder: str) -> DataFrame:
    packed = batches.pack_batches(_records(spark, folder), "1 day", batch_size=8, lanes=4)
    return _ms(batches.flatten_batches(packed), "ts")


# --- windows and sessions -----------------------------------------------------------

@query
def minutely(spark: SparkSession, folder: str) -> DataFrame:
    daily = windows.patient_windows(_records(spark, folder), "1 day")
    return _ms(_rounded(daily, "avg_value"), "ts")


@query
def aggregated_records(spark: SparkSession, folder: str) -> DataFrame:
    return _ms(_rounded(_daily(_records(spark, folder)), "avg_value"), "ts")


@query
def global_averages(spark: SparkSession, folder: str) -> DataFrame:
    hourly = windows.global_averages(_records(spark, folder), "1 hour")
    return _rounded(windows.keyed_global_averages(hourly), "value")


@query
def global_averages_parse(spark: SparkSession, folder: str) -> DataFrame:
    hourly = windows.global_averages(_records(spark, folder), "1 hour")
    parsed = windows.parse_global_averages(windows.keyed_global_averages(hourly))
    return _ms(_rounded(parsed, "value"), "ts")


def _sessions_out(rows: DataFrame) -> DataFrame:
    return _ms(_rounded(rows, "avg_value"), "ts")


@query
def session_short(spark: SparkSession, folder: str) -> DataFrame:
    return _sessions_out(sessions.class_sessions(
        _records(spark, folder), _classes(spark), "short", s.GAPS))


@query
def session_long(spark: SparkSession, folder: str) -> DataFrame:
    return _sessions_out(sessions.class_sessions(
        _records(spark, folder), _classes(spark), "long", s.GAPS))


@query
def session_union(spark: SparkSession, folder: str) -> DataFrame:
    return _sessions_out(sessions.all_sessions(_records(spark, folder), _classes(spark), s.GAPS))


@query
def sessionized_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Gap sessions inside credit sessions."""
    numbered = credits.with_session_id(
        _records(spark, folder), credit_caps(spark, s.CAPS), slot="1 day")
    chosen = numbered.select("patient_id", "unit", "session_id", "ts", "value")
    return _sessions_out(sessions.all_sessions(chosen, _classes(spark), s.GAPS))


@query
def credit_sessions(spark: SparkSession, folder: str) -> DataFrame:
    found = credits.credit_sessions(_records(spark, folder), credit_caps(spark, s.CAPS),
                                    slot="1 day")
    return _ms(_rounded(found, "avg_value"), "first_ts", "last_ts")


def _credit_sessions_with_alerts(spark: SparkSession, folder: str, slot: str) -> DataFrame:
    found = credits.credit_sessions_with_alerts(
        _flagged(_records(spark, folder)), credit_caps(spark, s.CAPS), slot=slot)
    return _ms(_rounded(found, "avg_value"), "first_ts", "last_ts")


@query
def credit_sessions_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return _credit_sessions_with_alerts(spark, folder, "30 days")


@query
def credit_sessions_alerts_long(spark: SparkSession, folder: str) -> DataFrame:
    """The same over shorter slots, so that sessions span several of them."""
    return _credit_sessions_with_alerts(spark, folder, "7 days")


# --- drift --------------------------------------------------------------------------

def _per_patient(records: DataFrame) -> DataFrame:
    return records.withColumn("unit", F.lit("all"))


def _shifted(records: DataFrame) -> DataFrame:
    return _per_patient(records).withColumn(
        "value", F.when(F.col("ts") >= F.lit(s.DRIFT_FROM).cast("timestamp"),
                        F.col("value") + 200).otherwise(F.col("value")))


def _drifts(records: DataFrame, emit: str = "per_drift") -> DataFrame:
    return drift.detect_drift(_shifted(records), adaptive=F.lit(False), emit=emit)


def _drifts_out(rows: DataFrame) -> DataFrame:
    return _ms(_rounded(rows, "value", "total"), "from", "to")


@query
def drift_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return _drifts_out(_drifts(_records(spark, folder)))


@query
def drift_alerts_per_batch(spark: SparkSession, folder: str) -> DataFrame:
    return _drifts_out(_drifts(_records(spark, folder), "per_batch"))


@query
def drift_alerts_adaptive(spark: SparkSession, folder: str) -> DataFrame:
    return _drifts_out(drift.detect_drift(_per_patient(_records(spark, folder)),
                                          adaptive=F.lit(True)))


@query
def drift_alerts_sliced(spark: SparkSession, folder: str) -> DataFrame:
    """The first drift query as one job per time slice."""
    shifted = _shifted(_records(spark, folder))
    return _drifts_out(drift.detect_drift_in_slices(shifted, s.SLICES[1:-1], F.lit(False)))


# --- read queries ---------------------------------------------------------------------

def _stored(records: DataFrame, spec: TableSpec) -> DataFrame:
    return stored_rows(records, spec)


@query
def recent_patients(spark: SparkSession, folder: str) -> DataFrame:
    stored = _stored(_alerts(_records(spark, folder)), ALERTS)
    return reads.with_alerts(reads.recent_patients(stored, s.NOW, "7 days"))


def _search(spark: SparkSession, folder: str, ids: DataFrame) -> DataFrame:
    records = _records(spark, folder)
    found = reads.search_patients(ids, _stored(_daily(records), AGGREGATED_RECORDS),
                                  _stored(_alerts(records), ALERTS), s.FRAGMENT, s.NOW, "7 days")
    return reads.zero_for_none(found)


@query
def search_patients(spark: SparkSession, folder: str) -> DataFrame:
    return _search(spark, folder, patients.distinct_patients(_records(spark, folder)))


@query
def search_patients_ngram(spark: SparkSession, folder: str) -> DataFrame:
    ids = patients.distinct_patients(_records(spark, folder))
    path = gram_index.build_gram_index(ids, shared_dir(spark, "grams"))
    return gram_index.lookup(gram_index.read_gram_index(spark, path), s.FRAGMENT)


@query
def patient_ngrams(spark: SparkSession, folder: str) -> DataFrame:
    ids = patients.distinct_patients(_records(spark, folder))
    return patients.ngram_table(ids).groupBy("gram").agg(F.count("*").alias("n_patients"))


@query
def patient_records(spark: SparkSession, folder: str) -> DataFrame:
    stored = _stored(_daily(_one_user(spark, folder)), AGGREGATED_RECORDS)
    found = reads.shown(reads.patient_records(stored, s.PATIENT, s.NOW, *s.WEEK_MS))
    return _rounded(found, "avg_value")


@query
def patient_alerts(spark: SparkSession, folder: str) -> DataFrame:
    stored = _stored(_alerts(_one_user(spark, folder)), ALERTS)
    return reads.shown(reads.patient_alerts(stored, s.PATIENT, s.NOW, *s.WEEK_MS))


@query
def patient_drifts(spark: SparkSession, folder: str) -> DataFrame:
    stored = _stored(_drifts(_one_user(spark, folder)), DRIFT_ALERTS)
    return reads.shown(reads.patient_drifts(stored, s.PATIENT, s.NOW, *s.MONTH_MS))


# --- meters -------------------------------------------------------------------------

def _stats(spark: SparkSession, folder: str, size: str) -> DataFrame:
    stats = meters.latency_stats(_alert_arrivals(spark, folder), size)
    return _ms(_rounded(stats, "avg_latency"), "window_start")


@query
def latency_stats_short(spark: SparkSession, folder: str) -> DataFrame:
    return _stats(spark, folder, "1 day")


@query
def latency_stats_long(spark: SparkSession, folder: str) -> DataFrame:
    return _stats(spark, folder, "15 days")


@query
def latency_per_second(spark: SparkSession, folder: str) -> DataFrame:
    return _ms(meters.latency_per_window(_arrivals(spark, folder), "1 hour"), "window_start")


@query
def batch_earliest(spark: SparkSession, folder: str) -> DataFrame:
    return _ms(meters.earliest_per_window(_arrivals(spark, folder), "1 hour"),
               "window_start", "ts")


@query
def worst_latency(spark: SparkSession, folder: str) -> DataFrame:
    return _ms(meters.worst_per_window(_arrivals(spark, folder), "1 hour"),
               "window_start", "ts")


@query
def throughput_records(spark: SparkSession, folder: str) -> DataFrame:
    return _ms(meters.record_throughput(_arrivals(spark, folder), "1 hour"),
               "window_start", "latest_ts")


@query
def throughput_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return _ms(meters.alert_throughput(_alert_arrivals(spark, folder), "1 hour"),
               "window_start", "latest_ts")


@query
def period_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _ms(meters.period_counts(_arrivals(spark, folder), "1 hour"), "window_start")


# --- notifications and patients ---------------------------------------------------------

def _subscribers(records: DataFrame) -> DataFrame:
    """Someone listens to the patients who ever had a very high alert."""
    return patients.distinct_patients(_alerts(records).filter(F.col("value") > s.WATCHED_ABOVE))


@query
def notify_alerts(spark: SparkSession, folder: str) -> DataFrame:
    records = _records(spark, folder)
    return _ms(notify.alert_events(_alerts(records), _subscribers(records)), "ts")


@query
def notify_debounced(spark: SparkSession, folder: str) -> DataFrame:
    sent = notify.record_events(_arrivals(spark, folder), _subscribers(_records(spark, folder)),
                                s.QUIET_SECONDS)
    return _ms(sent, "sent_ts")


@query
def notify_totals(spark: SparkSession, folder: str) -> DataFrame:
    sent = notify.record_events(_arrivals(spark, folder), _subscribers(_records(spark, folder)),
                                s.QUIET_SECONDS)
    return _ms(notify.sent_per_period(sent, "1 day"), "window_start")


@query
def new_patients(spark: SparkSession, folder: str) -> DataFrame:
    """Patients who are not among those of the first day."""
    records = _records(spark, folder)
    known = records.filter(F.col("ts") < F.lit(s.FIRST_DAY_ENDS).cast("timestamp"))
    return patients.new_patients(records, patients.distinct_patients(known))


# --- display ------------------------------------------------------------------------

@query
def dedup_records(spark: SparkSession, folder: str) -> DataFrame:
    records = _records(spark, folder)
    first = records.filter(F.col("ts") < F.lit("2024-01-20").cast("timestamp"))
    second = records.filter(F.col("ts") >= F.lit("2024-01-10").cast("timestamp"))
    return _ms(series.dedup_points(first.unionByName(second)), "ts")


@query
def dedup_drifts(spark: SparkSession, folder: str) -> DataFrame:
    bursts = _bursts(_records(spark, folder))
    return _ms(series.dedup_by_id(bursts.unionByName(bursts)), "from", "to")


@query
def chart_series(spark: SparkSession, folder: str) -> DataFrame:
    records = _records(spark, folder)
    lines = series.chart_series(_daily(records), _alerts(records), _bursts(records))
    return _rounded(_ms(series.in_chart_order(lines), "ts"), "y")


@query
def chart_floor(spark: SparkSession, folder: str) -> DataFrame:
    return series.chart_floor(_daily(_records(spark, folder)))


@query
def drift_overlay(spark: SparkSession, folder: str) -> DataFrame:
    records = _records(spark, folder)
    return _ms(series.drift_overlay(records, _bursts(records), "6 hours"), "ts", "from", "to")


@query
def incremental_read(spark: SparkSession, folder: str) -> DataFrame:
    records = _records(spark, folder)
    seen = records.filter(F.col("ts") < F.lit(s.HALF).cast("timestamp"))
    return _ms(series.since_latest(records, seen), "ts")


# --- conversions and storage --------------------------------------------------------------

@query
def incremental_first_read(spark: SparkSession, folder: str) -> DataFrame:
    """Nothing seen yet: the default range before now."""
    records = _records(spark, folder)
    return _ms(series.since_latest(records, records.limit(0), s.NOW, "7 days"), "ts")


@query
def uuid_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    records = _records(spark, folder)
    raw = records.select(bytes_from_uuid(F.col("patient_id")).alias("raw"),
                         to_millis(F.col("ts")).alias("ms"))
    return raw.select(uuid_from_bytes(F.col("raw")).alias("patient_id"),
                      F.length("raw").cast("bigint").alias("n_bytes"),
                      to_millis(from_millis(F.col("ms"))).alias("ms"))


@query
def table_sink_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Write the stored tables to the shared folder and count them by partition."""
    records = _records(spark, folder)
    root = shared_dir(spark, "tables")
    kinds = [
        (AGGREGATED_RECORDS, _daily(records)),
        (ALERTS, _alerts(records)),
        (DRIFT_ALERTS, _bursts(records)),
        (GLOBAL_AVERAGES, windows.global_averages(records, "1 hour")),
    ]
    counts = None
    for spec, rows in kinds:
        append_table(rows, spec, root)
        stored = read_stored(spark, spec, root)
        one = stored.groupBy(F.col(spec.partition).alias("part")).agg(
            F.count("*").alias("n_rows"), F.min(spec.time).alias("first_ts"))
        one = _ms(one.select(F.lit(spec.name).alias("table_name"), "part", "n_rows", "first_ts"),
                  "part", "first_ts")
        counts = one if counts is None else counts.unionByName(one)
    return counts


@query
def table_mixed_writers(spark: SparkSession, folder: str) -> DataFrame:
    """An append, a batch that is written twice and a stream, all in one table."""
    rows = _alerts(_records(spark, folder))
    root = shared_dir(spark, "mixed")
    append_table(rows, ALERTS, root)
    for _ in range(2):
        replace_batch(rows, ALERTS, root, "batch", 1)
    incoming = as_sensor_records(file_stream(spark, EVENTS_SCHEMA, f"{folder}/event[s].parquet"))
    run = table_stream(al.alerts(incoming, normal_ranges(spark, s.RANGES)), ALERTS, root,
                       shared_dir(spark, "checkpoint"), {"availableNow": True})
    run.awaitTermination()
    stored = read_stored(spark, ALERTS, root)
    return _ms(stored.groupBy("id", "ts", "patient_id", "u", "v")
               .agg(F.count("*").alias("n")), "ts")


# --- the settings of production streams ---------------------------------------------------

@query
def minutely_1m(spark: SparkSession, folder: str) -> DataFrame:
    return _ms(_rounded(windows.patient_windows(_records(spark, folder)), "avg_value"), "ts")


@query
def global_averages_1m(spark: SparkSession, folder: str) -> DataFrame:
    found = windows.global_averages(_records(spark, folder))
    return _ms(_rounded(found.drop("end_ts"), "value"), "ts")


@query
def sessions_40s_70s(spark: SparkSession, folder: str) -> DataFrame:
    return _sessions_out(sessions.all_sessions(_records(spark, folder), _classes(spark)))


@query
def latency_1s(spark: SparkSession, folder: str) -> DataFrame:
    return _ms(meters.latency_per_window(_arrivals(spark, folder), "1 second"), "window_start")


@query
def throughput_5s(spark: SparkSession, folder: str) -> DataFrame:
    return _ms(meters.record_throughput(_arrivals(spark, folder), "5 seconds"),
               "window_start", "latest_ts")


# --- streams --------------------------------------------------------------------------
#
# The events are laid out in time slices, which a file stream then reads one per
# micro-batch until they are used up; each query returns what its stream stored.

def _slices(spark: SparkSession, folder: str) -> tuple[str, int]:
    return slices(spark, _records(spark, folder))


def _stored_stream(spark: SparkSession, rows: DataFrame, spec: TableSpec,
                   mode: str = "append") -> DataFrame:
    root = shared_dir(spark, "stream")
    run = fan_out(rows, {"table": table_target(spec, root, "stream")}, {},
                  shared_dir(spark, "checkpoint"), mode=mode)
    run.awaitTermination()
    return read_stored(spark, spec, root)


def _kept_stream(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """What an update-mode stream emits, batch by batch."""
    root = shared_dir(spark, "stream")

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")

    run = fan_out(rows, {"files": keep}, {}, shared_dir(spark, "checkpoint"), mode="update")
    run.awaitTermination()
    return spark.read.parquet(root).drop("batch_id")


@query
def stream_alerts(spark: SparkSession, folder: str) -> DataFrame:
    incoming = open_slices(spark, _slices(spark, folder))
    found = _stored_stream(spark, alert_job(incoming, normal_ranges(spark, s.RANGES)), ALERTS)
    return _ms(found.drop(ALERTS.partition), "ts")


@query
def stream_minutely(spark: SparkSession, folder: str) -> DataFrame:
    incoming = open_slices(spark, _slices(spark, folder))
    found = _stored_stream(spark, minute_job(incoming, "1 day"), AGGREGATED_RECORDS)
    return _ms(_rounded(found.drop(AGGREGATED_RECORDS.partition), "avg_v"), "ts")


@query
def stream_global_averages(spark: SparkSession, folder: str) -> DataFrame:
    incoming = open_slices(spark, _slices(spark, folder))
    found = _stored_stream(spark, global_average_job(incoming, "1 hour"), GLOBAL_AVERAGES)
    return _ms(_rounded(found.select(F.col("u").alias("unit"), "ts", F.col("v").alias("value")),
                        "value"), "ts")


@query
def stream_credit_sessions(spark: SparkSession, folder: str) -> DataFrame:
    """Records and their alerts as two streams."""
    path = _slices(spark, folder)
    ranges = normal_ranges(spark, s.RANGES)
    raised = al.out_of_range(open_slices(spark, path), ranges)
    found = _kept_stream(spark, stream_credits(open_slices(spark, path), credit_caps(spark, s.CAPS),
                                               raised))
    return _ms(_rounded(found, "avg_value"), "first_ts", "last_ts")


@query
def stream_drift(spark: SparkSession, folder: str) -> DataFrame:
    incoming = _per_patient(open_slices(spark, _slices(spark, folder)))
    return _drifts_out(_kept_stream(spark, drift_stream(incoming, F.lit(True), "per_drift")))


@query
def stream_new_patients(spark: SparkSession, folder: str) -> DataFrame:
    root = shared_dir(spark, "ids")
    run = patient_stream(open_slices(spark, _slices(spark, folder)), root,
                         shared_dir(spark, "checkpoint"), trigger={"availableNow": True})
    run.awaitTermination()
    return spark.read.parquet(f"{root}/patient_ids")


@query
def stream_fan_out(spark: SparkSession, folder: str) -> DataFrame:
    """Alerts to a table, the patients' table and notifications; one target is off."""
    root = shared_dir(spark, "fan-out")
    watched = _subscribers(_records(spark, folder))

    def send(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{root}/sent/batch_id={batch_id}")

    targets = {
        "table": table_target(ALERTS, root, "alerts", patients=True),
        "push": notification_target(notify.alert_events, lambda _: watched, send),
        "off": table_target(ALERTS, root, "off"),
    }
    incoming = open_slices(spark, _slices(spark, folder))
    run = fan_out(alert_job(incoming, normal_ranges(spark, s.RANGES)), targets, {"off": False},
                  shared_dir(spark, "checkpoint"))
    run.awaitTermination()
    counts = [read_stored(spark, ALERTS, root), spark.read.parquet(f"{root}/patient_ids"),
              spark.read.parquet(f"{root}/sent")]
    names = ["n_alerts", "n_patients", "n_sent"]
    parts = [c.agg(F.count("*").alias(n)) for c, n in zip(counts, names)]
    return parts[0].select(parts[0].n_alerts, parts[1].scalar().alias("n_patients"),
                           parts[2].scalar().alias("n_sent"))
