"""Latency and throughput meters.

``arrival_ts`` is when a record was seen (for a stream: the broker's time, or
the time of ingest); latency is arrival minus the record's own time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from pulseweave.functions.times import latency_ms, micros

ARRIVAL = "arrival_ts"
LATENCY = "latency_ms"
# Reported percentiles.
PERCENTILES = (20, 50, 80)
# Latencies are counted in groups of this many milliseconds first.
COARSE_MS = 1000


def with_latency(records: DataFrame) -> DataFrame:
    return records.withColumn(LATENCY, latency_ms(F.col(ARRIVAL), F.col("ts")))


def _arrival_window(size: str) -> Column:
    return F.window(ARRIVAL, size).alias("w")


def latency_per_window(records: DataFrame, size: str = "1 second") -> DataFrame:
    """Worst latency, not below 0, and number of records per arrival window."""
    return (with_latency(records).groupBy(_arrival_window(size))
            .agg(F.greatest(F.lit(0).cast("bigint"), F.max(LATENCY)).alias("max_latency"),
                 F.count("*").alias("n_records"))
            .select(F.col("w.start").alias("window_start"), "max_latency", "n_records"))


def earliest_per_window(records: DataFrame, size: str = "1 second",
                        tie_break: Sequence[str] = ("patient_id", "unit")) -> DataFrame:
    """The oldest record of each arrival window and how late it was."""
    row = F.struct("ts", *tie_break, LATENCY)
    return (with_latency(records).groupBy(_arrival_window(size))
            .agg(F.min(row).alias("first"))
            .select(F.col("w.start").alias("window_start"), "first.*"))


def worst_per_window(records: DataFrame, size: str = "1 second",
                     tie_break: Sequence[str] = ("patient_id", "unit")) -> DataFrame:
    """The record with the highest latency of each arrival window."""
    row = F.struct(LATENCY, "ts", *tie_break)
    return (with_latency(records).groupBy(_arrival_window(size))
            .agg(F.max(row).alias("worst"))
            .select(F.col("w.start").alias("window_start"), "worst.*"))


def latency_stats(records: DataFrame, size: str = "1 minute",
                  percentiles: Sequence[int] = PERCENTILES) -> DataFrame:
    """max, min, mean and exact nearest-rank percentiles per arrival window.

    Records without a latency (no moment or no arrival) are left out everywhere.
    """
    records = records.filter(F.col("ts").isNotNull() & F.col("arrival_ts").isNotNull())
    if records.isStreaming:
        return _latency_stats_of_stream(with_latency(records), size, percentiles)
    return _latency_stats_of_table(with_latency(records), size, percentiles)


def _latency_stats_of_stream(records: DataFrame, size: str,
                             percentiles: Sequence[int]) -> DataFrame:
    """Two aggregations in one query: counts per window and latency, whose state is one number
    each, and then, of closed windows only, everything else from the counts.  A window's
    second step holds its distinct latencies, never its records."""
    counts = records.groupBy(_arrival_window(size), LATENCY).agg(F.count("*").alias("n"))
    rows = F.array_sort(F.collect_list(F.struct(LATENCY, "n")))
    closed = counts.groupBy(F.window(F.window_time("w"), size).alias("v")).agg(
        F.max(LATENCY).alias("max_latency"), F.min(LATENCY).alias("min_latency"),
        F.sum("n").alias("n_records"), F.sum(F.col(LATENCY) * F.col("n")).alias("total"),
        rows.alias("rows"))

    def at_rank(percentile: int) -> Column:
        rank = F.floor((F.lit(percentile) * F.col("n_records") + 99) / 100)
        start = F.struct(F.lit(0).cast("bigint").alias("seen"),
                         F.lit(None).cast("bigint").alias("value"))
        found = F.aggregate("rows", start, lambda acc, row: F.struct(
            (acc["seen"] + row["n"]).alias("seen"),
            F.when(acc["value"].isNull() & (acc["seen"] + row["n"] >= rank), row[LATENCY])
            .otherwise(acc["value"]).alias("value")))
        return found["value"].alias(f"p{percentile}")

    return closed.select(
        F.col("v.start").alias("window_start"), "max_latency", "min_latency",
        (F.col("total") / F.col("n_records")).alias("avg_latency"), "n_records",
        *[at_rank(p) for p in percentiles])


def _latency_stats_of_table(records: DataFrame, size: str, percentiles: Sequence[int]) -> DataFrame:
    """Exact percentiles without sorting a window's records in one task.

    Records become counts per (window, latency) by map-side aggregation.  Counts
    of coarse latency groups locate, for each percentile, the one group that
    holds it; only that group's counts are then ordered.  A task sees a window's
    coarse groups or one group's latencies, never a window's records.
    """
    fine = (records.groupBy(_arrival_window(size), LATENCY)
            .agg(F.count("*").alias("n"))
            .withColumn("coarse", F.col(LATENCY) - F.pmod(LATENCY, F.lit(COARSE_MS)))
            # Stated here, both uses below have the same plan and share its shuffle.
            .filter(F.col("coarse").isNotNull()))
    coarse = fine.groupBy("w", "coarse").agg(
        F.sum("n").alias("n"), F.max(LATENCY).alias("top"), F.min(LATENCY).alias("low"),
        F.sum(F.col("n") * F.col(LATENCY)).alias("total"))
    whole = W.partitionBy("w")
    upto = whole.orderBy("coarse").rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = coarse.select(
        "w", "coarse", "n", F.sum("n").over(upto).alias("seen"),
        F.sum("n").over(whole).alias("n_records"), F.max("top").over(whole).alias("max_latency"),
        F.min("low").over(whole).alias("min_latency"), F.sum("total").over(whole).alias("total"))
    # Rank of percentile p is ceil(p * n / 100), in whole numbers.
    ranks = F.array(*[
        F.struct(F.lit(p).alias("p"),
                 F.floor((F.lit(p) * F.col("n_records") + 99) / 100).alias("rank"))
        for p in percentiles])
    wanted = F.filter(ranks, lambda r: (r["rank"] <= F.col("seen"))
                      & (r["rank"] > F.col("seen") - F.col("n")))
    summary = ["max_latency", "min_latency", "n_records", "total"]
    targets = (placed.select("w", "coarse", (F.col("seen") - F.col("n")).alias("earlier"),
                             *summary, F.explode(wanted).alias("t"))
               .select("w", "coarse", "earlier", *summary, "t.p", "t.rank"))
    in_group = (W.partitionBy("w", "coarse", "p").orderBy(LATENCY)
                .rowsBetween(W.unboundedPreceding, W.currentRow))
    return (fine.join(targets, ["w", "coarse"])
            .withColumn("seen", F.col("earlier") + F.sum("n").over(in_group))
            .filter((F.col("rank") <= F.col("seen"))
                    & (F.col("rank") > F.col("seen") - F.col("n")))
            .groupBy("w", *summary)
            .agg(*[F.max(F.when(F.col("p") == p, F.col(LATENCY))).alias(f"p{p}")
                   for p in percentiles])
            .select(F.col("w.start").alias("window_start"), "max_latency", "min_latency",
                    (F.col("total") / F.col("n_records")).alias("avg_latency"), "n_records",
                    *[f"p{p}" for p in percentiles]))


def with_running_max(windows: DataFrame, column: str, order: str, name: str,
                     block: str = "1 day") -> DataFrame:
    """Highest value of ``column`` up to and including each row, over all rows.

    One running maximum over everything would order every row in one task.
    Rows are ordered inside time blocks instead; only the first and last row of
    each block (two per day by default) are ordered across blocks, and the first
    row brings what it learns back to its block.  The input is read once.
    """
    length = F.lit(micros(block)).cast("bigint")
    us = F.unix_micros(order)
    in_block = W.partitionBy("block").orderBy(order)
    upto = in_block.rowsBetween(W.unboundedPreceding, W.currentRow)
    blocks = (windows.withColumn("block", us - F.pmod(us, length))
              .withColumn("here", F.max(column).over(upto))
              .withColumn("edge", F.lag(order).over(in_block).isNull()
                          | F.lead(order).over(in_block).isNull()))
    # All edge rows form one group; other rows stay with their block.
    across = (W.partitionBy(F.when(~F.col("edge"), F.col("block"))).orderBy(order)
              .rowsBetween(W.unboundedPreceding, -1))
    carried = blocks.withColumn("earlier", F.max("here").over(across))
    return (carried.withColumn("earlier", F.first("earlier").over(upto))
            .withColumn(name, F.greatest("here", "earlier"))
            .drop("block", "here", "edge", "earlier"))


def _counted(records: DataFrame, size: str) -> DataFrame:
    """Per arrival window: records, latest record time, worst latency."""
    return (with_latency(records).groupBy(_arrival_window(size))
            .agg(F.count("*").alias("n_records"), F.max("ts").alias("latest_here"),
                 F.max(LATENCY).alias("max_latency"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "n_records", "latest_here", "max_latency"))


def _with_latest(records: DataFrame, size: str) -> DataFrame:
    counted = _counted(records, size)
    if records.isStreaming:
        from pulseweave.streaming.processors import carry_over

        return carry_over(counted)
    return with_running_max(counted, "latest_here", "window_start", "latest_ts")


def record_throughput(records: DataFrame, size: str = "5 seconds") -> DataFrame:
    """Records per arrival window, latest record time so far, and how far that
    is behind the end of the window."""
    return (_with_latest(records, size)
            .withColumn("latest_latency", latency_ms(F.col("window_end"), F.col("latest_ts")))
            .select("window_start", "n_records", "latest_ts", "latest_latency"))


def alert_throughput(alerts: DataFrame, size: str = "5 seconds") -> DataFrame:
    """Alerts per arrival window, latest alert time so far, worst latency."""
    return _with_latest(alerts, size).select(
        "window_start", "n_records", "latest_ts", "max_latency")


def period_counts(records: DataFrame, size: str = "10 seconds") -> DataFrame:
    """Records per arrival period and in the period just before it.

    On a table each count is sent to its own period and, as ``previous``, to the
    next one, so neighbours meet by equality instead of by one ordering of all
    periods.  On a stream the previous count is kept as state.
    """
    if records.isStreaming:
        return _with_latest(records, size).select("window_start", "n_records", "n_previous")
    counted = (records.groupBy(_arrival_window(size)).agg(F.count("*").alias("n"))
               .select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n"))
    zero = F.lit(0).cast("bigint")
    sent = counted.select(F.explode(F.array(
        F.struct(F.col("start").alias("window_start"), F.col("n").alias("n_records"),
                 zero.alias("n_previous")),
        F.struct(F.col("end").alias("window_start"), zero.alias("n_records"),
                 F.col("n").alias("n_previous")))).alias("s")).select("s.*")
    return (sent.groupBy("window_start")
            .agg(F.sum("n_records").alias("n_records"), F.sum("n_previous").alias("n_previous"))
            .filter(F.col("n_records") > 0))
