"""Drift detection with an adaptive window per series.

The window keeps an exponential histogram: row ``i`` holds buckets of ``2**i``
readings, oldest first.  A reading enters row 0; a row with six buckets merges
its two oldest into the next row.  When the old part of the window and the rest
differ by more than a bound, the old part is dropped and the window has drifted.

The next state depends on all earlier readings of the series, so one series is
one sequential scan.  It is done in constant memory (a few dozen buckets), in
parallel over series; ``detect_drift_in_slices`` bounds how much of a long
series one task has to read, and the stream in ``pulseweave.streaming`` carries
the same state from micro-batch to micro-batch.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pulseweave.dims import STEADY_DRIFT_UNITS
from pulseweave.functions.ids import stable_id
from pulseweave.operators.ordering import key_at, runs, to_batch, values_of
from pulseweave.session import shared_dir

KEYS = ["patient_id", "unit"]

# Fixed values of the detector.
SHORTEST_WINDOW = 16     # no test until the window is longer than this
BUCKETS_PER_ROW = 5
START_DELTA = 0.3
SHORTEST_PART = 5        # readings needed on either side of a cut
# Sensitivity: weights of the newest jump and of the level before it; the range of
# levels in which the test is made keener; and what a level takes off itself.
JUMP_WEIGHT, PAST_WEIGHT = 0.3, 0.7
MOVING, WILD = 0.15, 0.4
DELTA_FROM, DELTA_GAIN, DELTA_OFFSET = 0.3, 3, 0.08
WILD_STEP = 0.1
SMALL_JUMP = 0.4
# (highest delta, lowest ratio, ratio's slope, step) for small and large jumps.
SMALL, LARGE = (0.8, 0.35, 3.5, 0.0), (0.6, 0.5, 2.5, 0.015)
TRIM_ABOVE = 100         # a resumed window wider than this loses its oldest bucket
SMALLEST_DOUBLE = 5e-324  # where the running maximum starts


class DriftWindow:
    """Adaptive window of one series."""

    __slots__ = ("adaptive", "published", "width", "total", "variance", "delta", "ratio",
                 "relative", "high", "low", "rows")

    def __init__(self, adaptive: bool, published: bool = False):
        self.adaptive, self.published = adaptive, published
        self.width, self.total, self.variance = 0, 0.0, 0.0
        self.delta, self.ratio, self.relative = START_DELTA, 1.0, 0.0
        self.high, self.low = SMALLEST_DOUBLE, math.inf
        self.rows: list[list[tuple[float, float, int]]] = [[]]

    # Extent of the window in time.
    def starts(self) -> int:
        return self.rows[-1][0][2]

    def ends(self) -> int:
        return self.rows[0][-1][2]

    def add(self, value: float, time: int) -> bool:
        """Take a reading in; True when the window was cut."""
        newest = self.rows[0]
        before = self.width
        self.width = width = before + 1
        newest.append((value, 0.0, time))
        if value > self.high:
            self.high = value
        if value < self.low:
            self.low = value
        if self.adaptive and len(newest) > 1 and self.high > self.low:
            self._tune(abs(newest[-1][0] - newest[-2][0]))
        if before:
            off = value - self.total / before
            self.variance += before / width * off * off
        self.total += value
        if len(newest) > BUCKETS_PER_ROW:
            self._compress()
        return width > SHORTEST_WINDOW and self._cut_old_part()

    def _tune(self, jump: float) -> None:
        """Make the test keener while readings move, relative to their range."""
        level = JUMP_WEIGHT * (jump / (self.high - self.low)) + PAST_WEIGHT * self.relative
        top, bottom, slope, step = SMALL if jump < SMALL_JUMP else LARGE
        moving = MOVING < level < WILD
        if moving:
            self.delta = min(top, DELTA_FROM + (level - DELTA_OFFSET) * DELTA_GAIN)
            self.ratio = max(bottom, 1.0 - level * slope)
        self.relative = level - (step if moving else WILD_STEP if level >= WILD else 0.0)

    def _compress(self) -> None:
        rows = self.rows
        size = 1.0
        for i in range(len(rows)):
            row = rows[i]
            if len(row) <= BUCKETS_PER_ROW:
                return
            (s1, v1, t1), (s2, v2, t2) = row[0], row[1]
            del row[:2]
            gap = s1 / size - s2 / size
            merged = (s1 + s2, v1 + v2 + size * size * gap * gap / (size + size), min(t1, t2))
            if i + 1 == len(rows):
                rows.append([merged])
                return
            rows[i + 1].append(merged)
            size *= 2

    def _cut_old_part(self) -> bool:
        cut = False
        while True:
            level = len(self.rows) - 1
            if level == 0:
                return cut
            drop = self._buckets_to_drop(self.rows[level], 1 << level)
            if not drop:
                return cut
            cut = True
            for _ in range(drop):
                self.drop_oldest()

    def _buckets_to_drop(self, oldest: list[tuple[float, float, int]], size: int) -> int:
        """How many buckets of the oldest row precede the first significant
        change; its last bucket is never a cut point."""
        width = self.width
        spread = self.variance / width
        old_n, old_sum = 0, 0.0
        new_n, new_sum = width, self.total
        log_term = math.log(2.0 * math.log(width) / self.delta)
        for k in range(len(oldest) - 1):
            bucket_sum = oldest[k][0]
            old_n += size
            new_n -= size
            old_sum += bucket_sum
            new_sum -= bucket_sum
            if old_n < SHORTEST_PART or new_n < SHORTEST_PART:
                continue
            m = 1.0 / (old_n - 4.0) + 1.0 / (new_n - 4.0)
            under_root = 2.0 * m * spread * log_term
            if not under_root >= 0.0:
                continue  # a negative variance never signals
            bound = (math.sqrt(under_root) + 2.0 / 3.0 * log_term * m) * self.ratio
            if abs(old_sum / old_n - new_sum / new_n) > bound:
                return k + 1
        return 0

    def drop_oldest(self) -> None:
        level = len(self.rows) - 1
        row = self.rows[level]
        bucket_sum, bucket_variance, _ = row.pop(0)
        size = 1 << level
        self.width = width = self.width - size
        self.total -= bucket_sum
        off = bucket_sum / size - self.total / width
        between = size * width * off * off
        if self.published:
            self.variance -= bucket_variance + between / (size + width)
        else:
            self.variance -= (bucket_variance + between) / (size + width)
        if not row:
            self.rows.pop()

    def trim(self) -> None:
        """Done once whenever a window is taken up again from stored state."""
        if self.width > TRIM_ABOVE:
            self.drop_oldest()

    # State in flat form, for a state store or a table.
    def dump(self) -> dict:
        flat = [bucket for row in self.rows for bucket in row]
        return {
            "width": self.width, "total": self.total, "variance": self.variance,
            "delta": self.delta, "ratio": self.ratio, "relative": self.relative,
            "high": self.high, "low": self.low,
            "sizes": [len(row) for row in self.rows],
            "sums": [b[0] for b in flat], "variances": [b[1] for b in flat],
            "times": [b[2] for b in flat],
        }

    @classmethod
    def load(cls, state: dict, adaptive: bool, published: bool = False) -> DriftWindow:
        window = cls(adaptive, published)
        for name in ("width", "total", "variance", "delta", "ratio", "relative", "high", "low"):
            setattr(window, name, state[name])
        flat = list(zip(state["sums"], state["variances"], state["times"]))
        ends = np.cumsum(state["sizes"]).tolist()
        window.rows = [flat[end - size:end] for end, size in zip(ends, state["sizes"])]
        return window


STATE_SCHEMA = (
    "width int, total double, variance double, delta double, ratio double, "
    "relative double, high double, low double, sizes array<int>, sums array<double>, "
    "variances array<double>, times array<bigint>"
)

SCAN_SCHEMA = ("patient_id string, unit string, from_us bigint, to_us bigint, value double, "
               "width int, total double, state string")
SCAN_COLUMNS = [field.split()[0] for field in SCAN_SCHEMA.split(", ")]
_SCANNED = pa.schema([
    ("patient_id", pa.string()), ("unit", pa.string()), ("from_us", pa.int64()),
    ("to_us", pa.int64()), ("value", pa.float64()), ("width", pa.int32()),
    ("total", pa.float64()), ("state", pa.string())])


class DriftCall:
    """One call on one series: readings in time order, results to emit.

    ``per_drift`` emits at every cut.  ``per_batch`` emits at most once, with
    the extent at the last cut and the value, width and sum at the end.
    """

    def __init__(self, window: DriftWindow, emit: str, resumed: bool = False):
        self.window, self.per_drift = window, emit == "per_drift"
        self.trim_due = resumed
        self.last = None
        self.value = 0.0

    def feed(self, values: Sequence[float], times: Sequence[int]) -> list[tuple]:
        window, found = self.window, []
        if self.trim_due and values:
            window.trim()
            self.trim_due = False
        add = window.add
        for value, time in zip(values, times):
            if add(value, time):
                self.last = (window.starts(), window.ends())
                if self.per_drift:
                    found.append((*self.last, value, window.width, window.total))
        if values:
            self.value = values[-1]
        return found

    def close(self) -> list[tuple]:
        if self.per_drift or self.last is None:
            return []
        return [(*self.last, self.value, self.window.width, self.window.total)]


def _scanner(emit: str, published: bool, keep_state: bool, trims: bool = False,
             ) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A scan over sorted series; a series may span any number of batches."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, call = None, None

        def finish() -> list[tuple]:
            rows = [(*current, *r, None) for r in call.close()]
            if keep_state:
                state = json.dumps(call.window.dump())
                rows.append((*current, None, None, None, None, None, state))
            return rows

        for batch in batches:
            if batch.num_rows == 0:
                continue
            values, times = values_of(batch, "value"), values_of(batch, "us")
            out = []
            for start, end in runs(batch, KEYS):
                key = key_at(batch, KEYS, start)
                if key != current:
                    if current is not None:
                        out += finish()
                    current = key
                    adaptive = batch.column("adaptive")[start].as_py()
                    stored = batch.column("state")[start].as_py() if keep_state else None
                    if stored is None:
                        call = DriftCall(DriftWindow(adaptive, published), emit)
                    else:
                        # Stored state sorts before the readings of its series.
                        window = DriftWindow.load(json.loads(stored), adaptive, published)
                        call = DriftCall(window, emit, resumed=trims)
                        start += 1
                found = call.feed(values[start:end].tolist(), times[start:end].tolist())
                out += [(*key, *r, None) for r in found]
            if out:
                yield to_batch(out, _SCANNED)
        if current is not None:
            out = finish()
            if out:
                yield to_batch(out, _SCANNED)

    return scan


def is_adaptive(unit: Column) -> Column:
    return ~unit.isin(*STEADY_DRIFT_UNITS)


def drift_rows(scanned: DataFrame) -> DataFrame:
    """Name every detected drift; the id is a function of the row."""
    return scanned.select(
        stable_id(F.lit("drift"), F.col("patient_id"), F.col("unit"), F.col("from_us"),
                  F.col("to_us")).alias("id"),
        "patient_id", "unit", F.timestamp_micros("from_us").alias("from"),
        F.timestamp_micros("to_us").alias("to"), "value", "width", "total")


def series_rows(records: DataFrame, adaptive: Column | None) -> DataFrame:
    flag = is_adaptive(F.col("unit")) if adaptive is None else adaptive
    return records.select(*KEYS, F.unix_micros("ts").alias("us"), "value",
                          flag.alias("adaptive"))


def detect_drift(records: DataFrame, adaptive: Column | None = None,
                 emit: str = "per_drift", variant: str = "reference") -> DataFrame:
    """Drifts of every series of a table, each series scanned in one call.

    ``variant="paper"`` takes the published variance update instead of the
    default one.
    """
    rows = series_rows(records, adaptive)
    scanned = (rows.repartition(*KEYS).sortWithinPartitions(*KEYS, "us", "value")
               .mapInArrow(_scanner(emit, variant == "paper", False), SCAN_SCHEMA))
    return drift_rows(scanned)


def detect_drift_in_slices(records: DataFrame, edges: Sequence[str],
                           adaptive: Column | None = None, emit: str = "per_drift",
                           variant: str = "reference", calls: str = "whole") -> DataFrame:
    """The same scan as one job per time slice, each ending in a written table.

    ``edges`` are the inner boundaries between slices.  A task reads at most one
    slice of a series, and a lost executor costs at most one slice: windows are
    handed from slice to slice as rows of a table in the shared folder.  Where the
    edges lie does not matter.  ``calls="per_slice"`` makes each slice a call of its
    own, as a micro-batch of the stream is (see ``DriftWindow.trim``); only then has
    ``emit="per_batch"`` a meaning.
    """
    if calls not in ("whole", "per_slice"):
        raise ValueError(f"calls is 'whole' or 'per_slice', not {calls!r}")
    if calls == "whole" and emit != "per_drift":
        raise ValueError("one call over all slices emits per drift")
    work_dir = shared_dir(records.sparkSession, "drift-slices")
    spark = records.sparkSession
    bounds = [None, *edges, None]
    scan = _scanner(emit, variant == "paper", True, trims=calls == "per_slice")
    previous = None
    for i, (low, high) in enumerate(zip(bounds[:-1], bounds[1:])):
        part = records
        if low is not None:
            part = part.filter(F.col("ts") >= F.lit(low).cast("timestamp"))
        if high is not None:
            part = part.filter(F.col("ts") < F.lit(high).cast("timestamp"))
        part = series_rows(part, adaptive).withColumn("state", F.lit(None).cast("string"))
        if previous is not None:
            stored = spark.read.parquet(previous).filter(F.col("state").isNotNull())
            flags = is_adaptive(F.col("unit")) if adaptive is None else adaptive
            part = part.unionByName(stored.select(
                *KEYS, F.lit(-(1 << 62)).cast("bigint").alias("us"),
                F.lit(0.0).alias("value"), flags.alias("adaptive"), "state"))
        previous = f"{work_dir}/slice={i}"
        (part.repartition(*KEYS).sortWithinPartitions(*KEYS, "us", "value")
         .mapInArrow(scan, SCAN_SCHEMA).write.mode("overwrite").parquet(previous))
    found = (spark.read.schema(SCAN_SCHEMA + ", slice int").parquet(work_dir)
             .filter(F.col("state").isNull()))
    return drift_rows(found)
