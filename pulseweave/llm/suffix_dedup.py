"""Removal of repeated byte strings by a Burrows-Wheeler transform built column by column.

A window is ``length`` consecutive bytes of one document.  Every byte covered by a window
that also starts at another place of the corpus goes, first and later places alike.

Equal windows meet in one shard without comparing shards: a window's route is the least
hash of its ``anchor``-byte strings, and consecutive windows with one route (up to the number of
anchors in a window) travel as one segment.  Groups of documents first ask how often each
route occurs (``exchange``); segments of routes that occur once stay at home.  In routes that
occur over ``hot`` times groups also ask for each window, and send only the runs of windows
that occur again: what stands around a passage of very many documents is cut off, and what
is sent of it repeats, so that equal segments are one.

A shard first cuts its segments to their open pieces: the runs of windows all of whose strings of
half a window's length occur again under the route.  A window with a string that occurs once
cannot repeat; what is left may.  The distinct pieces are inserted into a transform with common
prefixes (``bwt``); a window repeats if the common prefix with a neighbour has its length, or if
its piece was sent from several places.  A piece that was sent from several places and has its
route alone needs no insertion: nothing else can match it.  Shards hold about ``shard_bytes`` of
segments.

Null text: no bytes.  Rows with equal doc_id and equal text are places of their own, so they
remove each other, as equal texts do.  Texts shorter than ``length`` keep all bytes.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from pulseweave.llm.bwt import repeats
from pulseweave.llm.columns import written
from pulseweave.llm.exchange import (ASKED, ASKED_SCHEMA, answers, as_batch, asked, in_groups,
                                     known, per_group, ranked, summed, unpack)
from pulseweave.llm.line_dedup import LAST
from pulseweave.llm.tokens import U64, RollingBytes, mix, slices, spans

LENGTH, ANCHOR = 200, 24
HOT = 8192
SHARD_BYTES = 8 << 20
#: Bytes of segments that a shard cuts at once; more if one route has more.
CUT_BYTES = 1 << 20

SENT = "grp int, route long, seg long, body binary, at binary, n long"
SENT_SCHEMA = pa.schema([("grp", pa.int32()), ("route", pa.int64()), ("seg", pa.int64()),
                         ("body", pa.binary()), ("at", pa.binary()), ("n", pa.int64())])
MARKS = "route long, seg long, runs binary"
MARKS_SCHEMA = pa.schema([("route", pa.int64()), ("seg", pa.int64()), ("runs", pa.binary())])
COVERED = "grp int, at binary"
COVERED_SCHEMA = pa.schema([("grp", pa.int32()), ("at", pa.binary())])
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


# --- segments -------------------------------------------------------------------------

class Segments:
    """Runs of windows with one route in a slice of texts: first byte, number of windows,
    route, and whether the route's anchor is in the run twice."""

    def __init__(self, texts: pa.Array, length: int, anchor: int):
        self.bytes = RollingBytes(texts)
        self.length = length
        runs = self.bytes.hashes(anchor)
        width, least, done = length - anchor + 1, runs, 1
        while done < width and len(least):  # minima over ever longer stretches
            step = min(done, width - done)
            least = np.minimum(least[:-step], least[step:])
            done += step
        inside = self.bytes.windows(length)
        head = inside.copy()
        head[1:] &= (least[1:] != least[:-1]) | ~inside[:-1]
        first = np.flatnonzero(head)
        before = np.concatenate(([0], np.cumsum(inside, dtype=np.int64)))
        n = np.diff(before[np.append(first, len(inside))])
        # Long runs (periodic texts) are cut, so that no segment is long.
        parts = -(-n // width)
        nth = spans(parts)
        self.first = np.repeat(first, parts) + nth * width
        self.n = np.minimum(np.repeat(n, parts) - nth * width, width)
        self.route = least[self.first]
        # Only strings that are the least of a window can be a route.
        padded = np.zeros(len(least) + 2 * (width - 1), U64)
        padded[width - 1:width - 1 + len(least)] = least
        most, done = padded, 1
        while done < width:  # maxima of the windows that a string is in
            step = min(done, width - done)
            most = np.maximum(most[:-step], most[step:])
            done += step
        routes = np.flatnonzero(most == runs) if len(least) else np.zeros(0, np.int64)
        low = np.searchsorted(routes, self.first)
        count = np.searchsorted(routes, self.first + self.n + width - 1) - low
        owner = np.repeat(np.arange(len(count)), count)
        same = runs[routes[low[owner] + spans(count)]] == self.route[owner]
        self.times = 1 + (np.bincount(owner[same], minlength=len(count)) > 1)

    def windows(self, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The hash of every window of the segments ``of``, and the segment of each."""
        n = self.n[of]
        owner = np.repeat(of, n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + self.first[owner]
        return self.bytes.hash_of(at, at + self.length), owner


def _cut_table(table: pa.Table, length: int, anchor: int):
    for batch in table.to_batches():
        for part in slices(batch):
            yield part, Segments(part.column("text"), length, anchor)


def _totals(pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    return summed(np.concatenate([np.zeros(0, U64), *(p[0] for p in pairs)]),
                  np.concatenate([np.zeros(0, np.int64), *(p[1] for p in pairs)]))


def _ask_routes(key: tuple, table: pa.Table, length: int, anchor: int, buckets: int) -> pa.Table:
    keys, own = _totals([(s.route, s.times) for _, s in _cut_table(table, length, anchor)])
    return as_batch(list(asked(key[0].as_py(), keys, own, buckets)), ASKED_SCHEMA)


def _split(answer: pa.Table, buckets: int) -> tuple[pa.Table, pa.Table]:
    """Answers about routes, and about windows, whose buckets follow the routes'."""
    second = pa.compute.greater_equal(answer.column("bucket"), buckets)
    windows = answer.filter(second)
    moved = pa.compute.subtract(windows.column("bucket"), pa.scalar(buckets, pa.int32()))
    return (answer.filter(pa.compute.invert(second)),
            windows.set_column(windows.schema.get_field_index("bucket"), "bucket", moved))


def _hot_windows(cut: list[Segments], hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct windows of hot segments, and how often each is in the group."""
    pairs = []
    for s in cut:
        keys, _ = s.windows(np.flatnonzero(np.isin(s.route, hot)))
        pairs.append(summed(keys, np.ones(len(keys), np.int64)))
    return _totals(pairs)


def _ask_windows(table: pa.Table, answer: pa.Table, length: int, anchor: int, buckets: int,
                 hot: int) -> pa.Table:
    if not any((unpack(p, c)[1] > hot).any() for p, c in zip(
            answer.column("places").to_pylist(), answer.column("counts").to_pylist())):
        return as_batch([], ASKED_SCHEMA)
    cut = [s for _, s in _cut_table(table, length, anchor)]
    keys, own = _totals([(s.route, s.times) for s in cut])
    busy = keys[known(answer, keys, own, buckets) > hot]
    if not len(busy):
        return as_batch([], ASKED_SCHEMA)
    keys, own = _hot_windows(cut, busy)
    group = table.column("grp")[0].as_py()
    return as_batch([(b + buckets, *rest) for b, *rest in asked(group, keys, own, buckets)],
                    ASKED_SCHEMA)


def _send(table: pa.Table, answer: pa.Table, length: int, anchor: int, buckets: int,
          hot: int) -> pa.Table:
    """The distinct segments of a group whose routes occur again, with their places as
    (doc_id, text_hash, first byte)."""
    cut = list(_cut_table(table, length, anchor))
    routes, windows = _split(answer, buckets)
    keys, own = _totals([(s.route, s.times) for _, s in cut])
    total = known(routes, keys, own, buckets)
    live, busy = keys[(total > 1) & (total <= hot)], keys[total > hot]
    again = np.zeros(0, U64)
    if len(busy):
        keys, own = _hot_windows([s for _, s in cut], busy)
        again = keys[known(windows, keys, own, buckets) > 1]
    found: dict[tuple, list] = {}
    group = 0
    for part, s in cut:
        group = part.column("grp")[0].as_py()
        on = np.flatnonzero(np.isin(s.route, live))
        first, n, route = s.first[on], s.n[on], s.route[on]
        if len(busy):
            key, owner = s.windows(np.flatnonzero(np.isin(s.route, busy)))
            keep = np.flatnonzero(np.isin(key, again))
            if len(keep):  # runs of windows that occur again
                head = np.ones(len(keep), bool)
                head[1:] = (np.diff(keep) != 1) | (owner[keep[1:]] != owner[keep[:-1]])
                head = np.flatnonzero(head)
                begin = np.flatnonzero(np.diff(owner, prepend=-1))
                offset = np.arange(len(owner)) - np.repeat(
                    begin, np.diff(np.append(begin, len(owner))))
                at = keep[head]
                first = np.append(first, s.first[owner[at]] + offset[at])
                n = np.append(n, np.diff(np.append(head, len(keep))))
                route = np.append(route, s.route[owner[at]])
        last = first + n + length - 1
        seg = mix(s.bytes.hash_of(first, last) + n.astype(U64))
        text = s.bytes.text_of(first)
        docs = part.column("doc_id").fill_null(LAST).to_numpy(False)[text]
        hashes = part.column("text_hash").to_numpy(False)[text]
        start = first - s.bytes.at[text]
        raw = s.bytes.data
        for r, g, a, b, place in zip(route.view(np.int64).tolist(), seg.view(np.int64).tolist(),
                                     first.tolist(), last.tolist(),
                                     zip(docs.tolist(), hashes.tolist(), start.tolist())):
            entry = found.get((r, g))
            if entry is None:
                found[(r, g)] = entry = [raw[a:b].tobytes()]
            entry.append(place)
    return as_batch([(group, r, g, e[0], np.array(e[1:], np.int64).tobytes(), len(e) - 1)
                     for (r, g), e in found.items()], SENT_SCHEMA)


# --- shards ---------------------------------------------------------------------------

def _open_pieces(route: np.ndarray, many: np.ndarray, texts: list[np.ndarray], length: int
                 ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows that may occur again: the segment, first window and number of windows."""
    gram = max(1, length // 2)
    sizes = np.array([len(t) for t in texts])
    starts = np.cumsum(sizes) - sizes
    strings = pa.LargeStringArray.from_buffers(
        len(texts), pa.py_buffer(np.append(starts, sizes.sum()).astype("<i8")),
        pa.py_buffer(np.concatenate(texts)))
    hashes = RollingBytes(strings).hashes(gram)
    n = sizes - gram + 1
    first_gram = np.cumsum(n) - n
    owner = np.repeat(np.arange(len(texts)), n)
    keys = hashes[np.arange(len(owner)) + (starts - first_gram)[owner]] ^ route.view(U64)[owner]
    _, order, first, number = ranked(keys)
    times = np.add.reduceat(1 + many[owner[order]].astype(np.int64), first)
    inside = np.concatenate(([0], np.cumsum(times[number] > 1)))
    n = sizes - length + 1
    first_window = np.cumsum(n) - n
    owner = np.repeat(np.arange(len(texts)), n)
    at = np.arange(len(owner)) + (first_gram - first_window)[owner]
    width = length - gram + 1
    kept = np.flatnonzero(inside[at + width] - inside[at] == width)
    if not len(kept):
        return kept, kept, kept
    fresh = np.ones(len(kept), bool)
    fresh[1:] = (np.diff(kept) != 1) | (np.diff(owner[kept]) != 0)
    head = np.flatnonzero(fresh)
    segment = owner[kept[head]]
    return segment, kept[head] - first_window[segment], np.diff(np.append(head, len(kept)))


def _pieces(route: np.ndarray, many: np.ndarray, times: np.ndarray, texts: list[np.ndarray],
            length: int) -> dict[tuple, list]:
    """(route, bytes) of every distinct open piece: how often it was sent, and its places as
    (segment, first window).  Routes are independent, so a few are cut at a time."""
    if not len(route):
        return {}
    by = np.argsort(route, kind="stable")
    ends = np.cumsum([len(texts[i]) for i in by])
    last = np.append(np.diff(route[by]) != 0, True)
    out: dict[tuple, list] = {}
    start = 0
    for stop in (np.flatnonzero(last) + 1).tolist():
        if stop < len(by) and ends[stop - 1] - (ends[start - 1] if start else 0) < CUT_BYTES:
            continue
        part, start = by[start:stop], stop
        for i, a, n in zip(*(x.tolist() for x in _open_pieces(
                route[part], many[part], [texts[i] for i in part], length))):
            i = part[i]
            piece = out.setdefault((route[i], texts[i][a:a + n + length - 1].tobytes()), [0])
            piece[0] += int(times[i])
            piece.append((i, a))
    return out


def _marks(table: pa.Table, length: int) -> pa.Table:
    """The runs of repeated windows of a shard's segments, as (from, to) in bytes."""
    route, seg = table.column("route").to_numpy(), table.column("seg").to_numpy()
    times = table.column("n").to_numpy()
    texts = [np.frombuffer(x.as_buffer(), np.uint8) for x in table.column("body")]
    _, which, count = np.unique(route, return_inverse=True, return_counts=True)
    alone = (times > 1) & (count[which] == 1)
    rows = []
    for i in np.flatnonzero(alone):
        rows.append((route[i], seg[i], np.array([[0, len(texts[i])]], np.int32).tobytes()))
    rest = np.flatnonzero(~alone)
    pieces = _pieces(route[rest], times[rest] > 1, times[rest], [texts[i] for i in rest], length)
    kinds = Counter(r for r, _ in pieces)
    inserted = {key: np.frombuffer(key[1], np.uint8) for key, (n, *_) in pieces.items()
                if n == 1 or kinds[key[0]] > 1}
    found = dict(zip(inserted, repeats(list(inserted.values()), length))) if inserted else {}
    for key, (n, *places) in pieces.items():
        if n > 1:
            runs = np.array([[0, len(key[1])]], np.int32)
        else:
            edge = np.flatnonzero(np.diff(np.concatenate(([False], found[key], [False]))))
            runs = edge.reshape(-1, 2).astype(np.int32)
            runs[:, 1] += length - 1
        for i, a in places if len(runs) else ():
            rows.append((key[0], seg[rest[i]], (runs + np.int32(a)).tobytes()))
    return as_batch(rows, MARKS_SCHEMA)


def _spread(batches):
    """Covered bytes per group: (doc_id, text_hash, from, to) of every place of a segment."""
    for batch in batches:
        rows = []
        for grp, at, runs in zip(*(batch.column(c).to_pylist() for c in ("grp", "at", "runs"))):
            at = np.frombuffer(at, np.int64).reshape(-1, 1, 3)
            runs = np.frombuffer(runs, np.int32).reshape(1, -1, 2).astype(np.int64)
            spans = np.empty((at.shape[0], runs.shape[1], 4), np.int64)
            spans[:, :, :2] = at[:, :, :2]
            spans[:, :, 2:] = at[:, :, 2:] + runs
            rows.append((grp, spans.tobytes()))
        yield from as_batch(rows, COVERED_SCHEMA).to_batches()


def _cut(table: pa.Table, covered: pa.Table) -> pa.Table:
    """The group's documents without their covered bytes."""
    spans: dict[tuple, list] = {}
    for data in covered.column("at").to_pylist():
        for d, t, a, b in np.frombuffer(data, np.int64).reshape(-1, 4).tolist():
            spans.setdefault((d, t), []).append((a, b))
    out = []
    for batch in table.to_batches():
        for d, t, text in zip(batch.column("doc_id").to_pylist(),
                              batch.column("text_hash").to_pylist(), batch.column("text")):
            raw = text.as_buffer().to_pybytes()
            runs: list[list[int]] = []
            for a, b in sorted(spans.get((LAST if d is None else d, t), ())):
                if runs and a <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], b)
                else:
                    runs.append([a, b])
            edges = [0, *(x for run in runs for x in run), len(raw)]
            kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
            out.append((d, len(raw), len(raw) - len(kept), len(runs),
                        hashlib.sha256(kept).hexdigest(), kept))
    return as_batch(out, pa.schema([
        ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
        ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())]))


def dedup_bytes(spark: SparkSession, docs: DataFrame, length: int = LENGTH,
                anchor: int = ANCHOR, shard_bytes: int = SHARD_BYTES, hot: int = HOT
                ) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the kept
    bytes."""
    rows, groups = in_groups(docs)
    routes = answers(rows.groupBy("grp").applyInArrow(
        lambda key, table: _ask_routes(key, table, length, anchor, groups), ASKED))
    windows = answers(per_group(
        rows, routes, lambda t, a: _ask_windows(t, a, length, anchor, groups, hot), ASKED))
    sent = written(spark, per_group(
        rows, routes.union(windows),
        lambda t, a: _send(t, a, length, anchor, groups, hot), SENT), "segments")
    total = sent.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    shards = max(8, -(-total // shard_bytes))
    shard = F.pmod(F.xxhash64("route"), F.lit(shards)).cast("int").alias("shard")
    marks = (sent.select(shard, "route", "seg", "body", "n").repartition("shard")
             .groupBy("shard", "route", "seg").agg(F.first("body").alias("body"),
                                                   F.sum("n").alias("n"))
             .groupBy("shard").applyInArrow(lambda t: _marks(t, length), MARKS))
    covered = (sent.select("grp", "route", "seg", "at").join(marks, ["route", "seg"])
               .select("grp", "at", "runs").mapInArrow(_spread, COVERED))
    return per_group(rows, covered, _cut, RESULT + ", kept binary")
