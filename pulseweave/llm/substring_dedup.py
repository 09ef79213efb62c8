"""Substring deduplication with a compressed FM-index per shard.

A window is ``window`` consecutive words of one document.  Words covered by a window whose
words also start earlier in the corpus (smaller doc_id, or same document and earlier start)
are removed; windows are judged on the input.

Equal windows meet in one shard without comparing shards with each other: a window's route
is the least hash of its ``anchor``-word runs, and consecutive windows with one route travel
as one segment.  Routes that occur once in the corpus are dropped before any text moves
(see ``exchange``).  A shard holds the distinct segments of its routes, as many shards as
the live text needs, and each distinct segment once per group of documents at most, so a
passage in every document is one row a group.

In a shard the segments are one sequence of words.  Its Burrows-Wheeler transform is kept in
a wavelet matrix of bit vectors with block ranks.  All windows are streamed through it by
backward search, a word a step; a window leaves when nothing but itself matches, and when
few matches are left they are located and compared word by word by a hash of the window.
The earliest match of a window is a range minimum over its suffix interval.

Null text: no words.  Rows with equal doc_id are one document; a null doc_id comes last.
Repeated rows lose the same words.  Texts shorter than a window lose none.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from pulseweave.llm.exchange import (ASKED, ASKED_SCHEMA, answers, as_batch, asked, in_groups,
                                     known, per_group, summed)
from pulseweave.llm.line_dedup import LAST, RangeHash
from pulseweave.llm.tokens import U64, Words, grams, same_text, slices, words_of

WINDOW, ANCHOR = 20, 6
SHARD_BYTES = 1 << 20
FEW = 6

SEGMENTS = "shard int, grp int, words binary, at binary"
COVERED = "grp int, at binary"
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


# --- segments -------------------------------------------------------------------------

def segments(words: Words, window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one route: first word, number of windows, route, and whether
    the route's anchor is in the run twice (only then can two of its windows be equal)."""
    at = np.flatnonzero(same_text(words.first, window))
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, bool)
    runs = grams(words.hashes(), anchor)
    width, least = window - anchor + 1, runs
    done = 1
    while done < width:  # minima over ever longer stretches
        step = min(done, width - done)
        least = np.minimum(least[:-step], least[step:])
        done += step
    route = least[at]
    text = words.text[at]
    fresh = np.ones(len(at), bool)
    fresh[1:] = (route[1:] != route[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(fresh)
    n, route, first = np.diff(np.append(first, len(at))), route[first], at[first]
    size = n + width - 1
    ends = np.cumsum(size)
    inside = np.arange(ends[-1]) + np.repeat(first - (ends - size), size)
    anchors = np.add.reduceat((runs[inside] == np.repeat(route, size)).astype(np.int64), ends - size)
    return first, n, route, anchors > 1


def _ask(key: tuple, table: pa.Table, window: int, anchor: int, buckets: int) -> pa.Table:
    """A group's routes and how many segments have each, twofold ones counted twice."""
    routes, times = [np.zeros(0, U64)], [np.zeros(0, np.int64)]
    for batch in table.to_batches():
        for part in slices(batch):
            _, _, route, again = segments(words_of(part.column("text")), window, anchor)
            routes.append(route)
            times.append(1 + again)
    keys, own = summed(np.concatenate(routes), np.concatenate(times))
    return as_batch(list(asked(key[0].as_py(), keys, own, buckets)), ASKED_SCHEMA)


SEGMENT_SCHEMA = pa.schema([("shard", pa.int32()), ("grp", pa.int32()), ("words", pa.binary()),
                            ("at", pa.binary())])


def _send(table: pa.Table, answer: pa.Table, window: int, anchor: int, groups: int,
          shards: int) -> pa.Table:
    """The distinct segments of a group whose routes occur twice or more in the corpus,
    each with its first place (doc_id, text_hash, first word).  At its later places in
    the group all words of a segment are covered: one row without words has those, as
    (doc_id, text_hash, from, to)."""
    cut, routes, times = [], [np.zeros(0, U64)], [np.zeros(0, np.int64)]
    for batch in table.to_batches():
        for part in slices(batch):
            words = words_of(part.column("text"))
            first, n, route, again = segments(words, window, anchor)
            cut.append((part, words, first, n, route))
            routes.append(route)
            times.append(1 + again)
    keys, own = summed(np.concatenate(routes), np.concatenate(times))
    live = keys[known(answer, keys, own, groups) > 1]
    found: dict[bytes, list] = {}
    group = 0
    for part, words, first, n, route in cut:
        group = part.column("grp")[0].as_py()
        keep = np.isin(route, live)
        first, n, route = first[keep], n[keep], route[keep]
        text = words.text[first]
        docs = part.column("doc_id").fill_null(LAST).to_numpy(False)[text]
        hashes = part.column("text_hash").to_numpy(False)[text]
        start = first - words.first[text]
        shard = (route >> U64(32)) * U64(shards) >> U64(32)
        raw = words.data.tobytes()
        last = first + n + window - 2
        for s, a, b, at in zip(shard.tolist(), words.starts[first].tolist(),
                               words.ends[last].tolist(),
                               zip(docs.tolist(), hashes.tolist(), start.tolist())):
            found.setdefault((s, b" ".join(raw[a:b].split())), []).append(at)
    rows, later = [], []
    for (shard, text), at in found.items():
        at.sort(key=lambda x: (x[0], x[2]))
        n = text.count(b" ") + 1
        # Repeated rows of one document are at its first place together.
        heads = [x for x in at if (x[0], x[2]) == (at[0][0], at[0][2])]
        later += [(*x, x[2] + n) for x in at[len(heads):]]
        rows.append((shard, group, text, np.array(heads, np.int64).tobytes()))
    if later:
        rows.append((group % shards, group, b"", np.array(later, np.int64).tobytes()))
    return as_batch(rows, SEGMENT_SCHEMA)


# --- the index ------------------------------------------------------------------------

class BitVector:
    """Bits in 64-bit blocks with the number of ones before each block."""

    def __init__(self, bits: np.ndarray):
        blocks = np.zeros(len(bits) // 64 * 8 + 8, np.uint8)
        packed = np.packbits(bits, bitorder="little")
        blocks[:len(packed)] = packed
        self.blocks = blocks.view("<u8")
        self.before = np.zeros(len(self.blocks), np.int32)
        np.cumsum(np.bitwise_count(self.blocks[:-1]), out=self.before[1:])

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones in front of each place."""
        block = at >> 6
        low = (U64(1) << (at & 63).astype(U64)) - U64(1)
        return self.before[block] + np.bitwise_count(self.blocks[block] & low)


class WaveletMatrix:
    """Rank of symbols by one bit vector per bit, high bits first."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels, self.zeros = [], []
        for k in range(bits - 1, -1, -1):
            one = (symbols >> k) & 1 == 1
            self.levels.append((k, BitVector(one)))
            self.zeros.append(int((~one).sum()))
            symbols = np.concatenate((symbols[~one], symbols[one]))

    def rank(self, symbol: np.ndarray, at: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """How often a symbol occurs before each place; ``begin`` is where the symbol's run
        starts in the last level (see ``begins``)."""
        return self.descend(symbol, at) - begin

    def descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for (k, level), zeros in zip(self.levels, self.zeros):
            ones = level.ones(at)
            at = np.where((symbol >> k) & 1 == 1, zeros + ones, at - ones)
        return at


def suffix_array(codes: np.ndarray) -> np.ndarray:
    """Order of the suffixes, by doubling the compared length until all differ."""
    _, rank = np.unique(codes, return_inverse=True)
    n, length = len(codes), 1
    while True:
        after = np.zeros(n, np.int64)
        after[:n - length] = rank[length:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        fresh = np.concatenate(([0], np.cumsum(np.diff(key[order]) != 0)))
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        if fresh[-1] == n - 1:
            return order
        length *= 2


class FMIndex:
    """Backward search over a sequence in which 0 parts the segments."""

    def __init__(self, codes: np.ndarray, parts: int):
        n = len(codes)
        # Every part mark is a symbol of its own to the sorting, and below all words.
        marks = np.where(codes == 0, np.cumsum(codes == 0) - parts - 1, codes)
        self.order = suffix_array(marks)
        last = codes[self.order - 1]
        self.size = int(codes.max()) + 1
        self.first = np.concatenate(([0], np.cumsum(np.bincount(codes, minlength=self.size))))
        self.matrix = WaveletMatrix(last, max(1, int(self.size - 1).bit_length()))
        self.begin = self.matrix.descend(np.arange(self.size), np.zeros(self.size, np.int64))
        self.n = n

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray):
        """Intervals of the patterns with one more word in front."""
        base = self.first[symbol] - self.begin[symbol]
        return base + self.matrix.descend(symbol, low), base + self.matrix.descend(symbol, high)


class RangeMinimum:
    """Least of values[low:high] by tables of minima over powers of two."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        while 2 << (len(self.rows) - 1) <= len(values):
            half = 1 << (len(self.rows) - 1)
            row = self.rows[-1]
            self.rows.append(np.minimum(row[:-half], row[half:]))

    def __call__(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        k = np.floor(np.log2(high - low)).astype(np.int64)
        out = np.empty(len(low), self.rows[0].dtype)
        for level in np.unique(k):
            of = k == level
            row = self.rows[level]
            out[of] = np.minimum(row[low[of]], row[high[of] - (1 << level)])
        return out


def earliest_matches(codes: np.ndarray, parts: int, order: np.ndarray, at: np.ndarray,
                     window: int) -> np.ndarray:
    """For the window at each place of ``at`` the least ``order`` of its occurrences;
    ``order`` ranks places, places that start no window rank last."""
    index = FMIndex(codes, parts)
    least = RangeMinimum(order[index.order])
    runs = RangeHash(codes.astype(U64), 0x9E3779B97F4A7C15)
    whole = np.zeros(len(codes), U64)
    whole[at] = runs.of(at, at + window)
    out = order[at].copy()
    for begin in range(0, len(at), 1 << 16):
        pick = np.arange(begin, min(begin + (1 << 16), len(at)))
        place = at[pick]
        low = np.zeros(len(pick), np.int64)
        high = np.full(len(pick), index.n)
        for k in range(window - 1, -1, -1):
            low, high = index.step(codes[place + k], low, high)
            if k == 0:
                out[pick] = np.minimum(out[pick], least(low, high))
                break
            count = high - low
            few = (count > 1) & (count <= FEW)
            for j in range(FEW):  # locate the few matches of the window's end
                on = np.flatnonzero(few & (count > j))
                if not len(on):
                    break
                start = index.order[low[on] + j] - k
                on, start = on[start >= 0], start[start >= 0]
                same = whole[start] == whole[place[on]]
                on, start = on[same], start[same]
                out[pick[on]] = np.minimum(out[pick[on]], order[start])
            more = count > FEW
            pick, place, low, high = pick[more], place[more], low[more], high[more]
            if not len(pick):
                break
    return out


COVERED_SCHEMA = pa.schema([("grp", pa.int32()), ("at", pa.binary())])


def _search(table: pa.Table, window: int) -> pa.Table:
    """Covered words of a shard's segments, per group: (doc_id, text_hash, from, to)."""
    bare = pa.compute.equal(table.column("words"), b"")
    known_rows = table.filter(bare).select(COVERED_SCHEMA.names)
    table = table.filter(pa.compute.invert(bare))
    if not table.num_rows:
        return known_rows
    distinct = table.column("words").combine_chunks().dictionary_encode()
    which = distinct.indices.to_numpy()
    texts = distinct.dictionary.cast(pa.large_binary()).cast(pa.large_string())
    cut = [words_of(part.column("text")) for part in slices(
        pa.record_batch([texts], names=["text"]))]
    hashes = np.concatenate([w.hashes() for w in cut])
    n = np.concatenate([np.diff(w.first) for w in cut])
    first = np.cumsum(n) - n
    del cut
    # Places of every segment, and the first of each distinct one.
    rows = [np.frombuffer(x, np.int64).reshape(-1, 3) for x in table.column("at").to_pylist()]
    sizes = np.array([len(x) for x in rows])
    places = np.concatenate(rows)
    which = np.repeat(which, sizes)
    group = np.repeat(table.column("grp").to_numpy(), sizes)
    by = np.lexsort((places[:, 2], places[:, 0], which))
    which, places, group = which[by], places[by], group[by]
    heads = np.flatnonzero(np.diff(which, prepend=-1))
    parts = len(n)
    # One sequence: the words of a segment, then a part mark.
    codes = np.zeros(len(hashes) + parts, np.int64)
    begin = first + np.arange(parts)
    inner = np.ones(len(codes), bool)
    inner[begin + n] = False
    codes[inner] = np.unique(hashes, return_inverse=True)[1] + 1
    count = n - window + 1
    segment = np.repeat(np.arange(parts), count)
    offset = np.arange(len(segment)) - np.repeat(np.cumsum(count) - count, count)
    at = begin[segment] + offset
    # Rank windows by where they first start; equal places have equal ranks.
    doc, start = places[heads, 0][segment], places[heads, 2][segment] + offset
    by = np.lexsort((start, doc))
    fresh = (np.diff(doc[by]) != 0) | (np.diff(start[by]) != 0)
    rank = np.empty(len(by), np.int64)
    rank[by] = np.concatenate(([0], np.cumsum(fresh)))
    order = np.full(len(codes), len(by) + 1)
    order[at] = rank
    best = earliest_matches(codes, parts, order, at, window)
    back = np.zeros(len(by) + 2, np.int64)
    back[rank] = np.arange(len(rank))
    best_doc, best_start = doc[back[best]], start[back[best]]
    # Every place of a segment against its windows' earliest starts.
    span = count[which]
    mine = np.repeat(np.arange(len(which)), span)
    shift = np.arange(len(mine)) - np.repeat(np.cumsum(span) - span, span)
    window_at = (np.cumsum(count) - count)[which[mine]] + shift
    d, s = places[mine, 0], places[mine, 2] + shift
    later = (best_doc[window_at] < d) | ((best_doc[window_at] == d) & (best_start[window_at] < s))
    on = np.flatnonzero(later)
    if not len(on):
        return known_rows
    # Runs of covered windows in one place.
    cut = np.ones(len(on), bool)
    cut[1:] = (np.diff(on) != 1) | (np.diff(mine[on]) != 0)
    head = np.flatnonzero(cut)
    tail = np.append(head[1:], len(on)) - 1
    head, tail = on[head], on[tail]
    found = np.stack((d[head], places[mine[head], 1], s[head], s[tail] + window), axis=1)
    owner = group[mine[head]]
    by = np.argsort(owner, kind="stable")
    edges = np.flatnonzero(np.diff(owner[by])) + 1
    return pa.concat_tables([known_rows, as_batch(
        [(int(owner[x[0]]), found[x].tobytes()) for x in np.split(by, edges)], COVERED_SCHEMA)])


def _cut(table: pa.Table, covered: pa.Table) -> pa.Table:
    """The group's documents without their covered words."""
    spans: dict[tuple, list] = {}
    for data in covered.column("at").to_pylist():
        for d, t, a, b in np.frombuffer(data, np.int64).reshape(-1, 4).tolist():
            spans.setdefault((d, t), []).append((a, b))
    out = []
    for batch in table.to_batches():
        for d, t, text in zip(batch.column("doc_id").to_pylist(),
                              batch.column("text_hash").to_pylist(),
                              batch.column("text")):
            words = text.as_buffer().to_pybytes().split()
            gone = np.zeros(len(words) + 1, np.int32)
            for a, b in spans.get((LAST if d is None else d, t), ()):
                gone[a] += 1
                gone[b] -= 1
            keep = np.cumsum(gone)[:-1] == 0
            kept = b" ".join(w for w, k in zip(words, keep.tolist()) if k) \
                if not keep.all() else b" ".join(words)
            out.append((d, len(words), int((~keep).sum()), hashlib.sha256(kept).hexdigest(),
                        kept.decode()))
    return as_batch(out, pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()),
                                    ("n_removed", pa.int64()), ("kept_sha256", pa.string()),
                                    ("kept", pa.string())]))


def dedup_substrings(spark: SparkSession, docs: DataFrame, window: int = WINDOW,
                     anchor: int = ANCHOR, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, kept_sha256 and the kept text."""
    rows, groups = in_groups(docs)
    shards = max(8, groups * (4 << 20) // shard_bytes)

    asks = rows.groupBy("grp").applyInArrow(
        lambda key, table: _ask(key, table, window, anchor, groups), ASKED)
    sent = per_group(rows, answers(asks),
                     lambda t, a: _send(t, a, window, anchor, groups, shards), SEGMENTS)
    covered = sent.groupBy("shard").applyInArrow(lambda t: _search(t, window), COVERED)
    return per_group(rows, covered, _cut, RESULT + ", kept string")
