"""Language-model scores by a weighted backoff automaton.

Tokens are the words of a text with A-Z in lower case, then an end token.  Counts of
n-grams up to ``order`` are gathered over all training documents: those whose
crc32(doc_id as text) mod 7 is not 2.  Probabilities are smoothed towards the next lower
order with ``prior`` pseudo-counts,

    P(w | h) = (c(h w) + prior * P(w | h')) / (c(h) + prior),

h' being h without its first word; the lowest order is (c(w) + 1) / (N + V + 1).  They sum
to one over the vocabulary and one unknown word.

As an automaton: a state is a context h seen in training.  Its arcs are the words seen
after it; its failure arc leads to h' and costs prior / (c(h) + prior).  A text is scored in
one traversal from left to right; as the state before a word is the longest seen suffix of
the words before it, all positions of a group of texts are traversed at once as arrays.
Each group of documents builds the part of the automaton that its texts can reach, from
counts that are summed over the whole corpus (see ``exchange``); no task holds the model.

Groups ask for words and pairs first.  An n-gram of three words or more can be in another
group only if both shorter ones inside it are, so groups ask for those alone, order by order;
the total of any other is the group's own count.

Null or empty text: the end token alone.  Null doc_id: crc32 of the empty string, so in
training.  Repeated rows count repeatedly and score alike.  Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pulseweave.llm.columns import text_or_empty
from pulseweave.llm.exchange import (CELLS, CELLS_SCHEMA, as_batch, cell_of, cells, in_groups, met,
                                     opened, packed_groups, per_group, ranked, told)
from pulseweave.llm.tokens import BASE, U64, mix, slices, words_of

ORDER = 3
PRIOR = 20.0
START, END = U64(0x243F6A8885A308D3), U64(0x13198A2E03707344)

SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, "
          "base_logs double, score double")


def _with_marks(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of every text between a start and an end mark, and texts' lengths."""
    words = words_of(batch.column("text"), lower=True)
    lengths = np.diff(words.first)
    out = np.empty(len(words.starts) + 2 * len(lengths), U64)
    begin = words.first[:-1] + 2 * np.arange(len(lengths))
    inner = np.ones(len(out), bool)
    inner[begin] = inner[begin + lengths + 1] = False
    out[begin], out[begin + lengths + 1] = START, END
    out[inner] = words.hashes()
    return out, lengths + 2


def _ngrams(marked: np.ndarray, lengths: np.ndarray, order: int) -> list[np.ndarray]:
    """Per order 1 to ``order``: the key of the n-gram that ends at each place.  A place
    without one (too near its text's start, or a start mark alone) has key 0."""
    ends = np.cumsum(lengths)
    at = np.arange(len(marked)) - np.repeat(ends - lengths, lengths)
    out, key = [], marked
    for n in range(1, order + 1):
        if n > 1:
            longer = np.zeros_like(key)
            longer[1:] = mix(out_raw[:-1] * U64(BASE) + marked[1:])
            key = longer
        out_raw = key
        # The low bits tell the orders apart.
        salted = mix(key ^ U64(n)) | U64(1)
        out.append(np.where(at >= n - 1, salted, U64(0)))
    return out


@dataclass
class Grams:
    """The n-grams of one order in a group: distinct sorted keys, their counts in the group's
    training texts, a place of each, and the number of the key at every place (-1: none)."""
    keys: np.ndarray
    own: np.ndarray
    place: np.ndarray
    at: np.ndarray

    def of(self, values: np.ndarray) -> np.ndarray:
        """Per place, the value of the key there; 0 where there is none."""
        return np.append(values, 0)[self.at]


class Group:
    """The documents of a group and their n-grams of every order."""

    def __init__(self, table: pa.Table, order: int):
        self.docs = opened(table)
        marked, self.lengths = (np.concatenate(x) for x in zip(
            *(_with_marks(part) for part in slices(self.docs))))
        train = np.repeat(~self.docs.column("held").to_numpy(False), self.lengths)
        self.orders = []
        for grams in _ngrams(marked, self.lengths, order):
            some = np.flatnonzero(grams)
            keys, by, first, number = ranked(grams[some])
            at = np.full(len(grams), -1)
            at[some] = number
            own = np.add.reduceat(train[some[by]].astype(np.int64), first) if len(first) else (
                np.zeros(0, np.int64))
            self.orders.append(Grams(keys, own, some[by[first]], at))

    def open_keys(self, n: int, shared: list[np.ndarray]) -> np.ndarray:
        """Which n-grams may be in another group, ``shared`` telling it of shorter ones."""
        grams = self.orders[n - 1]
        if n < 3:
            return np.arange(len(grams.keys))
        there = self.orders[n - 2].of(shared[n - 2])
        return np.flatnonzero(there[grams.place] & there[grams.place - 1])

    def totals(self, answer: pa.Table, orders: int, buckets: int
               ) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Per order: the corpus's counts of the keys, and which another group has."""
        counts, shared = [], []
        for n in range(1, orders + 1):
            grams, asked = self.orders[n - 1], self.open_keys(n, shared)
            total, mark = grams.own.copy(), np.zeros(len(grams.keys), bool)
            total[asked], mark[asked] = told(answer, n - 1, grams.keys[asked],
                                             grams.own[asked], buckets)
            counts.append(total)
            shared.append(mark)
        return counts, shared

    def asks(self, group: int, n: int, shared: list[np.ndarray], buckets: int) -> list[tuple]:
        grams, asked = self.orders[n - 1], self.open_keys(n, shared)
        return list(cells(group, n - 1, grams.keys[asked], grams.own[asked], buckets))


class Automaton:
    """States and arcs over the n-grams that a group's documents can reach."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, tokens: int, types: int,
                 prior: float):
        self.keys, self.counts, self.prior = keys, counts, prior
        self.floor = tokens + types + 1.0

    def count(self, grams: np.ndarray) -> np.ndarray:
        """Training counts; 0 where there is no n-gram."""
        if not len(self.keys):
            return np.zeros(len(grams), np.int64)
        at = np.minimum(np.searchsorted(self.keys, grams), len(self.keys) - 1)
        return np.where(self.keys[at] == grams, self.counts[at], 0)

    def traverse(self, grams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Per place: the count of its token, and the token's log10 probability."""
        return follow([(self.count(g), g != 0) for g in grams], self.floor, self.prior)


def follow(counts: list[tuple[np.ndarray, np.ndarray]], floor: float, prior: float
           ) -> tuple[np.ndarray, np.ndarray]:
    """``Automaton.traverse`` of places whose n-grams' counts are known: per order the counts,
    and where there is an n-gram."""
    before = single = counts[0][0]
    chance = (single + 1.0) / floor
    for here, there in counts[1:]:
        state = np.zeros(len(here))
        state[1:] = before[:-1]  # of the context, one place to the left
        state[~there] = 0
        seen = state > 0
        chance = np.where(seen, (here + prior * chance) / (state + prior), chance)
        before = here
    return single, np.log10(chance)


def vocabulary(docs: DataFrame) -> tuple[int, int]:
    """Tokens and distinct tokens of the training documents (held rows left out)."""
    total = docs.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    buckets = max(8, -(-total // (16 << 20)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = np.sort(np.concatenate([np.zeros(0, U64)] + [np.concatenate((
                words_of(part.column("text"), lower=True).hashes(),
                np.full(part.num_rows, END))) for part in slices(batch)]))
            first = np.flatnonzero(np.diff(h, prepend=~h[:1]))
            counts = np.diff(np.append(first, len(h)))
            yield from as_batch(list(cells(0, 0, h[first], counts, buckets)),
                                CELLS_SCHEMA).to_batches()

    def merge(table: pa.Table) -> pa.Table:
        keys, counts = (np.concatenate(x) for x in zip(
            *(cell_of(value) for value in table.column("cell").to_pylist())))
        return pa.table({"tokens": [int(counts.sum())], "types": [len(ranked(keys)[0])]})

    asks = docs.filter("NOT held").select("text").mapInArrow(scan, CELLS)
    found = asks.groupBy("bucket").applyInArrow(merge, "tokens long, types long")
    sums = found.agg(F.sum("tokens"), F.sum("types")).first()
    return sums[0] or 0, sums[1] or 0


def score(docs: DataFrame, order: int = ORDER, prior: float = PRIOR) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score
    and score."""
    held = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))),
                  F.lit(7)) == 2
    rows, groups = in_groups(docs, held.alias("held"))
    rows, buckets = packed_groups(rows), max(8, groups // 2)
    tokens, types = vocabulary(docs.select(text_or_empty().alias("text"), held.alias("held")))

    def ask_short(key: tuple, table: pa.Table) -> pa.Table:
        group = Group(table, min(order, 2))
        return as_batch([row for n in range(1, min(order, 2) + 1)
                         for row in group.asks(key[0].as_py(), n, [], buckets)], CELLS_SCHEMA)

    def ask_longer(n: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
        def ask(table: pa.Table, answer: pa.Table) -> pa.Table:
            group = Group(table, n)
            _, shared = group.totals(answer, n - 1, buckets)
            return as_batch(group.asks(table.column("grp")[0].as_py(), n, shared, buckets),
                            CELLS_SCHEMA)
        return ask

    def work(table: pa.Table, answer: pa.Table) -> pa.Table:
        group = Group(table, order)
        totals, _ = group.totals(answer, order, buckets)
        single, logs = follow([(g.of(t), g.at >= 0) for g, t in zip(group.orders, totals)],
                              tokens + types + 1.0, prior)
        at = np.cumsum(group.lengths) - group.lengths
        single[at], logs[at] = 0, 0  # start marks are no tokens
        return pa.table({
            "doc_id": group.docs.column("doc_id"), "held_out": group.docs.column("held"),
            "n_tokens": group.lengths - 1,
            "n_known": np.add.reduceat((single > 0).astype(np.int64), at),
            "base_logs": np.add.reduceat(np.log10(single + 1.0), at),
            "score": np.add.reduceat(logs, at)})

    totals = met(rows.groupBy("grp").applyInArrow(ask_short, CELLS))
    for n in range(3, order + 1):
        totals = totals.union(met(per_group(rows, totals, ask_longer(n), CELLS)))
    found = per_group(rows, totals, work, SCORES)
    return found.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base_logs") - F.col("n_tokens") * F.log10(F.lit(float(tokens + types + 1))))
        .alias("base_score"), "score")
