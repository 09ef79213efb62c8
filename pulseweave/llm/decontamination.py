"""Benchmark decontamination by greedy string tiling.

Tokens are runs of letters and digits in lower case.  Seeds, the ``min_match``-token runs
of the benchmark items, are joined with those of every document: items are taken in blocks
of at most ``block_tokens`` tokens, whose sorted seeds go to the tasks (a size fixed by that
parameter), and documents stream past them without a shuffle.  More items make more blocks.

A document and an item that share a seed are tiled: the longest run of tokens that both
still have unmarked is found through its seeds, its occurrences by Karp-Rabin hashes of
that length, and non-overlapping ones are marked; so on down to ``min_match``.  The item's
share of marked tokens is its coverage, whatever the order of the parts; a document with an
item covered to ``threshold`` is contaminated.

Items with fewer than ``min_match`` tokens cannot be told from ordinary text and match
nothing.  Null or empty texts and items match nothing.  A null item_id counts as an item
and is not listed.  Repeated rows are judged alike.  Empty benchmark: nothing matches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from pulseweave.llm.columns import text_or_empty
from pulseweave.llm.line_dedup import RangeHash
from pulseweave.llm.tokens import NOT_ALNUM, U64, grams, same_text, slices, words_of

FILTER_BITS = 20


@dataclass(frozen=True)
class Tiling:
    min_match: int = 5
    threshold: float = 0.5
    block_tokens: int = 1_000_000


@dataclass
class Block:
    """Some items: token hashes one item after the other, and sorted seeds."""
    ids: list
    tokens: np.ndarray
    first: np.ndarray
    seeds: np.ndarray
    seed_at: np.ndarray
    maybe: np.ndarray


def make_block(ids: list, texts: list[str], rule: Tiling) -> Block:
    words = words_of(pa.array(texts, pa.large_string()), parting=NOT_ALNUM)
    h = words.hashes()
    runs = grams(h, rule.min_match)
    at = np.flatnonzero(same_text(words.first, rule.min_match))
    order = np.argsort(runs[at], kind="stable")
    maybe = np.zeros(1 << FILTER_BITS, bool)
    maybe[(runs[at] >> U64(64 - FILTER_BITS)).astype(np.int64)] = True
    return Block(ids, h, words.first, runs[at][order], at[order], maybe)


def blocks(benchmark: DataFrame, rule: Tiling) -> Iterator[Block]:
    """Blocks of items in item_id order, read one partition at a time."""
    ids, texts, size = [], [], 0
    rows = benchmark.select("item_id", F.lower(text_or_empty()).alias("text")) \
        .orderBy("item_id", "text")
    for row in rows.toLocalIterator():
        n = len(row.text.split()) + row.text.count("-")
        if texts and size + n > rule.block_tokens:
            yield make_block(ids, texts, rule)
            ids, texts, size = [], [], 0
        ids.append(row.item_id)
        texts.append(row.text)
        size += n
    if texts:
        yield make_block(ids, texts, rule)


def _longest(pairs: np.ndarray, free_a: np.ndarray, free_b: np.ndarray, m: int) -> int:
    """Longest run that two sequences share on unmarked places, given its seed pairs."""
    if not len(pairs):
        return 0
    clear_a = np.concatenate(([0], np.cumsum(~free_a)))
    clear_b = np.concatenate(([0], np.cumsum(~free_b)))
    i, j = pairs[:, 0], pairs[:, 1]
    ok = (clear_a[i + m] == clear_a[i]) & (clear_b[j + m] == clear_b[j])
    i, j = i[ok], j[ok]
    if not len(i):
        return 0
    order = np.lexsort((i, j - i))
    i, diagonal = i[order], (j - i)[order]
    fresh = np.ones(len(i), bool)
    fresh[1:] = (np.diff(i) != 1) | (np.diff(diagonal) != 0)
    runs = np.diff(np.append(np.flatnonzero(fresh), len(i)))
    return int(runs.max()) + m - 1


def tile(a: np.ndarray, b: np.ndarray, pairs: np.ndarray, m: int) -> np.ndarray:
    """Which tokens of ``a`` greedy tiling against ``b`` marks; ``pairs`` are the places
    (in a, in b) of shared runs of ``m`` tokens."""
    free_a, free_b = np.ones(len(a), bool), np.ones(len(b), bool)
    hash_a, hash_b = RangeHash(a, 3), RangeHash(b, 3)
    while (n := _longest(pairs, free_a, free_b, m)) >= m:
        at_a, at_b = np.arange(len(a) - n + 1), np.arange(len(b) - n + 1)
        clear_a = np.concatenate(([0], np.cumsum(~free_a)))
        clear_b = np.concatenate(([0], np.cumsum(~free_b)))
        at_a = at_a[clear_a[at_a + n] == clear_a[at_a]]
        at_b = at_b[clear_b[at_b + n] == clear_b[at_b]]
        places: dict[int, list[int]] = {}
        for j, h in zip(at_b.tolist(), hash_b.of(at_b, at_b + n).tolist()):
            places.setdefault(h, []).append(j)
        for i, h in zip(at_a.tolist(), hash_a.of(at_a, at_a + n).tolist()):
            for j in places.get(h, ()):
                if not free_a[i:i + n].all():
                    break
                if free_b[j:j + n].all() and (a[i:i + n] == b[j:j + n]).all():
                    free_a[i:i + n] = free_b[j:j + n] = False
    return ~free_a


def coverages(texts: pa.Array, block: Block, rule: Tiling) -> list[dict[int, float]]:
    """Per text the items that share a seed with it, by index in the block, and their
    coverage."""
    found: list[dict[int, float]] = [{} for _ in range(len(texts))]
    m = rule.min_match
    words = words_of(texts, parting=NOT_ALNUM)
    h = words.hashes()
    runs = grams(h, m)
    at = np.flatnonzero(block.maybe[(runs >> U64(64 - FILTER_BITS)).astype(np.int64)]
                        & same_text(words.first, m))
    low = np.searchsorted(block.seeds, runs[at], "left")
    high = np.searchsorted(block.seeds, runs[at], "right")
    hit = high > low
    at, low, high = at[hit], low[hit], high[hit]
    if not len(at):
        return found
    n = high - low
    doc_at = np.repeat(at, n)
    seed = np.arange(n.sum()) + np.repeat(low - (np.cumsum(n) - n), n)
    item_at = block.seed_at[seed]
    text = np.searchsorted(words.first, doc_at, "right") - 1
    item = np.searchsorted(block.first, item_at, "right") - 1
    order = np.lexsort((item, text))
    key = text[order] * len(block.ids) + item[order]
    edges = np.flatnonzero(np.diff(key)) + 1
    for part in np.split(order, edges):
        t, k = int(text[part[0]]), int(item[part[0]])
        a0, b0 = block.first[k], words.first[t]
        a, b = block.tokens[a0:block.first[k + 1]], h[b0:words.first[t + 1]]
        pairs = np.stack((item_at[part] - a0, doc_at[part] - b0), axis=1)
        # Places of b that share no seed cannot be in a tile.
        found[t][k] = float(tile(a, b, pairs, m).sum()) / len(a)
    return found


REPORT = "doc_id long, text_hash long, coverage double, item_ids array<long>, n_items long"


def _report(docs: DataFrame, block: Block, rule: Tiling) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = coverages(part.column("text"), block, rule)
                leaked = [[k for k, c in f.items() if c >= rule.threshold] for f in found]
                yield pa.record_batch([
                    part.column("doc_id"), part.column("text_hash"),
                    pa.array([max(f.values(), default=0.0) for f in found], pa.float64()),
                    pa.array([sorted(block.ids[k] for k in x if block.ids[k] is not None)
                              for x in leaked], pa.list_(pa.int64())),
                    pa.array([len(x) for x in leaked], pa.int64())],
                    names=["doc_id", "text_hash", "coverage", "item_ids", "n_items"])

    text = text_or_empty()
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("text_hash"),
                       F.lower(text).alias("text")).mapInArrow(scan, REPORT)


def contamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame,
                  rule: Tiling = Tiling()) -> DataFrame:
    """Per row of ``docs``: doc_id, coverage (the highest of an item), item_ids and n_items
    (covered to the threshold), contaminated."""
    parts = [_report(docs, b, rule) for b in blocks(benchmark.select(
        F.col("item_id").cast("long"), "text"), rule)]
    if not parts:
        parts = [_report(docs, make_block([], [], rule), rule)]
    found = parts[0]
    if len(parts) > 1:
        # One row per row of docs and block: identical rows of docs are counted apart.
        for p in parts[1:]:
            found = found.union(p)
        found = (found.groupBy("doc_id", "text_hash")
                 .agg(F.max("coverage").alias("coverage"),
                      F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids"))))
                      .alias("item_ids"), F.sum("n_items").alias("n"), F.count("*").alias("rows"))
                 .withColumn("copies", F.col("rows") / len(parts))
                 .withColumn("n_items", (F.col("n") / F.col("copies")).cast("long"))
                 .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))))
    return found.select("doc_id", "coverage", "item_ids", "n_items",
                        (F.col("n_items") > 0).alias("contaminated"))


def clean(spark: SparkSession, docs: DataFrame, benchmark: DataFrame,
          rule: Tiling = Tiling()) -> DataFrame:
    """``docs`` without contaminated documents."""
    left = docs.select(F.lower(text_or_empty()).alias("text"), F.struct("*").alias("row"))
    for block in blocks(benchmark.select(F.col("item_id").cast("long"), "text"), rule):
        def scan(batches: Iterator[pa.RecordBatch], block: Block = block) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch):
                    found = coverages(part.column("text"), block, rule)
                    yield part.filter(pa.array([
                        not any(c >= rule.threshold for c in f.values()) for f in found], pa.bool_()))
        left = left.mapInArrow(scan, left.schema)
    return left.select(*[F.col("row")[c].alias(c) for c in docs.columns])
