"""SimHash near-duplicates by a Gray-order hierarchical index.

Fingerprints (64 bits of 4-word shingles) are made in the scan, distinct fingerprints are
linked when at most ``bits`` bits differ, and linked fingerprints form components.

Two fingerprints that differ in at most 4 bits agree on one of five bit ranges, so each
distinct fingerprint goes to five groups, one per range and value.  A group with more than
``split_above`` members is dealt again by the ranges of its remaining bits, so that no task
holds a hot group; the result is the same.  In a group fingerprints are sorted by Gray rank.
Leaves of consecutive fingerprints keep the bits all members share (mask and pattern);
inner nodes factor what their leaves share.  A pair of nodes whose shared bits already
differ in more than ``bits`` places is pruned with everything below it; differences grow
on the way down.  Surviving pairs of leaves are compared in blocks, and a group gives the
links of a spanning forest only, never all its pairs.

Null or empty texts: fingerprint zero, linked like any other.  Rows with equal doc_id or
equal text are rows of one fingerprint.  A null doc_id is never a component's smallest; a
component of such rows alone has a null component_id.  Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pulseweave.llm.columns import text_or_empty, written
from pulseweave.llm.components import components

SHINGLE = 4
BITS = 4
LEAF, FAN = 32, 16
SEED = 42


def shingles(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """Hashes of the runs of ``shingle`` words, or of all words when there are fewer."""
    found = text.lower().split()  # bytes: A-Z only, and exactly the word rule's blanks
    if not found:
        return np.zeros(0, np.uint64)
    line = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = min(shingle, len(found))
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[a:b], seed) for a, b in zip(
        starts[:len(found) - n + 1].tolist(), ends[n - 1:].tolist())), np.uint64)


def fingerprint_of(hashes: np.ndarray) -> int:
    """Bit i is set when it is set in over half of the hashes."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 14):
        part = hashes[k:k + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(set_bits.view("<u8")[0])


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Bit i is set when it is set in over half of the shingles' hashes."""
    return fingerprint_of(shingles(text, shingle, seed))


def with_fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, fp) of every row; fp is the fingerprint as a signed long."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            fps = np.fromiter((fingerprint(x.as_buffer().to_pybytes(), shingle)
                               for x in column), np.uint64, len(column))
            yield pa.record_batch([batch.column("doc_id"), batch.column("text_hash"),
                                   pa.array(fps.view(np.int64))],
                                  names=["doc_id", "text_hash", "fp"])

    text = text_or_empty()
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("text_hash"),
                       text.alias("text")).mapInArrow(
        scan, "doc_id long, text_hash long, fp long")


# --- groups ---------------------------------------------------------------------------

def _ranges(low: int, high: int, parts: int) -> list[tuple[int, int]]:
    """``parts`` ranges of near-equal width over bits low to high."""
    edges = [low + (high - low) * k // parts for k in range(parts + 1)]
    return list(zip(edges, edges[1:]))


def _bits(fp: Column, low: int, high: int) -> Column:
    return F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << (high - low)) - 1).cast("long"))


def _compact(fp: Column, low: int, high: int) -> Column:
    """The bits outside low to high, moved together."""
    return F.shiftleft(F.shiftrightunsigned(F.shiftrightunsigned(fp, high - 1), 1), low) \
        .bitwiseOR(_bits(fp, 0, low)) if low else F.shiftrightunsigned(fp, high)


def grouped(fps: DataFrame, bits: int, split_above: int) -> DataFrame:
    """(fp, group): rows that may lie within ``bits`` share a group."""
    parts = _ranges(0, 64, bits + 1)
    first = fps.select("fp", F.explode(F.array(*[F.struct(
        F.lit(k).alias("part"), _bits(F.col("fp"), a, b).alias("value"),
        _compact(F.col("fp"), a, b).alias("rest")) for k, (a, b) in enumerate(parts)]))
        .alias("g")).select("fp", "g.*")
    hot = (first.groupBy("part", "value").agg(F.count("*").alias("n"))
           .filter(F.col("n") > split_above).select("part", "value", F.lit(True).alias("hot")))
    known = first.join(hot, ["part", "value"], "left")
    # What is left has 51 or 52 bits; all of them are in one of the ranges.
    again = _ranges(0, 52, bits + 1)
    sub = F.when(F.col("hot"), F.array(*[F.struct(
        F.lit(k).alias("part2"), _bits(F.col("rest"), a, b).alias("value2"))
        for k, (a, b) in enumerate(again)])).otherwise(F.array(F.struct(
            F.lit(-1).alias("part2"), F.lit(0).cast("long").alias("value2"))))
    dealt = known.select("fp", "part", "value", F.explode(sub).alias("s"))
    return dealt.select("fp", F.xxhash64("part", "value", "s.part2", "s.value2").alias("group"))


# --- the index in a group -------------------------------------------------------------

def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of a bit pattern in Gray order."""
    for s in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(s))
    return x


def _factor(pattern: np.ndarray, mask: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes over ``size`` consecutive nodes: the bits that all of them share."""
    at = np.arange(0, len(pattern), size)
    ones = np.bitwise_and.reduceat(pattern, at)
    zeros = np.bitwise_and.reduceat(~pattern, at)
    known = np.bitwise_and.reduceat(mask, at)
    return ones, (ones | zeros) & known


def _pairs_of_children(a: np.ndarray, b: np.ndarray, fan: int, n: int):
    """Child pairs of node pairs (a <= b), each unordered pair once."""
    i = np.repeat(a * fan, fan * fan) + np.tile(np.repeat(np.arange(fan), fan), len(a))
    j = np.repeat(b * fan, fan * fan) + np.tile(np.tile(np.arange(fan), fan), len(b))
    ok = (i < n) & (j < n) & (i <= j)
    return i[ok], j[ok]


def close_pairs(fps: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of index pairs of ``fps`` (sorted by Gray rank) at ``bits`` or less."""
    every = np.full(len(fps), ~np.uint64(0))
    levels = [(fps, every)]
    for size in (LEAF, *[FAN] * 16):
        if len(levels[-1][0]) == 1:
            break
        levels.append(_factor(*levels[-1], size))
    stack = [(len(levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        level, a, b = stack.pop()
        pattern, mask = levels[level]
        apart = np.bitwise_count((pattern[a] ^ pattern[b]) & mask[a] & mask[b])
        keep = apart <= bits
        a, b = a[keep], b[keep]
        if not len(a):
            continue
        if level == 0:
            ok = a != b
            yield a[ok], b[ok]
            continue
        fan = LEAF if level == 1 else FAN
        step = max(1, (1 << 17) // (fan * fan))
        for k in range(0, len(a), step):
            stack.append((level - 1, *_pairs_of_children(
                a[k:k + step], b[k:k + step], fan, len(levels[level - 1][0]))))


def _forest(n: int, blocks: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The least index that each of 0 .. n-1 is linked to by the pairs."""
    root = np.arange(n)
    for a, b in blocks:
        while len(a):
            ra, rb = root[a], root[b]
            apart = ra != rb
            if not apart.any():
                break
            low, high = np.minimum(ra, rb)[apart], np.maximum(ra, rb)[apart]
            np.minimum.at(root, high, low)
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root = up
            a, b = a[apart], b[apart]
    return root


def group_forest(fps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the links that join the components of one group, one fewer than members in
    each."""
    order = np.arange(len(fps))
    if len(fps) <= LEAF:
        i, j = np.triu_indices(len(fps), 1)
        near = np.bitwise_count(fps[i] ^ fps[j]) <= bits
        blocks = iter([(i[near], j[near])])
    else:
        order = np.argsort(gray_rank(fps), kind="stable")
        blocks = close_pairs(fps[order], bits)
    root = _forest(len(fps), blocks)
    linked = np.flatnonzero(root != np.arange(len(fps)))
    return order[linked], order[root[linked]]


def group_links(fps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprints at the ends of each link of ``group_forest``."""
    a, b = group_forest(fps, bits)
    return fps[a], fps[b]


def links(fps: DataFrame, bits: int = BITS, split_above: int = 20_000) -> DataFrame:
    """Edges (a, b) whose components are those of all links of distinct ``fps``."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted by group; a group may go on in the next batch.
        held = [np.zeros(0, np.int64), np.zeros(0, np.uint64)]

        def join(group: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            edges = np.flatnonzero(np.diff(group)) + 1
            out_a, out_b = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
            starts, ends = np.concatenate(([0], edges)), np.concatenate((edges, [len(group)]))
            size = ends - starts
            pair = starts[size == 2]
            near = pair[np.bitwise_count(fp[pair] ^ fp[pair + 1]) <= bits]
            out_a.append(fp[near])
            out_b.append(fp[near + 1])
            for s, e in zip(starts[size > 2], ends[size > 2]):
                a, b = group_links(fp[s:e], bits)
                out_a.append(a)
                out_b.append(b)
            return pa.record_batch([pa.array(np.concatenate(x).view(np.int64))
                                    for x in (out_a, out_b)], names=["a", "b"])

        for batch in batches:
            group = np.concatenate((held[0], batch.column("group").to_numpy()))
            fp = np.concatenate((held[1], batch.column("fp").to_numpy().view(np.uint64)))
            cut = np.searchsorted(group, group[-1]) if len(group) else 0
            if cut:
                yield join(group[:cut], fp[:cut])
            held = [group[cut:], fp[cut:]]
        if len(held[0]):
            yield join(*held)

    dealt = grouped(fps, bits, split_above).repartition("group").sortWithinPartitions("group")
    return dealt.mapInArrow(scan, "a long, b long").distinct()


def _classes(rows: DataFrame, bits: int) -> DataFrame:
    """Per distinct fingerprint of ``rows``: its component and the component's first row."""
    classes = rows.groupBy("fp").agg(F.min(F.when(
        F.col("doc_id").isNotNull(), F.struct("doc_id", "text_hash"))).alias("least"))
    labels = components(rows.sparkSession, links(classes.select("fp"), bits))
    labelled = (classes.join(labels, F.col("fp") == F.col("node"), "left")
                .select("fp", "least", F.coalesce("label", "fp").alias("label")))
    firsts = labelled.groupBy("label").agg(F.min("least").alias("first"))
    return labelled.join(firsts, "label").select("fp", "label", "first")


def near_duplicates(spark: SparkSession, docs: DataFrame, bits: int = BITS,
                    shingle: int = SHINGLE) -> DataFrame:
    """Per row of ``docs``: doc_id, fingerprint (16 hex digits) and component_id."""
    rows = written(spark, with_fingerprints(docs, shingle), "fingerprints")
    return (rows.join(_classes(rows, bits), "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    F.col("first.doc_id").alias("component_id")))


def keep_one(spark: SparkSession, docs: DataFrame, bits: int = BITS,
             shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest doc_id (of
    several, the one with the smallest text hash), and of rows repeated whole in both one.
    Rows with a null doc_id stay."""
    rows = written(spark, with_fingerprints(docs, shingle), "fingerprints")
    firsts = _classes(rows, bits).select("first.*").filter("doc_id IS NOT NULL").distinct()
    return _only(docs, firsts)


def _only(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """Rows of ``docs`` named in ``firsts`` (doc_id, text_hash), once, and those without id."""
    whole = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"),
                        F.xxhash64(text_or_empty()).alias("hash"))
    unknown = whole.filter("id IS NULL").select("row")
    same = (F.col("id") == F.col("doc_id")) & (F.col("hash") == F.col("text_hash"))
    kept = (whole.filter("id IS NOT NULL").join(firsts, same)
            .groupBy("id", "hash").agg(F.first("row").alias("row")).select("row"))
    return kept.union(unknown).select(*[F.col("row")[c].alias(c) for c in docs.columns])
