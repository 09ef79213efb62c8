"""The pipeline's near-copy stage: SimHash candidates, verified by exact shingle similarity.

Two texts are near when the Jaccard similarity of their sets of five-word shingles is
``share`` or more (texts of fewer words have one shingle, all of them).  Such pairs differ in
about 10 of 64 SimHash bits, and up to 20: bit ranges would have to be 3 bits wide for
that, so fingerprints are dealt by bands of min-hashes of the same shingles instead.
At 0.8 a pair misses all 20 bands of 5 with probability 0.0004 (and is found as below).

Texts of one set of shingles are one class.  In a group, classes whose fingerprints differ in
at most ``bits`` bits are joined, found by the Gray-order hierarchical index of ``simhash``;
joined classes form candidate components.  Near pairs that no band brings together, or whose
fingerprints differ in more bits, are found by an exact join (``missed``): of near sets the
first shingles in one order, a fifth of the set and one more, share one.  It reads every set,
pairs only classes of different candidate components, and drops a pair by bounds that no near
pair exceeds (sizes, places of the shared shingle, parities of the sets).  What it finds joins
the components.  In each of them all pairs are judged by their sets, so that a pair is linked
only if it is near, and every near pair is judged.  The search walks from linked classes to
those not yet linked and so compares a dense cluster with few of its members.  A candidate
component is one task's: its texts must fit there.

Shingles come in order of their hashes.  One whose classes would give over ``GROUP`` squared
ordered pairs is set aside, and the classes that have such a shingle among their first ones
come again in an order with all of these last, until there are no new ones or after ``ROUNDS``
rounds; then all pairs are made, in blocks.  The driver holds the shingles that were set aside,
at most one for ``GROUP`` rows.

Null or empty texts are one class.  Rows with equal doc_id or equal text are rows of one
class.  A null doc_id links others but is never a component's first.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from pulseweave.llm import simhash
from pulseweave.llm.columns import text_or_empty, written
from pulseweave.llm.components import components
from pulseweave.llm.tokens import BASE, U64, mix

SHINGLE = 5
SHARE = 0.8
BITS = 20
BANDS, ROWS = 20, 5
GROUP, ROUNDS = 256, 4
BLOCK = 1 << 18
LAST = (1 << 63) - 1
FACTORS = mix(np.arange(1, BANDS * ROWS + 1, dtype=U64) * U64(BASE)) | U64(1)


def shingle_set(text: bytes) -> np.ndarray:
    return np.unique(simhash.shingles(text, SHINGLE))


def bands(found: np.ndarray) -> np.ndarray:
    """A key per band: the ``ROWS`` min-hashes of the band, mixed."""
    least = np.full(len(FACTORS), ~U64(0))
    for k in range(0, len(found), 1 << 12):
        least = np.minimum(least, (found[k:k + (1 << 12), None] * FACTORS).min(axis=0))
    keys = np.zeros(BANDS, U64)
    for column in least.reshape(BANDS, ROWS).T:
        keys = mix(keys * U64(BASE) + column)
    return keys


def walk(n: int, near: Callable[[int, np.ndarray], np.ndarray]) -> np.ndarray:
    """Least member of each of 0..n-1's component; ``near(i, others)`` says which link."""
    root = np.arange(n)
    rest = np.arange(1, n)
    frontier, now = [0], 0
    while len(rest):
        if not frontier:
            now, rest = int(rest[0]), rest[1:]
            frontier = [now]
            continue
        linked = near(frontier.pop(), rest)
        if linked.any():
            root[rest[linked]] = now
            frontier += rest[linked].tolist()
            rest = rest[~linked]
    return root


def similar(sets: list[np.ndarray], share: float) -> np.ndarray:
    """Components of sets of Jaccard similarity ``share`` or more, by exact counts."""
    size = np.array([len(x) for x in sets])
    begin = np.cumsum(size) - size
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
    mark = np.zeros(codes.max(initial=-1) + 1, bool)
    held: list[np.ndarray] = [np.zeros(0, np.int64)] * 3

    def near(i: int, others: np.ndarray) -> np.ndarray:
        if not np.array_equal(held[0], others):
            held[0] = others
            held[1] = np.concatenate([codes[begin[k]:begin[k] + size[k]] for k in others])
            held[2] = np.cumsum(size[others]) - size[others]
        mine = codes[begin[i]:begin[i] + size[i]]
        mark[mine] = True
        both = np.add.reduceat(mark[held[1]].astype(np.int64), held[2])
        mark[mine] = False
        return both >= share * (size[others] + size[i] - both) - 1e-9

    return walk(len(sets), near)


def parity(found: np.ndarray) -> bytes:
    """A bit per value of the hashes' last bits: whether an odd number of them has it.  Sets
    differ in at least as many members as their parities in bits."""
    bits = max(64, 1 << (len(found) - 1).bit_length())
    odd = np.bincount((found & U64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def apart(one: bytes, other: bytes) -> int:
    """In how many bits two parities differ; the longer one is folded."""
    p, q = sorted((np.frombuffer(x, np.uint8) for x in (one, other)), key=len)
    return int(np.bitwise_count(p ^ np.bitwise_xor.reduce(q.reshape(-1, len(p)), axis=0)).sum())


def among(values: np.ndarray, few: np.ndarray) -> np.ndarray:
    """Which ``values`` are in ``few``, which is sorted."""
    if not len(few):
        return np.zeros(len(values), bool)
    return few[np.minimum(np.searchsorted(few, values), len(few) - 1)] == values


def first_ones(found: np.ndarray, share: float, last: np.ndarray) -> np.ndarray:
    """The first hashes of a set, those in ``last`` (sorted) after all others: a set of
    similarity ``share`` or more has one of them among its own.  None if only an equal set
    can be that near."""
    n = len(found)
    if n < share * (n + 1) - 1e-6:
        return found[:0]
    if len(last):
        late = among(found, last)
        found = np.concatenate((found[~late], found[late]))
    return found[:n - math.ceil(share * n - 1e-6) + 1]


def set_id(found: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(found.tobytes())


def sketches(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, text_hash, set_id, fingerprint, size and parity of the set, and band
    keys (none without words)."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, fps, sizes, odd, keys = [], [], [], [], []
            for x in batch.column("text"):
                hashes = simhash.shingles(x.as_buffer().to_pybytes(), SHINGLE)
                found = np.unique(hashes)
                ids.append(set_id(found))
                sizes.append(len(found))
                odd.append(parity(found))
                # Of the set, so that the classes of a set have one fingerprint.
                fps.append(simhash.fingerprint_of(found))
                keys.append(bands(found).view(np.int64) if len(found) else [])
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("text_hash"),
                 *[pa.array(np.array(x, U64).view(np.int64)) for x in (ids, fps)],
                 pa.array(sizes, pa.int64()), pa.array(odd, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "text_hash", "set_id", "fp", "size", "parity", "bands"])

    text = text_or_empty()
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("text_hash"),
                       text.alias("text")).mapInArrow(
        scan, "doc_id long, text_hash long, set_id long, fp long, size long, parity binary, "
        "bands array<long>")


def candidates(classes: DataFrame, bits: int = BITS) -> DataFrame:
    """Edges (a, b) between set ids of one band group at ``bits`` or less: a forest."""
    def join(ids: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # Equal fingerprints are linked to one of them, and these by the Gray-order index.
        distinct, first, same = np.unique(fps.view(U64), return_index=True, return_inverse=True)
        copies = np.flatnonzero(first[same] != np.arange(len(ids)))
        a, b = simhash.group_forest(distinct, bits)
        return (np.concatenate((ids[copies], ids[first[a]])),
                np.concatenate((ids[first[same[copies]]], ids[first[b]])))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted by group; a group may go on in the next batch.
        held = [np.zeros(0, np.int64)] * 3

        def out(group: np.ndarray, ids: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            edges = np.flatnonzero(np.diff(group)) + 1
            starts, ends = np.concatenate(([0], edges)), np.concatenate((edges, [len(group)]))
            many = ends - starts > 1
            a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for s, e in zip(starts[many], ends[many]):
                x, y = join(ids[s:e], fps[s:e])
                a.append(x)
                b.append(y)
            return pa.record_batch([pa.array(np.concatenate(x)) for x in (a, b)],
                                   names=["a", "b"])

        for batch in batches:
            held = [np.concatenate((h, batch.column(c).to_numpy()))
                    for h, c in zip(held, ("group", "set_id", "fp"))]
            cut = np.searchsorted(held[0], held[0][-1]) if len(held[0]) else 0
            if cut:
                yield out(*[h[:cut] for h in held])
            held = [h[cut:] for h in held]
        if len(held[0]):
            yield out(*held)

    dealt = (classes.select("set_id", "fp", F.posexplode("bands"))
             .select("set_id", "fp", F.xxhash64("pos", "col").alias("group"))
             .repartition("group").sortWithinPartitions("group"))
    return dealt.mapInArrow(scan, "a long, b long").distinct()


def firsts(docs: DataFrame, share: float, last: np.ndarray, before: np.ndarray) -> DataFrame:
    """(set_id, size, shingles) of the sets that have a different near one, if any, with the
    first shingles of the order in which those in ``last`` come last.  After the first round
    only sets with one of these among the first of the order by ``before``."""
    new = np.setdiff1d(last, before)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[int, tuple[int, np.ndarray]] = {}
            for x in batch.column("text"):
                found = shingle_set(x.as_buffer().to_pybytes())
                own = first_ones(found, share, before)
                if len(own) and (not len(last) or among(own, new).any()):
                    out[set_id(found)] = (len(found), first_ones(found, share, last).view(np.int64))
            yield pa.record_batch(
                [pa.array(np.fromiter(out, U64, len(out)).view(np.int64)),
                 pa.array([n for n, _ in out.values()], pa.int64()),
                 pa.array([own for _, own in out.values()], pa.list_(pa.int64()))],
                names=["set_id", "size", "shingles"])

    return docs.select(text_or_empty().alias("text")).mapInArrow(
        scan, "set_id long, size long, shingles array<long>")


def pairs_of(rows: np.ndarray, share: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of places (i, j) of one shingle's ``rows`` (set_id, label, size, at) with
    different labels that may be near if this is the first shingle they share."""
    _, label, size, at = rows
    order = np.argsort(size, kind="stable")
    label, size, left = label[order], size[order], (size - at)[order]
    # Sizes at most so much larger; sorted, these are a stretch.
    ends = np.searchsorted(size, size / share + 1e-6, side="right")
    begin = 0
    while begin < len(size):
        counts = np.cumsum(ends[begin:] - np.arange(begin, len(size)) - 1)
        end = begin + max(1, int(np.searchsorted(counts, BLOCK, side="right")))
        many = ends[begin:end] - np.arange(begin, end) - 1
        i = np.repeat(np.arange(begin, end), many)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(many) - many, many)
        both = np.minimum(left[i], left[j])
        ok = (label[i] != label[j]) & (both * (1 + share) >= share * (size[i] + size[j]) - 1e-6)
        yield order[i[ok]], order[j[ok]]
        begin = end


def shared(rows: DataFrame, share: float, last: np.ndarray, force: bool) -> DataFrame:
    """(a, b, aside) of ``rows`` (shingle, set_id, label, size, at): pairs of sets that have a
    first shingle in common, or (shingle, null, true) for one that is set aside."""
    names = ["shingle", "set_id", "label", "size", "at"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted by shingle; the rows of one may go on in the next batch.
        def out(a: np.ndarray, b: np.ndarray | None) -> pa.RecordBatch:
            return pa.record_batch(
                [pa.array(a), pa.nulls(len(a), pa.int64()) if b is None else pa.array(b),
                 pa.array(np.full(len(a), b is None))], names=["a", "b", "aside"])

        def groups(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            held = np.concatenate(parts, axis=1)
            edges = np.flatnonzero(np.diff(held[0])) + 1
            starts = np.concatenate(([0], edges))
            ends = np.concatenate((edges, [held.shape[1]]))
            # Most have two rows, and these are looked at together.
            i, many = starts[ends - starts == 2], ends - starts > 2
            _, _, label, size, at = held
            left = size - at
            i = i[(label[i] != label[i + 1])
                  & (np.minimum(left[i], left[i + 1]) * (1 + share)
                     >= share * (size[i] + size[i + 1]) - 1e-6)]
            found = [np.sort(np.stack((held[1, i], held[1, i + 1])), axis=0)]
            aside, waiting = [], len(i)
            for s, e in zip(starts[many], ends[many]):
                key, ids, label = held[0, s], held[1, s:e], held[2, s:e]
                alike = np.unique(label, return_counts=True)[1].astype(float)
                if len(alike) == 1:
                    continue
                if (len(label) ** 2 - (alike ** 2).sum() > GROUP ** 2 and not force
                        and not among(held[0, s:s + 1].view(U64), last).any()):
                    aside.append(key)
                    continue
                for i, j in pairs_of(held[1:, s:e], share):
                    found.append(np.stack((np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j]))))
                    waiting += len(i)
                    if waiting > BLOCK:
                        yield out(*np.unique(np.concatenate(found, axis=1), axis=1))
                        found, waiting = [], 0
            if waiting:
                yield out(*np.unique(np.concatenate(found, axis=1), axis=1))
            if aside:
                yield out(np.array(aside), None)

        held: list[np.ndarray] = []
        for batch in batches:
            rows = np.stack([batch.column(c).to_numpy() for c in names])
            if not rows.shape[1]:
                continue
            cut = int(np.searchsorted(rows[0], rows[0, -1]))
            if held and (cut or held[0][0, 0] != rows[0, 0]):
                yield from groups([*held, rows[:, :cut]])
                held, rows = [], rows[:, cut:]
            elif cut:
                yield from groups([rows[:, :cut]])
                rows = rows[:, cut:]
            held.append(rows)
        if held:
            yield from groups(held)

    dealt = rows.select(names).repartition("shingle").sortWithinPartitions("shingle")
    return dealt.mapInArrow(scan, "a long, b long, aside boolean").distinct()


def missed(spark: SparkSession, docs: DataFrame, classes: DataFrame, found: DataFrame,
           share: float = SHARE) -> DataFrame:
    """Pairs (a, b) of set ids in different components of ``found`` (node, label): all that are
    near, and few others."""
    last = before = np.zeros(0, U64)
    pairs = None
    for k in range(ROUNDS):
        rows = (firsts(docs, share, last, before)
                .join(found.withColumnRenamed("node", "set_id"), "set_id", "left")
                .select("set_id", F.coalesce("label", "set_id").alias("label"), "size",
                        F.posexplode("shingles").alias("at", "shingle")))
        rows = rows.select("shingle", "set_id", "label", "size", F.col("at").cast("long"))
        now = written(spark, shared(rows, share, last, k == ROUNDS - 1), "shared-shingles")
        new = np.array([r.a for r in now.filter("aside").collect()], np.int64).view(U64)
        found_now = now.filter("NOT aside").select("a", "b")
        pairs = found_now if pairs is None else pairs.union(found_now)
        if not len(new):
            break
        before, last = last, np.union1d(last, new)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = sum(batch.column(c).to_numpy() for c in ("size_a", "size_b"))
            odd = np.fromiter((apart(x.as_py(), y.as_py()) for x, y in zip(
                batch.column("parity_a"), batch.column("parity_b"))), np.int64, len(size))
            ok = pa.array(odd * (1 + share) <= (1 - share) * size + 1e-6)
            yield batch.select(["a", "b"]).filter(ok)

    rows = pairs.distinct()
    for c in ("a", "b"):
        rows = rows.join(classes.select(F.col("set_id").alias(c), F.col("size").alias(f"size_{c}"),
                                        F.col("parity").alias(f"parity_{c}")), c)
    return written(spark, rows.mapInArrow(near, "a long, b long"), "missed")


def labels(spark: SparkSession, docs: DataFrame, classes: DataFrame,
           share: float = SHARE) -> DataFrame:
    """(set_id, label) of every class that may have a near one."""
    found = components(spark, candidates(classes))
    rest = missed(spark, docs, classes, found, share)
    if not rest.isEmpty():
        found = components(spark, found.select(F.col("node").alias("a"), F.col("label").alias("b"))
                           .union(rest))
    wanted = classes.join(found, F.col("set_id") == F.col("node")).select(
        "set_id", "label", F.col("any.id").alias("id"), F.col("any.text_hash").alias("text_hash"))
    text = text_or_empty()
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("id"),
                        F.xxhash64(text).alias("text_hash"), text.alias("text"))
    members = (texts.join(wanted, ["id", "text_hash"]).groupBy("set_id", "label")
               .agg(F.first("text").alias("text")))

    def judge(table: pa.Table) -> pa.Table:
        table = table.sort_by("set_id")
        sets = [shingle_set(x.as_buffer().to_pybytes()) for x in table.column("text")]
        ids = table.column("set_id").to_numpy()
        return pa.table({"set_id": ids, "label": ids[similar(sets, share)]})

    return members.groupBy("label").applyInArrow(judge, "set_id long, label long")


def keep_one(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with the row of smallest doc_id (of several, smallest text hash) of each
    component of near texts.  Rows with a null doc_id stay."""
    at = F.struct("doc_id", "text_hash")
    classes = written(spark, sketches(docs).groupBy("set_id").agg(
        F.min(F.when(F.col("doc_id").isNotNull(), at)).alias("least"),
        F.min(F.struct(F.coalesce("doc_id", F.lit(LAST)).alias("id"), "text_hash")).alias("any"),
        *[F.first(c).alias(c) for c in ("fp", "size", "parity", "bands")]), "near-classes")
    kept = (classes.select("set_id", "least").join(labels(spark, docs, classes), "set_id", "left")
              .groupBy(F.coalesce("label", "set_id").alias("label"))
              .agg(F.min("least").alias("first")).select("first.*")
              .filter("doc_id IS NOT NULL"))
    return simhash._only(docs, kept)
