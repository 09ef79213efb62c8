"""Corpus statistics for Python operators: groups of documents ask, buckets of keys answer.

Documents are dealt into groups of bounded bytes.  A group sends its distinct keys with
its own counts, packed per bucket of the key space; a bucket sums each key over all groups
and sends a total back to the groups that have the key and do not know the total already.
A key that every document holds is one entry per group; nothing is sent per pair.
Group and bucket numbers follow the corpus size, so that no task grows with it.

``packed_groups``, ``cells``, ``met`` and ``told`` are a smaller form of the same exchange: texts
travel compressed by group, a cell of keys and counts is one compressed value, and an answer
marks by a bit per key whether another group has it, with the totals of those keys.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pulseweave.llm.columns import text_or_empty
from pulseweave.llm.tokens import U64, rebyte, slices, unbyte

GROUP_BYTES = 4 << 20

ASKED = "bucket int, grp int, keys binary, counts binary"
ANSWERED = "grp int, bucket int, places binary, counts binary"


def in_groups(docs: DataFrame, *extra: Column, group_bytes: int = GROUP_BYTES) -> tuple[DataFrame, int]:
    """(grp, doc_id, text_hash, text, extra) dealt by group, and the number of groups."""
    total = docs.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    groups = max(8, -(-total // group_bytes))
    text = text_or_empty()
    rows = docs.select(
        F.pmod(F.xxhash64("doc_id", text), F.lit(groups)).cast("int").alias("grp"),
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
        text.alias("text"), *extra)
    return rows, groups


def pack(keys: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    """Sorted keys (or places) and counts, each byte by byte so that zero bytes compress."""
    low = counts.astype("<u8").view(np.uint8).reshape(-1, 8).T
    return unbyte(keys.astype(np.uint64)), low.tobytes()


def unpack(keys: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(counts, np.uint8).reshape(8, -1).T
    return rebyte(keys), np.ascontiguousarray(raw).view("<u8").ravel().astype(np.int64)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of the counts of each."""
    if not len(keys):
        return keys, counts
    distinct, order, first, _ = ranked(keys)
    return distinct, np.add.reduceat(counts[order], first)


def asked(group: int, keys: np.ndarray, counts: np.ndarray, buckets: int) -> Iterator[tuple]:
    """Rows of ``ASKED`` for a group's distinct sorted keys."""
    bucket = bucket_of(keys, buckets)
    present, first = np.unique(bucket, return_index=True)
    for b, start, end in zip(present.tolist(), first, [*first[1:], len(keys)]):
        yield b, group, *pack(keys[start:end], counts[start:end])


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of the key space, so sorted keys have sorted buckets."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def as_batch(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


ASKED_SCHEMA = pa.schema([("bucket", pa.int32()), ("grp", pa.int32()),
                          ("keys", pa.binary()), ("counts", pa.binary())])
ANSWERED_SCHEMA = pa.schema([("grp", pa.int32()), ("bucket", pa.int32()),
                             ("places", pa.binary()), ("counts", pa.binary())])


def answers(asks: DataFrame) -> DataFrame:
    """Totals per group: those of its keys whose total is not the group's own count.

    A key is named by its place among the group's keys in the bucket, which the group
    knows: a byte or two instead of a hash.
    """
    def merge(key: tuple, table: pa.Table) -> pa.Table:
        parts = [(g, *unpack(k, c)) for g, k, c in zip(
            table.column("grp").to_pylist(), table.column("keys").to_pylist(),
            table.column("counts").to_pylist())]
        keys = np.concatenate([p[1] for p in parts])
        own = np.concatenate([p[2] for p in parts])
        size = np.array([len(p[1]) for p in parts])
        distinct, total = summed(keys, own)
        total = total[np.searchsorted(distinct, keys)]
        rows, at = [], 0
        for (group, _, c), n in zip(parts, size):
            t = total[at:at + n]
            at += n
            tell = np.flatnonzero(t != c)
            if len(tell):
                rows.append((group, key[0].as_py(), *pack(tell, t[tell])))
        return as_batch(rows, ANSWERED_SCHEMA)

    return asks.groupBy("bucket").applyInArrow(merge, ANSWERED)


def known(table: pa.Table, keys: np.ndarray, own: np.ndarray, buckets: int) -> np.ndarray:
    """Totals of a group's distinct sorted keys: the answers, else its own counts."""
    total = own.copy()
    told = table.column("bucket").to_numpy()
    first = np.searchsorted(bucket_of(keys, buckets), told)
    for start, p, c in zip(first, *(table.column(x).to_pylist() for x in ("places", "counts"))):
        places, value = unpack(p, c)
        total[start + places.astype(np.int64)] = value
    return total


def per_group(rows: DataFrame, answer: DataFrame,
              work: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``work(documents, answers)`` of every group."""
    return rows.groupBy("grp").cogroup(answer.groupBy("grp")).applyInArrow(work, schema)


# --- the smaller form -----------------------------------------------------------------

PACKED = "grp int, docs binary"
PACKED_SCHEMA = pa.schema([("grp", pa.int32()), ("docs", pa.binary())])
CELLS = "bucket int, grp int, cell binary"
CELLS_SCHEMA = pa.schema([("bucket", pa.int32()), ("grp", pa.int32()), ("cell", pa.binary())])
#: Bytes of text that a task packs at once.
PACK_BYTES = 16 << 20


def squeezed(head: list[int], data: bytes) -> bytes:
    """Numbers and the size of ``data``, then ``data`` compressed."""
    return np.array([*head, len(data)], "<i8").tobytes() + pa.compress(
        data, codec="zstd", asbytes=True)


def unsqueezed(value: bytes, heads: int) -> tuple[list[int], np.ndarray]:
    *head, size = np.frombuffer(value, "<i8", heads + 1).tolist()
    data = pa.decompress(value[8 * heads + 8:], size, codec="zstd") if size else b""
    return head, np.frombuffer(data, np.uint8)


def packed_groups(rows: DataFrame) -> DataFrame:
    """(grp, doc_id, held, text) rows as compressed runs of a group's documents."""
    def pack_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, size=PACK_BYTES):
                grp = part.column("grp").to_numpy()
                by = np.argsort(grp, kind="stable")
                grp, part = grp[by], part.take(pa.array(by))
                ids = part.column("doc_id").fill_null(0).to_numpy()
                flags = (part.column("held").to_numpy(False).astype(np.uint8)
                         + 2 * part.column("doc_id").is_null().to_numpy(False).astype(np.uint8))
                _, bounds, values = part.column("text").cast(pa.large_string()).buffers()
                at = np.frombuffer(bounds, "<i8", len(grp) + 1)
                first = np.flatnonzero(np.diff(grp, prepend=-1))
                out = []
                for a, b in zip(first.tolist(), [*first[1:].tolist(), len(grp)]):
                    text = values[at[a]:at[b]].to_pybytes() if at[b] > at[a] else b""
                    out.append((int(grp[a]), squeezed([b - a], b"".join((
                        ids[a:b].tobytes(), np.diff(at[a:b + 1]).tobytes(),
                        flags[a:b].tobytes(), text)))))
                yield from as_batch(out, PACKED_SCHEMA).to_batches()

    return rows.select("grp", "doc_id", "held", "text").mapInArrow(pack_rows, PACKED)


def opened(table: pa.Table) -> pa.RecordBatch:
    """The documents of a group: doc_id, held, text."""
    ids, sizes, flags, texts = [], [], [], []
    for value in table.column("docs").to_pylist():
        (n,), raw = unsqueezed(value, 1)
        ids.append(raw[:8 * n].view("<i8"))
        sizes.append(raw[8 * n:16 * n].view("<i8"))
        flags.append(raw[16 * n:17 * n])
        texts.append(raw[17 * n:])
    sizes, flags = np.concatenate(sizes), np.concatenate(flags)
    bounds = np.concatenate(([0], np.cumsum(sizes))).astype("<i8")
    text = pa.LargeStringArray.from_buffers(
        len(sizes), pa.py_buffer(bounds), pa.py_buffer(np.concatenate(texts)))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(ids), mask=flags & 2 > 0), pa.array(flags & 1 > 0), text],
        ["doc_id", "held", "text"])


def ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, the order of all keys, where each distinct one begins in it,
    and the number of each key among the distinct ones.

    Sorting values is several times faster than sorting places, so places stand in the
    low bits; keys that agree in all other bits are rare and sorted the plain way.
    """
    n = len(keys)
    low = U64((1 << n.bit_length()) - 1)
    order = (np.sort((keys & ~low) | np.arange(n, dtype=U64)) & low).astype(np.int64)
    ranks = keys[order]
    if (ranks[1:] < ranks[:-1]).any():
        order = np.argsort(keys, kind="stable")
        ranks = keys[order]
    fresh = np.ones(n, bool)
    fresh[1:] = ranks[1:] != ranks[:-1]
    number = np.empty(n, np.int64)
    number[order] = np.cumsum(fresh) - 1
    first = np.flatnonzero(fresh)
    return ranks[first], order, first, number


def _planes(values: np.ndarray) -> bytes:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _unplanes(raw: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(raw.reshape(8, -1).T).view("<i8").ravel()


def cells(group: int, kind: int, keys: np.ndarray, counts: np.ndarray,
          buckets: int) -> Iterator[tuple]:
    """Rows of ``CELLS`` for a group's distinct sorted keys of a kind (0, 1, ...)."""
    bucket = bucket_of(keys, buckets)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(keys)]):
        yield (kind * buckets + int(bucket[a]), group,
               squeezed([], unbyte(keys[a:b]) + _planes(counts[a:b])))


def cell_of(value: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The keys and counts of a cell."""
    raw = unsqueezed(value, 0)[1]
    half = len(raw) // 2
    return rebyte(raw[:half]), _unplanes(raw[half:])


def met(asks: DataFrame) -> DataFrame:
    """Per cell that has keys of other groups too: a bit per key, and those keys' totals."""
    def merge(key: tuple, table: pa.Table) -> pa.Table:
        groups = table.column("grp").to_pylist()
        parts = [cell_of(value) for value in table.column("cell").to_pylist()]
        _, order, first, number = ranked(np.concatenate([p[0] for p in parts]))
        own = np.concatenate([p[1] for p in parts])
        total = np.add.reduceat(own[order], first)[number]
        shared = np.diff(np.append(first, len(order)))[number] > 1
        rows, at = [], 0
        for group, (k, _) in zip(groups, parts):
            mark, t = shared[at:at + len(k)], total[at:at + len(k)]
            at += len(k)
            if mark.any():
                bits = np.packbits(mark).tobytes()
                rows.append((key[0].as_py(), group,
                             squeezed([len(bits)], bits + _planes(t[mark]))))
        return as_batch(rows, CELLS_SCHEMA)

    return asks.groupBy("bucket").applyInArrow(merge, CELLS)


def told(answer: pa.Table, kind: int, keys: np.ndarray, own: np.ndarray,
         buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Totals of the keys that a group asked for, and which of them another group has."""
    total, shared = own.copy(), np.zeros(len(keys), bool)
    bucket = bucket_of(keys, buckets)
    for b, value in zip(answer.column("bucket").to_pylist(), answer.column("cell").to_pylist()):
        if b // buckets != kind:
            continue
        (size,), raw = unsqueezed(value, 1)
        start, end = np.searchsorted(bucket, [b % buckets, b % buckets + 1])
        mark = np.unpackbits(raw[:size], count=end - start).astype(bool)
        shared[start:end] = mark
        total[start:end][mark] = _unplanes(raw[size:])
    return total, shared
