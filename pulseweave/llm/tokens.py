"""Words of a batch of texts as numpy arrays, for operators that run Python in tasks.

A batch is cut into slices of about ``SLICE`` bytes of text, so that memory follows the
slice (or the longest text) and not the Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
U64 = np.uint64
#: An odd base and its inverse modulo 2**64, for hashes of byte ranges.
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit (splitmix finaliser)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class _Powers:
    """Powers of the base and its inverse, kept per process and never sent to another."""

    def __init__(self) -> None:
        self.tables: tuple[np.ndarray, ...] = ()

    def __reduce__(self):
        return _Powers, ()

    def get(self, n: int) -> tuple[np.ndarray, ...]:
        if not self.tables or len(self.tables[0]) < n:
            size = SLICE
            while size < n:
                size *= 2
            steps = np.empty((2, size), U64)
            steps[0], steps[1] = U64(BASE), U64(INVERSE)
            steps[:, 0] = 1
            self.tables = tuple(np.cumprod(steps, axis=1, dtype=U64))
        return self.tables


_POWERS = _Powers()


@dataclass
class Words:
    """Words of consecutive texts: byte ranges in ``data``, and where each text begins."""
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # of text i: words first[i] to first[i + 1]

    @property
    def text(self) -> np.ndarray:
        """The text that each word is in."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        if not len(self.starts):
            return np.zeros(0, U64)
        power, inverse = _POWERS.get(len(self.data))
        sums = np.empty(len(self.data) + 1, U64)
        sums[0] = 0
        np.cumsum((self.data.astype(U64) + U64(1)) * power[:len(self.data)], out=sums[1:])
        raw = (sums[self.ends] - sums[self.starts]) * inverse[self.starts]
        return mix(raw + (self.ends - self.starts).astype(U64) * U64(0xD6E8FEB86659FD93))


#: Which bytes part words: the blanks, or every ASCII byte but letters and digits.
BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def words_of(texts: pa.Array, lower: bool = False, parting: np.ndarray = BLANK) -> Words:
    """The words of every text, ``[^\\x20\\x09-\\x0D]+`` by default; nulls have none."""
    texts = texts.fill_null("").cast(pa.large_string())
    _, bounds, values = texts.buffers()
    at = np.frombuffer(bounds, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    data = raw[at[0]:at[-1]]
    at = at - at[0]
    if lower:
        data = data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)
    inside = np.ones(len(data) + 1, bool)
    inside[:-1] = ~parting[data]
    inside[-1] = False
    fresh = np.ones(len(data) + 1, bool)
    fresh[1:] = ~inside[:-1]
    fresh[at] = True
    starts = np.flatnonzero(inside & fresh)
    stop = inside[:-1] & (~inside[1:] | fresh[1:]) if len(data) else np.zeros(0, bool)
    ends = np.flatnonzero(stop) + 1
    return Words(data, starts, ends, np.searchsorted(starts, at))


class RollingBytes:
    """Bytes of consecutive texts, with a hash of any range inside."""

    def __init__(self, texts: pa.Array):
        texts = texts.fill_null("").cast(pa.large_string())
        _, bounds, values = texts.buffers()
        at = np.frombuffer(bounds, np.int64)[texts.offset:texts.offset + len(texts) + 1]
        raw = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
        self.data = raw[at[0]:at[-1]]
        self.at = at - at[0]
        power, self.inverse = _POWERS.get(len(self.data) + 1)
        self.sums = np.empty(len(self.data) + 1, U64)
        self.sums[0] = 0
        np.cumsum((self.data.astype(U64) + U64(1)) * power[:len(self.data)], out=self.sums[1:])

    def hashes(self, n: int) -> np.ndarray:
        """Hash of the ``n`` bytes from each place on (across texts too)."""
        m = len(self.data) - n + 1
        if m <= 0:
            return np.zeros(0, U64)
        return mix((self.sums[n:] - self.sums[:m]) * self.inverse[:m])

    def hash_of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start])

    def windows(self, n: int) -> np.ndarray:
        """Which places start ``n`` bytes of one text."""
        m = max(0, len(self.data) - n + 1)
        ok = np.ones(m, bool)
        for edge in np.unique(self.at[1:-1]):
            ok[max(0, edge - n + 1):min(m, edge)] = False
        return ok

    def text_of(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.at, place, "right") - 1


def slices(batch: pa.RecordBatch, column: str = "text",
           size: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch of about ``size`` bytes of text, one row at least."""
    if not batch.num_rows:
        return
    sizes = pa.compute.binary_length(batch.column(column).fill_null("")).to_numpy(False)
    cut = np.cumsum(sizes.astype(np.int64)) // size
    edges = np.flatnonzero(np.diff(cut)) + 1
    for a, b in zip([0, *edges], [*edges, batch.num_rows]):
        yield batch.slice(a, b - a)


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive values of ``h`` (across texts too)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, U64)
    out = np.zeros(m, U64)
    for k in range(n):
        out = mix(out * U64(BASE) + h[k:k + m])
    return out


def same_text(first: np.ndarray, n: int) -> np.ndarray:
    """Which runs of ``n`` words, by first word, lie in one text."""
    total = int(first[-1])
    m = max(0, total - n + 1)
    ok = np.ones(m, bool)
    for edge in np.unique(first[1:-1]):
        ok[max(0, edge - n + 1):min(m, edge)] = False
    return ok


def spans(lengths: np.ndarray) -> np.ndarray:
    """0..l-1 for every length l, one after the other."""
    total = int(lengths.sum())
    return np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def unbyte(values: np.ndarray) -> bytes:
    """Sorted 64-bit values as differences, byte by byte: leading bytes compress away."""
    gaps = np.diff(values, prepend=U64(0)).astype("<u8")
    return gaps.view(np.uint8).reshape(-1, 8).T.tobytes()


def rebyte(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(8, -1).T
    return np.cumsum(np.ascontiguousarray(raw).view("<u8").ravel(), dtype=U64)
