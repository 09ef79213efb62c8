"""Burrows-Wheeler transform and common prefixes of many texts, built column by column.

Round ``j`` inserts, for every text of at least ``j`` symbols, the suffix of its last ``j``
symbols: its place follows from the symbol in front of the suffix that the round before
inserted (how often that symbol stands before it), and its common prefix with its
neighbours is one more than the least common prefix between the two suffixes behind that
symbol.  The transform and the common prefixes are two columns each round of which is
read and written once from front to back; a column of over ``HELD`` bytes lives in a file, and
the old files are dropped.  Beside them a round keeps a few numbers per text and a table of
symbol counts per block.

The files are unnamed and lie where Spark puts a task's spilled rows; they belong to one task
and vanish with it, so nothing else reads them and a lost task starts afresh.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np

U64 = np.uint64
REACH = 128  # symbols looked at around a place at once; blocks never grow beyond it
NEW_BLOCK = 64
HELD = 4 << 20


class Column:
    """A column of bytes, written once and read once a round; a long one is in an unnamed file."""

    def __init__(self) -> None:
        folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
        self.folder = folder if os.path.isdir(folder) else None
        self.file = self.held = None

    def write(self, values: np.ndarray) -> None:
        if self.file:
            self.file.close()
        self.file, self.held = None, values
        if len(values) <= HELD:
            return
        self.held = None
        self.file = tempfile.TemporaryFile(dir=self.folder)
        values.tofile(self.file)

    def read(self) -> np.ndarray:
        if self.file is None:
            return self.held
        self.file.seek(0)
        return np.fromfile(self.file, np.uint8)


class Counts:
    """How often each symbol stands before a place: totals of blocks, which grow with what is
    inserted and are cut anew when one exceeds ``REACH``."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.size = size
        self.cut(symbols)

    def cut(self, symbols: np.ndarray) -> None:
        blocks = -(-len(symbols) // NEW_BLOCK)
        self.starts = np.arange(blocks) * NEW_BLOCK
        self.lengths = np.full(blocks, NEW_BLOCK)
        self.lengths[-1] = len(symbols) - self.starts[-1]
        cell = symbols * np.int32(blocks) + np.repeat(np.arange(blocks, dtype=np.int32),
                                                      self.lengths)
        self.table = np.bincount(cell, minlength=blocks * self.size).astype(np.int32).reshape(
            self.size, blocks)
        self._sum()

    def _sum(self) -> None:
        self.before = np.zeros((self.size, self.table.shape[1] + 1), np.int32)
        np.cumsum(self.table, axis=1, out=self.before[:, 1:])

    def block_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, at, "right") - 1

    def total(self) -> np.ndarray:
        return self.before[:, -1].astype(np.int64)

    def home(self, symbol: np.ndarray, nth: np.ndarray) -> np.ndarray:
        """The block that holds the nth (from 1) occurrence of a symbol."""
        low = np.zeros(len(symbol), np.int64)
        high = np.full(len(symbol), len(self.starts))
        for _ in range(int(len(self.starts)).bit_length()):
            middle = (low + high) >> 1
            less = self.before[symbol, middle] < nth
            low, high = np.where(less, middle, low), np.where(less, high, middle)
        return low

    def insert(self, at: np.ndarray, symbols: np.ndarray, whole: np.ndarray) -> None:
        """``symbols`` now stand at the sorted places ``at`` of ``whole``."""
        block = self.block_of(at - np.arange(len(at)))
        more = np.bincount(block, minlength=len(self.starts))
        self.lengths = self.lengths + more
        if self.lengths.max() > REACH:
            self.cut(whole)
            return
        self.starts = self.starts + np.cumsum(more) - more
        np.add.at(self.table.reshape(-1), symbols.astype(np.int64) * len(self.starts) + block, 1)
        self._sum()


def _windows(symbols: np.ndarray, at: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Bits of the ``REACH`` symbols from each place of ``at`` on that equal ``wanted``."""
    rows = np.ndarray((len(symbols) - REACH + 1, REACH), np.uint8, symbols, 0, (1, 1))[at]
    return np.packbits(rows == wanted[:, None], axis=1, bitorder="little").view("<u8")


def _highest(bits: np.ndarray) -> np.ndarray:
    """The last set bit of two words, -1 for none."""
    word = np.where(bits[:, 1] != 0, bits[:, 1], bits[:, 0])
    for shift in (1, 2, 4, 8, 16, 32):
        word = word | (word >> U64(shift))
    last = np.bitwise_count(word).astype(np.int64) - 1
    return last + 64 * (bits[:, 1] != 0)


def _lowest(bits: np.ndarray) -> np.ndarray:
    """The first set bit of two words, ``REACH`` for none."""
    def first(word: np.ndarray) -> np.ndarray:
        return np.bitwise_count((word & (~word + U64(1))) - U64(1)).astype(np.int64)
    return np.where(bits[:, 0] != 0, first(bits[:, 0]),
                    64 + np.where(bits[:, 1] != 0, first(bits[:, 1]), 64))


def _least(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least of values[low:high], ``high`` ascending and below len(values).

    Taken from the last pair to the first, so that what lies between two pairs is never
    looked at."""
    edges = np.empty(2 * len(low), np.int64)
    edges[0::2], edges[1::2] = low[::-1], high[::-1]
    return np.minimum.reduceat(values, edges)[0::2][::-1]


ALL = ~U64(0)


def _ones(n: np.ndarray) -> np.ndarray:
    """The lowest n of the ``REACH`` bits of two words."""
    def word(k: np.ndarray) -> np.ndarray:
        return np.where(k >= 64, ALL, (U64(1) << (k & 63).astype(U64)) - U64(1))
    return np.stack((word(n), word(np.maximum(n - 64, 0))), axis=1)


def _neighbours(padded: np.ndarray, counts: Counts, at: np.ndarray, symbol: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each place and the symbol there: the symbol's count in front, and its occurrences
    next before (-1 for none) and after (-1)."""
    behind = _windows(padded, at, symbol)  # of the symbols at - REACH to at - 1
    block = counts.block_of(at)
    inside = np.bitwise_count(behind & ~_ones(REACH - (at - counts.starts[block]))).sum(axis=1)
    rank = counts.before[symbol, block] + inside.astype(np.int64)
    last = _highest(behind)
    before = np.where(last >= 0, at - REACH + last, -1)
    first = _lowest(_windows(padded, at + REACH + 1, symbol))
    after = np.where(first < REACH, at + 1 + first, -1)
    # Further away: the block that holds the occurrence, then the place in it.
    far = np.flatnonzero((before < 0) & (rank > 0))
    home = counts.home(symbol[far], rank[far])
    start = counts.starts[home]
    bits = _windows(padded, start + REACH, symbol[far]) & _ones(counts.lengths[home])
    before[far] = start + _highest(bits)
    far = np.flatnonzero((after < 0) & (rank + 1 < counts.total()[symbol]))
    start = counts.starts[counts.home(symbol[far], rank[far] + 2)]
    after[far] = start + _lowest(_windows(padded, start + REACH, symbol[far]))
    return rank, before, after


def repeats(texts: list[np.ndarray], length: int) -> list[np.ndarray]:
    """Per text, whether the string of ``length`` symbols from each place on also starts at
    another place of any text.  Texts are byte arrays of at least ``length`` symbols;
    ``length`` is at most 254."""
    m = len(texts)
    sizes = np.array([len(t) for t in texts])
    data = np.concatenate(texts)
    kinds = np.zeros(256, bool)
    kinds[data] = True
    code = np.cumsum(kinds).astype(np.uint8)  # 1 for the least; 0 marks a text's front
    data = code[data]
    size = int(kinds.sum()) + 1
    if size > 256:
        raise ValueError("texts with all 256 byte values are not text")
    ends = np.cumsum(sizes)
    symbols, common = Column(), Column()
    symbols.write(data[ends - 1])
    common.write(np.zeros(m, np.uint8))
    counts = Counts(data[ends - 1], size)
    texts_now, at = np.arange(m), np.arange(m)  # by place of the newest suffix
    for j in range(1, int(sizes.max()) + 1):
        alive = sizes[texts_now] >= j
        texts_now, at = texts_now[alive], at[alive]
        old, prefix = symbols.read(), common.read()
        n = len(old)
        padded = np.zeros(n + 2 * REACH + 1, np.uint8)
        padded[REACH:REACH + n] = old
        symbol = old[at]
        rank, before, after = _neighbours(padded, counts, at, symbol.astype(np.int64))
        prefix_end = np.append(prefix, np.uint8(0))
        own = np.zeros(len(at), np.int64)
        on = np.flatnonzero(before >= 0)
        own[on] = 1 + _least(prefix_end, before[on] + 1, at[on] + 1).astype(np.int64)
        behind = np.zeros(len(at), np.int64)
        on = np.flatnonzero(after >= 0)
        by = on[np.argsort(after[on], kind="stable")]
        behind[by] = 1 + _least(prefix_end, at[by] + 1, after[by] + 1).astype(np.int64)
        # The texts' ends come first, then the suffixes by their first symbol.
        total = counts.total()
        total[0] = m
        first = np.cumsum(total) - total
        place = first[symbol] + rank
        order = np.argsort(place)
        place, texts_now = place[order], texts_now[order]
        own, behind, follows = own[order], behind[order], (after >= 0)[order]
        front = ends[texts_now] - j - 1
        new = np.where(sizes[texts_now] > j, data[np.maximum(front, 0)], 0).astype(np.uint8)
        stays = np.ones(n + len(place), bool)
        stays[place] = False
        whole = np.empty(n + len(place), np.uint8)
        whole[place] = new
        whole[stays] = old
        joint = np.empty(n + len(place), np.uint8)
        joint[stays] = prefix
        joint[place[follows] + 1] = np.minimum(behind[follows], length)
        joint[place] = np.minimum(own, length)
        symbols.write(whole)
        common.write(joint)
        counts.insert(place, new, whole)
        at = place
    return _read_back(symbols.read(), common.read(), sizes, length)


def _read_back(symbols: np.ndarray, common: np.ndarray, sizes: np.ndarray,
               length: int) -> list[np.ndarray]:
    """Follow every text from its end to its front and look at the common prefixes."""
    forward = np.empty(len(symbols), np.int64)
    forward[np.argsort(symbols, kind="stable")] = np.arange(len(symbols))
    again = common >= length
    again[:-1] |= common[1:] >= length
    out = [np.zeros(s - length + 1, bool) for s in sizes.tolist()]
    flat = np.concatenate(out)
    begin = np.cumsum(sizes - length + 1) - (sizes - length + 1)
    texts, at = np.arange(len(sizes)), np.arange(len(sizes))
    for j in range(1, int(sizes.max()) + 1):
        alive = sizes[texts] >= j
        texts, at = texts[alive], forward[at[alive]]
        if j >= length:
            flat[begin[texts] + sizes[texts] - j] = again[at]
    return np.split(flat, begin[1:])
