"""Words of Arrow text columns as numpy arrays: one pass over the bytes of a whole batch.

A word is a run of bytes other than space and 0x09 to 0x0D. Hashes are 64-bit
and depend on the word's bytes alone, so every task gives a word the same one;
where more bits are needed, a second, independent hash is to be had.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_RNG = np.random.Generator(np.random.PCG64(20240601))
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Odd multipliers of the positions in an n-gram.
_PLACE = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE2 = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Keys of the first and the second hash of a span: of its blocks, of joining two values, of a value without a partner.
_KEYS = _RNG.integers(1, 2**63, (2, 4), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: The first k bytes of a little-endian block of eight.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; a null counts as an empty text."""
    column = pc.cast(pc.fill_null(column, ""), pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, text: str = "text", most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most`` bytes of text each, whole rows only."""
    column = batch.column(batch.schema.get_field_index(text))
    sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0), np.int64)
    begin, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += int(n)
    if batch.num_rows > begin:
        yield batch.slice(begin)


@dataclass
class Words:
    """Words of a batch in order. ``row``: the row of each; ``first``: where each row's words begin (and the end)."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, second: bool = False) -> np.ndarray:
        """A 64-bit hash of each word's bytes; ``second``: one that is independent of the first."""
        return span_hashes(self.data, self.starts, self.ends, second)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, second: bool = False) -> np.ndarray:
    """A 64-bit hash of each non-empty span of bytes.

    A span is read in blocks of eight bytes. Each block is spread by a
    non-linear one-to-one function, and the values are joined two by two, again
    non-linearly, until one is left; the length goes in last. Spans of up to
    seven bytes, with their length beside them in one block, have different hashes
    for certain, others but for one chance in 2**64.
    """
    n = len(starts)
    if not n:
        return np.zeros(0, np.uint64)
    spread, joined, alone, length_key = _KEYS[int(second)]
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    block = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))  # the eight bytes from each place on
    lengths = ends - starts
    h = block[starts] & _FIRST[np.minimum(lengths, 8)]
    h |= np.where(lengths < 8, lengths, 0).astype(np.uint64) << np.uint64(56)
    h = mixed(h ^ spread)
    long = np.flatnonzero(lengths > 7)
    if len(long):
        size = lengths[long]
        c = (size + 7) // 8
        within = flat_ranges(np.zeros(len(c), np.int64), c)
        at = np.repeat(starts[long], c) + 8 * within
        v = mixed((block[at] & _FIRST[np.minimum(np.repeat(ends[long], c) - at, 8)]) ^ (spread + within.astype(np.uint64) * _STEP))
        while int(c.max()) > 1:
            half = (c + 1) // 2
            begin = np.cumsum(c) - c
            within = flat_ranges(np.zeros(len(c), np.int64), half)
            left = np.repeat(begin, half) + 2 * within
            paired = 2 * within + 1 < np.repeat(c, half)
            right = np.where(paired, mixed(v[np.minimum(left + 1, len(v) - 1)] ^ joined), alone)
            # a span that is down to one value is done, however long others are
            v, c = np.where(np.repeat(c == 1, half), v[left], mixed(v[left] * joined + right)), half
        h[long] = mixed(v + size.astype(np.uint64) * length_key)
    return h


def find(column: pa.Array, lower: bool = False) -> Words:
    """The words of every row; ``lower`` turns A to Z into a to z first."""
    data, offsets = text_bytes(column)
    if lower:
        data = LOWER[data]
    n = len(data)
    inside = ~SEPARATOR[data]
    fresh = np.zeros(n + 1, bool)  # a text begins here, or all end
    fresh[offsets] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | fresh[:n]))
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | fresh[1:])) + 1
    row = np.searchsorted(offsets, starts, side="right") - 1
    first = np.searchsorted(starts, offsets)
    return Words(data, offsets, starts, ends, row, first)


def grams(h: np.ndarray, row: np.ndarray, n: int, second: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``n`` words from each position on, and whether they all belong to one row."""
    size = max(0, len(h) - n + 1)
    place = _PLACE2 if second else _PLACE
    g = np.zeros(size, np.uint64)
    for j in range(n):
        g += h[j : j + size] * place[j]
    return mixed(g), row[:size] == row[n - 1 : n - 1 + size]


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def flat_ranges(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers begin[i] to begin[i] + length[i] - 1 for each i, one after the other."""
    total = int(length.sum())
    if not total:
        return np.zeros(0, np.int64)
    at = np.cumsum(length) - length
    return np.arange(total, dtype=np.int64) - np.repeat(at - begin, length)
