"""A two-level n-gram trie in Elias-Fano form, queried in one block of mapped memory.

Level one holds the words of a shard, sorted by hash, as an Elias-Fano
sequence, with their counts. Level two holds each word's contexts. A context is
coded relative to its word: the word's rank, then 40 bits of the context's
hash, so the codes of a whole level are one monotone sequence. The pointers
from a word to where its contexts begin and end are a third one. High parts are
stored in unary, low parts as packed bytes; a context is found by a successor
search between its word's pointers. Next to every context stands a 16-bit
quantised logarithm of its smoothed share of the word's count.

``pack`` lays all levels out in one image, which can be kept anywhere and
mapped; ``Trie`` reads it in place. Of two contexts of one word that agree in
40 bits the counts are added.
"""

from __future__ import annotations

import mmap

import numpy as np

CONTEXT_BITS = 40
STEPS = 1024  # quantisation steps of a factor of two


def _unary_block(high: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The 64 bits of each of the ``word``-th words of a unary part."""
    return np.unpackbits(high[word[:, None] * 8 + np.arange(8)].reshape(-1)).reshape(-1, 64)


class EliasFano:
    """A monotone sequence of 64-bit numbers, with many reads or searches at once."""

    def __init__(self, low: np.ndarray, high: np.ndarray, zeros: np.ndarray, shape: np.ndarray):
        self.high, self.zeros = high, zeros
        self.size, self.low_bytes = (int(x) for x in shape)
        self.low = low.reshape(self.size, self.low_bytes)

    @staticmethod
    def parts(values: np.ndarray) -> dict[str, np.ndarray]:
        n = len(values)
        span = int(values[-1]) + 1 if n else 1
        low_bytes = min(7, max(0, (span // max(n, 1)).bit_length() - 1 + 4) // 8)
        low = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(n, 8)[:, :low_bytes]
        high = (values.astype(np.uint64) >> np.uint64(8 * low_bytes)).astype(np.int64)
        bits = np.zeros((n + (int(high[-1]) if n else 0) + 1 + 63) // 64 * 64, np.uint8)
        bits[high + np.arange(n)] = 1  # the i-th one stands after as many zeros as its high part says
        ones = bits.reshape(-1, 64).sum(1)
        zeros = np.concatenate(([0], np.cumsum(64 - ones.astype(np.int64))))  # before each word: where a search begins
        return {"low": np.ascontiguousarray(low), "high": np.packbits(bits), "zeros": zeros, "shape": np.array([n, low_bytes], np.int64)}

    def _before_zero(self, k: np.ndarray) -> np.ndarray:
        """How many values stand before the k-th zero of the unary part, counted from 1; 0 for k = 0."""
        out = np.zeros(len(k), np.int64)
        use = np.flatnonzero(k > 0)
        for i in range(0, len(use), 1 << 15):
            at = use[i : i + (1 << 15)]
            want = k[at]
            word = np.searchsorted(self.zeros, want, side="left") - 1
            beyond = word >= len(self.zeros) - 1
            word = np.minimum(word, len(self.zeros) - 2)
            seen = np.cumsum(_unary_block(self.high, word) == 0, axis=1, dtype=np.int16)
            spot = (seen >= (want - self.zeros[word])[:, None]).argmax(1)
            out[at] = np.where(beyond, self.size, word * 64 + spot - (want - 1))
        return out

    def _low(self, at: np.ndarray) -> np.ndarray:
        raw = np.zeros((len(at), 8), np.uint8)
        raw[:, : self.low_bytes] = self.low[at]
        return raw.view("<u8").reshape(-1)

    def get(self, at: np.ndarray) -> np.ndarray:
        """The values at the places ``at``: the i-th one of the unary part tells the high part."""
        ones = np.arange(len(self.zeros)) * 64 - self.zeros
        out = np.zeros(len(at), np.uint64)
        for i in range(0, len(at), 1 << 15):
            k = at[i : i + (1 << 15)]
            word = np.searchsorted(ones, k, side="right") - 1
            seen = np.cumsum(_unary_block(self.high, word), axis=1, dtype=np.int16)
            spot = (seen > (k - ones[word])[:, None]).argmax(1)
            out[i : i + len(k)] = (word * 64 + spot - k).astype(np.uint64) << np.uint64(8 * self.low_bytes)
        return out | self._low(at)

    def find(self, values: np.ndarray, begin: np.ndarray | int, end: np.ndarray | int) -> np.ndarray:
        """The place of each value between ``begin`` and ``end``, or -1: a successor search in that range."""
        # a high part beyond the last one has no zero of its own; all values stand before it
        high = np.minimum(values >> np.uint64(8 * self.low_bytes), np.uint64(int(self.zeros[-1]))).astype(np.int64)
        want = values & np.uint64((1 << 8 * self.low_bytes) - 1)
        lo = np.maximum(self._before_zero(high), begin)
        hi = np.minimum(self._before_zero(high + 1), end)
        stop = hi.copy()
        while True:
            busy = np.flatnonzero(lo < hi)
            if not len(busy):
                break
            mid = (lo[busy] + hi[busy]) // 2
            less = self._low(mid) < want[busy]
            lo[busy[less]] = mid[less] + 1
            hi[busy[~less]] = mid[~less]
        hit = np.flatnonzero(lo < stop)
        hit = hit[self._low(lo[hit]) == want[hit]]
        out = np.full(len(values), -1)
        out[hit] = lo[hit]
        return out


_KINDS = {"low": "u1", "high": "u1", "zeros": "<i8", "shape": "<i8"}
_LEVELS = [(f"{level}.{part}", kind) for level in ("words", "begin", "codes") for part, kind in _KINDS.items()] + [("counts", "<i8"), ("shares", "<u2")]


def pack(words: np.ndarray, counts: np.ndarray, codes: np.ndarray, seen: np.ndarray) -> bytearray:
    """The image of a trie: ``words`` sorted, with counts; ``codes`` sorted, ``seen`` how often each context came before its word."""
    if len(words) >> 64 - CONTEXT_BITS:
        raise ValueError("too many words for one shard: deal them to more")
    rank = (codes >> np.uint64(CONTEXT_BITS)).astype(np.int64)
    sequences = {"words": words, "begin": np.searchsorted(rank, np.arange(len(words) + 1)).astype(np.uint64), "codes": codes}
    parts = {f"{name}.{k}": x for name, values in sequences.items() for k, x in EliasFano.parts(values).items()}
    parts |= {"counts": counts, "shares": np.clip(np.round(-np.log2(seen / (counts[rank] + 1.0)) * STEPS), 0, 65535)}
    flat = [np.ascontiguousarray(parts[name].astype(kind)).tobytes() for name, kind in _LEVELS]
    out = bytearray(np.array([len(x) for x in flat], "<i8").tobytes())
    for x in flat:
        out += x + bytes(-len(x) % 8)
    return out


class Trie:
    """Reads an image in place; see ``mapped``."""

    def __init__(self, image):
        sizes = np.frombuffer(image, "<i8", len(_LEVELS))
        at, parts = sizes.nbytes, {}
        for (name, kind), n in zip(_LEVELS, sizes.tolist()):
            parts[name] = np.frombuffer(image, kind, n // np.dtype(kind).itemsize, at)
            at += n + -n % 8
        level = lambda name: EliasFano(*(parts[f"{name}.{k}"] for k in _KINDS))
        self.words, self.begin, self.codes = level("words"), level("begin"), level("codes")
        self.counts, self.shares = parts["counts"], parts["shares"]

    @staticmethod
    def mapped(image: bytes | bytearray) -> Trie:
        """A trie in mapped memory of its own."""
        block = mmap.mmap(-1, len(image))
        block[:] = bytes(image)
        return Trie(block)

    def word(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (-1 if unknown) and count of words by hash."""
        if not self.words.size:
            return np.full(len(h), -1), np.zeros(len(h), np.int64)
        at = self.words.find(h, 0, self.words.size)
        return at, np.where(at >= 0, self.counts[at], 0)

    def share(self, rank: np.ndarray, context: np.ndarray) -> np.ndarray:
        """The smoothed share of each word's count that follows the context, 0 if it never did."""
        out = np.zeros(len(rank))
        use = np.flatnonzero(rank >= 0)
        if self.codes.size and len(use):
            code = (rank[use].astype(np.uint64) << np.uint64(CONTEXT_BITS)) | context[use]
            ranks, place = np.unique(rank[use], return_inverse=True)  # a word's pointers are read once
            begin, end = (self.begin.get(ranks + k).astype(np.int64)[place] for k in (0, 1))
            at = self.codes.find(code, begin, end)
            hit = at >= 0
            out[use[hit]] = np.exp2(self.shares[at[hit]].astype(np.float64) / -STEPS)
        return out
