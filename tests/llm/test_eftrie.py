"""Elias-Fano sequences and the trie against sorted arrays and dictionaries."""

from __future__ import annotations

import numpy as np
import pytest

from tapeloom.llm import eftrie as T


@pytest.mark.parametrize("top", [1, 3, 1 << 10, 1 << 40, (1 << 64) - 1])
@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 5000])
def test_reads_and_searches(n, top):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, top, n, dtype=np.uint64, endpoint=True))
    parts = T.EliasFano.parts(values)
    seq = T.EliasFano(*(parts[k] for k in ("low", "high", "zeros", "shape")))
    assert (seq.get(np.arange(n)) == values).all()
    asked = np.concatenate((values, rng.integers(0, top, 200, dtype=np.uint64, endpoint=True), np.array([0, top], np.uint64)))
    found = seq.find(asked, 0, n)
    there = np.isin(asked, values)
    assert ((found >= 0) == there).all()
    assert (values[found[there]] == asked[there]).all()


def test_trie_answers_from_its_image():
    rng = np.random.default_rng(1)
    words = np.unique(rng.integers(0, 1 << 63, 300, dtype=np.uint64))
    counts = rng.integers(1, 1000, len(words))
    rank = np.sort(rng.integers(0, len(words), 4000))
    codes = np.unique(rank.astype(np.uint64) << np.uint64(T.CONTEXT_BITS) | rng.integers(0, 1 << 12, 4000, dtype=np.uint64))
    seen = rng.integers(1, 50, len(codes))
    trie = T.Trie.mapped(T.pack(words, counts, codes, seen))
    at, n = trie.word(np.concatenate((words, words + np.uint64(1))))
    assert (at[: len(words)] == np.arange(len(words))).all() and (n[: len(words)] == counts).all()
    unknown = ~np.isin(words + np.uint64(1), words)
    assert (at[len(words) :][unknown] == -1).all()
    ranks = (codes >> np.uint64(T.CONTEXT_BITS)).astype(np.int64)
    context = codes & np.uint64((1 << T.CONTEXT_BITS) - 1)
    share = trie.share(ranks, context)
    want = seen / (counts[ranks] + 1.0)
    assert np.allclose(np.log2(share), np.log2(want).clip(None, 0), atol=1.0 / T.STEPS)
    assert (trie.share(ranks, context + np.uint64(1 << 20)) == 0).all()
    assert (trie.share(np.full(3, -1), np.zeros(3, np.uint64)) == 0).all()


def test_no_words():
    none = np.zeros(0, np.uint64)
    trie = T.Trie.mapped(T.pack(none, np.zeros(0, np.int64), none, np.zeros(0, np.int64)))
    assert (trie.word(np.array([5], np.uint64))[0] == -1).all()
