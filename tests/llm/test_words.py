"""Word hashes: the same everywhere, and different for words that differ."""

from __future__ import annotations

import random

import pyarrow as pa

from tapeloom.llm import words as W


def doubled(n, flip="ab"):
    """Each half the other with its letters exchanged."""
    s, turn = flip[0], str.maketrans("ab", "ba")
    while len(s) < n:
        s += s.translate(turn)
    return s


def hashes(texts, second):
    w = W.find(pa.array(texts))
    raw = w.data.tobytes()
    return [(raw[a:b], h) for a, b, h in zip(w.starts, w.ends, w.hashes(second).tolist())]


def test_a_word_has_one_hash_of_its_own():
    rng = random.Random(7)
    words = [doubled(n, f) for n in (8, 16, 64, 1024, 2048, 4096) for f in ("ab", "ba")]
    words += ["x" * k for k in range(1, 300)] + ["\x00" * k for k in range(1, 40)]
    words += [f"{rng.getrandbits(bits):x}" for bits in (8, 24, 60, 64, 128, 500) for _ in range(300)]
    words = list(dict.fromkeys(words))
    together = {}
    for second in (False, True):
        mine = dict(hashes([" ".join(words)], second))
        assert len(set(mine.values())) == len(words)
        for k in range(0, len(words), 7):  # whatever else the batch holds
            assert dict(hashes(["", f"a {words[k]}\n", None], second))[words[k].encode()] == mine[words[k].encode()]
        together[second] = mine
    assert not set(together[False].values()) & set(together[True].values())
