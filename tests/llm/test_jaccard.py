"""The n-gram Jaccard join: what it writes, its parts, its parities."""

from __future__ import annotations

import random
from pathlib import Path
from urllib.parse import unquote, urlparse

import numpy as np

from tapeloom.llm import jaccard


def table(spark, texts):
    return spark.createDataFrame(list(texts.items()), "doc_id long, text string")


def test_join_writes_little_for_documents_without_one(spark, monkeypatch):
    """Long texts that share passages, and so blocks, but are no near copies: their sets are not written."""
    rng = random.Random(9)
    passage = [f"c{k}" for k in range(1000)]
    texts = {d: " ".join([*passage, *(f"d{d}x{rng.randrange(10**9)}" for _ in range(2000))]) for d in range(60)}
    texts |= {60: texts[7] + " more", 61: texts[8].replace("c500", "other")}
    written = {}

    def measured(df, what, *more, f=jaccard.stash, **how):
        out = f(df, what, *more, **how)
        written[what] = written.get(what, 0) + sum(Path(unquote(urlparse(x).path)).stat().st_size for x in out.inputFiles())
        return out

    monkeypatch.setattr(jaccard, "stash", measured)
    got = jaccard.one_of_each(table(spark, texts).repartition(1), n=5, percent=80)
    assert sorted(r["doc_id"] for r in got.select("doc_id").collect()) == list(range(60))
    assert written["jaccard-blocks"] > 0
    assert sum(written.values()) < 0.5 * sum(map(len, texts.values())), written


def test_join_in_parts(spark, monkeypatch):
    """Pairs and keys dealt into many parts, and rows that copies outnumber, give the same components."""
    rng = random.Random(10)
    texts, k = {}, 0
    for size in (30, 300, 700, 1500):
        for group in range(3):
            words = [f"g{size}x{group}x{rng.randrange(10**9)}" for _ in range(size)]
            for changes in (0, 0, size // 100, size // 60, size // 50, size // 40, size // 30):
                texts[k] = " ".join(f"n{k}x{i}" if i in places else w for places in [set(rng.sample(range(size), changes))] for i, w in enumerate(words))
                k += 1
    sets = {i: {tuple(w[p : p + 5]) for p in range(len(w) - 4)} for i, w in ((i, t.split()) for i, t in texts.items())}
    root = list(range(k))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(k):
        for j in range(i + 1, k):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    want = {i: top(i) for i in range(k)}
    assert len(set(want.values())) > 12  # not all edits are near copies
    docs = table(spark, texts)
    find = lambda docs, **how: {(r["doc_id"], r["component_id"]) for r in jaccard.join(docs, n=5, percent=80, **how).collect()}
    copies = docs.unionByName(docs.selectExpr("doc_id + 1000 AS doc_id", "text")).unionByName(docs.selectExpr("doc_id + 2000 AS doc_id", "text"))
    assert find(copies) == {(i + more, c) for i, c in want.items() for more in (0, 1000, 2000)}
    monkeypatch.setattr(jaccard, "PAIRS", 8)
    monkeypatch.setattr(jaccard, "KEYS", 24)
    assert find(docs) == find(docs, star_rounds=0) == set(want.items())


def test_fine_parities_rule_out_no_link():
    """Sets of any sizes differ in at least as many n-grams as their parities say; far ones are told apart."""
    import numpy as np
    rng = np.random.default_rng(11)
    for a, b, both in ((600, 590, 580), (1024, 1025, 1020), (1000, 1200, 990), (513, 512, 500), (4000, 4100, 3700), (70_000, 60_000, 58_000), (900, 5, 3), (3000, 3100, 900)):
        shared, own, other = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (both, a - both, b - both))
        x, y = np.concatenate((shared, own)), np.concatenate((shared, other))
        _, fine = jaccard._parities(np.concatenate((x, y)), np.array([0, a, a + b]))
        least, apart = jaccard._differ(*(v.as_py() for v in fine)), a + b - 2 * both
        assert least <= apart and (apart - least) % 2 == 0 or min(a, b) <= 512
        assert (len(fine[0].as_py()) * 8 >= a) == (a > 512)
    assert least * 180 > (a + b) * 20
