"""Spelling variants against brute force: the search of one shard, and the whole operator over noised documents."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tapeloom.llm import queries as Q
from tapeloom.llm import spelling

SCHEMA = "doc_id long, text string, word string, n int, _doc int, _run int"


def near(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def words_of(rows) -> Counter:
    count = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{i}:{run}".encode()) if i is not None else 1
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    return Counter({w: n for w, n in count.items() if len(w) >= 7 and n >= 2})


def brute(count: Counter) -> set:
    form, out = {}, {}
    for w, n in count.items():
        by = sorted((-m, u) for u, m in count.items() if near(w, u))
        form[w] = by[0][1] if by and -by[0][0] >= 10 * n else None
        out[w] = len(by)
    rows = set()
    for w, n in count.items():
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, n, out[w], count[form[w]] if form[w] else None))
    return rows


def rows_of(frame) -> list:
    return [tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in frame.collect()]


@pytest.mark.parametrize("letters", ["ab", "abcé", "abcdefgh"])
@pytest.mark.parametrize("indexed", [1.0, 0.5])
def test_a_shard_finds_each_pair_once(letters, indexed):
    rng = random.Random(len(letters))
    words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(7, 11))) for _ in range(250)} | {"a" * 300, "a" * 301, "ab" * 200})
    own = np.array([rng.random() < indexed for _ in words])
    want = Counter()
    for a in words:
        for b, indexed_b in zip(words, own):
            if indexed_b and (len(a) > len(b) or len(a) == len(b) and a < b) and near(a, b):
                want.update([(a, b), (b, a)])
    got = Counter()
    for leftward in (True, False):
        for batch in spelling._shard_pairs(words, np.arange(len(words)), own, leftward):
            got.update(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
    assert got == want


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    stems = ["".join(rng.choice("abdeiklnorstéÀß×") for _ in range(rng.randint(6, 12))) for _ in range(60)]

    def variant(w):
        k, c = rng.randrange(len(w)), rng.choice("abeé")
        return rng.choice([w, w[:k] + w[k + 1 :], w[:k] + c + w[k + 1 :], w[:k] + c + w[k:]])

    texts = [(i, " ".join(rng.choice([s, s, s, variant(s)]) for s in rng.choices(stems, [1000 / (k + 1) for k in range(60)], k=200))) for i in range(60)]
    texts += [(100, None), (101, ""), (102, "1 2 -- !"), (None, " ".join(stems)), (None, None), (103, " ".join(stems).upper()), (103, " ".join(stems).upper())]
    texts += [(104, "misspelling " * 300 + "mispelling " * 30 + "mispeling " * 2 + "abcdefg abcdefh " * 2), (105, "x" * 20_000 + " " + "x" * 20_000 + " ab12cdefgh12")]
    return texts


@pytest.mark.parametrize("part,shard", [(spelling.PART, spelling.SHARD), (3, 40)])
def test_all_words_with_their_forms(spark, rows, part, shard, monkeypatch):
    monkeypatch.setattr(spelling.near_pairs, "__defaults__", (part, shard))
    made = [(i, t, "x", 1, 2, 3) for i, t in rows]
    got = rows_of(spelling.group(spark.createDataFrame(made, SCHEMA).repartition(5)))
    want = brute(words_of(rows))
    assert len(got) == len(want) and set(got) == want
    assert any(r[1] for r in want) and any(r[2] != r[1] for r in want if r[1])


def test_chains_of_forms_and_ties(spark):
    count = {"aaaaaaab": 1, "aaaaaaac": 10, "aaaaaacc": 100, "aaaaaccc": 1000, "aaaacccc": 10_000, "bbbbbbbx": 2, "bbbbbbby": 20, "bbbbbbbz": 20, "lonelyword": 3}
    got = set(rows_of(spelling.variants(spark.createDataFrame(list(count.items()), "word string, n long"))))
    assert got == brute(Counter(count))
    assert {r[2] for r in got if r[0] == "aaaaaaab"} == {"aaaacccc"} and {r[1] for r in got if r[0] == "bbbbbbbx"} == {"bbbbbbby"}


def test_no_documents(spark):
    assert spelling.group(spark.createDataFrame([], SCHEMA)).count() == 0
    assert spelling.group(spark.createDataFrame([(1, None, "", 1, 1, 1), (2, "short words", "", 1, 1, 1)], SCHEMA)).count() == 0


def test_given_documents(spark, tables):
    given = [(int(r[0]), r[1]) for r in spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text").collect()]
    count = words_of(given)
    got = rows_of(Q.op11_spelling_variants(spark, tables))
    assert {(r[0], r[3]) for r in got} == set(count.items()) and len(got) == len(count)
    some = {w: n for w, n in count.items() if w[0] in "aeo"}  # all pairs of these and the rest
    near_n = {w: sum(near(w, u) for u in count if u[:3] == w[:3] or u[-3:] == w[-3:]) for w in sorted(some)[:400]}
    assert all(r[4] == near_n[r[0]] for r in got if r[0] in near_n)
