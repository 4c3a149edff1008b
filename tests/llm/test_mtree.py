"""Exact top-k against brute force: several levels, ties, copies, vectors that take no part."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from tapeloom.llm import mtree

SCHEMA = "vec_id long, embedding array<double>, label int, node int, v string"


def brute(rows, k, every=100):
    """Every row against every other, in Python's integers; equal queries once."""
    ok = [(i, [max(-(2**56), min(2**56, int(np.floor(1024 * float(x))))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    dims = max((len(v) for _, v in ok), default=0)
    ids = [i for i, _ in ok]
    x = np.array([v + [0] * (dims - len(v)) for _, v in ok], object).reshape(len(ok), dims)
    out, done = Counter(), set()
    for m, q in enumerate(ids):
        if q % every == 0 and (q, tuple(ok[m][1])) not in done:
            done.add((q, tuple(ok[m][1])))
            found = sorted((-int(s), c) for j, (s, c) in enumerate(zip(x @ x[m], ids)) if j != m)
            out.update((q, r + 1, c, -s if -(2**63) <= -s < 2**63 else None) for r, (s, c) in enumerate(found[:k]))
    return out


def run(spark, rows, **how):
    made = [(i, None if v is None else [None if x is None else float(x) for x in v], 0, 1, "x") for i, v in rows]
    return Counter(tuple(r) for r in mtree.top_k(spark.createDataFrame(made, SCHEMA), **how).collect())


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 8))
    out = [(i, (centres[i % 12] + 0.2 * rng.normal(size=8)).astype(np.float32).tolist()) for i in range(1500)]
    out += [(2000 + i, out[7][1]) for i in range(200)]  # one vector many times, queries among them
    out += [(3000, out[3][1])] * 15 + [(3001, out[3][1])] + [(3000, out[4][1])] * 2 + [(3100, out[5][1])] * 3  # one id many times, queries of it too
    out += [(4000, None), (4100, [1.0, None] + [0.0] * 6), (4200, [float("nan")] * 8), (4300, [float("inf")] + [0.0] * 7), (None, out[0][1]), (4400, [0.5, 0.25]), (4500, []), (4600, [0.0] * 8)]
    return out


@pytest.mark.parametrize("subtree,fanout,sent", [(100_000, 8, mtree.SENT), (300, 8, mtree.SENT), (40, 3, mtree.SENT), (60, 8, 0)])
def test_top_k_equals_brute_force(spark, rows, subtree, fanout, sent):
    assert run(spark, rows, k=10, subtree=subtree, fanout=fanout, sent=sent) == brute(rows, 10)


@pytest.mark.parametrize("size,subtree", [(2**10, 40), (2**20, 40), (2**32, 40), (2**46, 40), (2**32, 100_000), (2**70, 100_000)])
def test_large_components(spark, size, subtree):
    """Scaled components of 2**20, 2**30, 2**42 and 2**56, and beyond the bound: the ranks are those of the exact scores."""
    rng = np.random.default_rng(9)
    rows = [(i, [float(size) * x for x in v]) for i, v in enumerate(rng.integers(-8, 9, (300, 4)).tolist())] + [(700, [float(size) * 4, 0.0]), (800, [float(size) * 4, 0.0]), (801, [0.0, float(size)])]
    assert run(spark, rows, k=5, subtree=subtree, fanout=4) == brute(rows, 5)


def test_few_vectors_and_none(spark):
    some = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (100, [3.0])]
    assert run(spark, some) == brute(some, 10)
    assert run(spark, []) == Counter()
    assert run(spark, [(0, None)]) == Counter()


def test_most_leaves_do_not_receive_a_query(spark, rows):
    made = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows if v and i is not None and all(x is not None and np.isfinite(x) for x in v)]
    ints = spark.createDataFrame(made, "vec_id long, v array<long>")
    norm2 = float(max(sum(x * x for x in v) for _, v in made))
    leaves, nodes, levels = mtree.grow(mtree.candidates(ints, 10), 8, norm2, 60, 8)
    assert levels > 1
    queries = ints.where("vec_id % 100 = 0").distinct().selectExpr("vec_id", "xxhash64(v) AS q", "v", "aggregate(v, 0D, (s, x) -> s + x * x) AS q2")
    asked = mtree.within_reach(queries.selectExpr("*", f"sqrt(q2 + {norm2} - 1.9 * q2) AS reach"), nodes, levels, norm2)
    assert 0 < asked.count() < 0.5 * queries.count() * nodes.where("leaf").count()
    inside = leaves.groupBy("node").count().count()
    assert inside == nodes.where("leaf").count()
