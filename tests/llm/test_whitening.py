"""Whitening: the spectrum against a dense solver, and the operator against exact integers."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from tapeloom.llm import queries as Q
from tapeloom.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, x int, i int, component string"


@pytest.mark.parametrize("d", [1, 2, 3, 9, 64])
@pytest.mark.parametrize("kind", ["spread", "equal", "two", "falling", "integers", "zero"])
def test_spectrum(d, kind):
    rng = np.random.default_rng(d)
    q = np.linalg.qr(rng.normal(size=(d, d)))[0]
    e = {"spread": rng.random(d) + 0.1, "equal": np.ones(d), "two": np.repeat([3.0, 1.0], [d // 2, d - d // 2]), "falling": 10.0 ** -np.minimum(np.arange(d), 14), "integers": np.arange(d) * 1.0, "zero": np.zeros(d)}[kind]
    a = (q * e) @ q.T
    a = (a + a.T) / 2
    w, v = whitening.spectrum(a, 8)
    scale = max(1.0, np.linalg.norm(a))
    assert np.abs(w - np.sort(e)[::-1][:8]).max() < 1e-13 * scale
    assert np.linalg.norm(a @ v - v * w) < 1e-13 * scale and np.linalg.norm(v.T @ v - np.eye(v.shape[1])) < 1e-13


def check(rows, got, dims):
    """``got`` rows against integer arithmetic and a dense solver."""
    kept = [(i, [math.floor(1024 * float(c)) + 100_000 for c in v] + [100_000] * (dims - len(v))) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    n, x = len(kept), [v for _, v in kept]
    s = [sum(c) for c in zip(*x)]
    assert len(got) == n * min(8, dims) and {r["n"] for r in got} == {n}
    deviation = {}
    for i, v in kept:
        deviation.setdefault(i, []).append(sum((n * c - t) ** 2 for c, t in zip(v, s)))
    for i in deviation:
        assert sorted(r["deviation"] for r in got if r["vec_id"] == i and r["component"] == 1) == sorted(deviation[i])
    y = np.array([[float(Fraction(n * c - t, n)) for c, t in zip(v, s)] for v in x])
    e, q = np.linalg.eigh(y.T @ y / n)
    e, q = e[::-1], q[:, ::-1]
    for k in range(min(8, dims)):
        mine = {i: [] for i in deviation}
        for r in got:
            if r["component"] == k + 1:
                mine[r["vec_id"]].append(r["whitened"])
                assert r["explained"] == pytest.approx(e[k] / e.sum(), rel=1e-9)
                assert r["identity_error"] < 1e-10
        z = y @ q[:, k] / np.sqrt(e[k])
        theirs = {i: [] for i in deviation}
        for (i, _), value in zip(kept, z):
            theirs[i].append(value)
        a = np.concatenate([np.sort(mine[i]) for i in mine])
        sign = 1 if abs(a - np.concatenate([np.sort(theirs[i]) for i in mine])).max() < 1e-6 else -1
        assert np.abs(a - np.concatenate([np.sort(sign * np.array(theirs[i])) for i in mine])).max() < 1e-7


def test_given_vectors(spark, tables):
    rows = [tuple(r) for r in spark.read.parquet(f"{tables}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(rows, Q.op12_whitening(spark, tables).collect(), 64)


def test_vectors_left_out_repeated_and_short(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=9).astype(np.float32).tolist()) for i in range(300)]
    rows += [(1, rows[1][1]), (None, rows[2][1]), (400, [0.5] * 4), (401, []), (402, None), (403, [float("nan")] * 9), (404, [None] + [0.0] * 8), (405, [float("inf")] + [0.0] * 8)]
    got = whitening.whiten(spark.createDataFrame([(i, v, 1, 2, "c") for i, v in rows], SCHEMA).repartition(4)).collect()
    check(rows, got, 9)


def test_nothing_to_whiten(spark):
    one = lambda rows: whitening.whiten(spark.createDataFrame([(i, v, 1, 2, "c") for i, v in rows], SCHEMA)).collect()
    assert one([]) == [] and one([(1, None)]) == [] and one([(1, [])]) == []
    single = one([(7, [0.25, -3.0])])
    assert [(r["vec_id"], r["component"], r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in single] == [(7, 1, 1, 0, None, None, None), (7, 2, 1, 0, None, None, None)]
    flat = one([(1, [0.0, 5.0]), (2, [1.0, 5.0])])  # the second dimension does not vary
    assert [(r["deviation"], r["whitened"] is None, r["explained"]) for r in flat if r["component"] == 2] == [(1024 * 1024, True, 0.0)] * 2
    assert sorted(r["whitened"] for r in flat if r["component"] == 1) == pytest.approx([-1, 1])


def test_numbers_beyond_a_long():
    num = whitening.numerators(np.array([[2**50, 5]]), 2**20, [7, 2**40])
    assert num.tolist() == [[2**70 - 7, 5 * 2**20 - 2**40]]
    assert whitening.deviations(num) == [None]
    assert whitening.deviations(np.array([[3_037_000_499, 0], [3_037_000_500, 0], [3, 4]])) == [3_037_000_499**2, None, 25]


def test_large_entries(spark):
    got = whitening.whiten(spark.createDataFrame([(1, [1e30]), (2, [-1e30]), (3, [0.0])], "vec_id long, embedding array<double>")).collect()
    assert {r["vec_id"]: r["deviation"] for r in got} == {1: None, 2: None, 3: 0} and all(math.isfinite(r["whitened"]) for r in got)
