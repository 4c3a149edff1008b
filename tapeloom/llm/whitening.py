"""Whitening of embeddings by spectral divide and conquer.

Spark sums: one pass gives the count and every dimension's exact sum, the next
the covariance of the centred vectors, a third checks the whitened ones. Only
sums of as many entries as there are pairs of dimensions reach the driver,
whatever the number of rows; the matrix sent back has one row for each
dimension and at most ``most`` columns.

The eigenvectors of the covariance come from polar decompositions. Shifted by
its mean eigenvalue, the matrix has eigenvalues on both sides of zero; its
orthogonal polar factor U, found by the dynamically weighted Halley iteration
with a QR decomposition in each step (QDWH), has the same eigenvectors with
eigenvalues 1 and -1, so (1 + U) / 2 projects on the invariant subspace of the
greater ones. Each of the two subspaces is split in the same way, the greater
first, until single components are left or enough are known.

Entries are taken as integers, so the centred numerators n*x - S are exact; only
the division by n rounds.

Vectors that are null or hold null or non-finite entries are dropped. Shorter
vectors count as padded with zeros; rows with a null vec_id and repeated rows
take part like any other, and ties between eigenvalues leave any basis of their
subspace. ``deviation`` is null where a long cannot hold it; ``whitened`` is null
for components without variance (one row, equal rows), and ``explained`` too if
nothing varies at all. Entries beyond 2**53 once scaled count as that bound. An
empty table, or one with empty vectors only, has no rows. No column but vec_id
and embedding is read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stash

MOST, UNIT, OFFSET, BOUND = 8, 1024, 100_000, 2**53
_LONG = 2**63 - 1


def integers(vectors: DataFrame, unit: int = UNIT, offset: int = OFFSET) -> DataFrame:
    """``(vec_id, x)``: floor(unit * c) + offset of every entry of the vectors that take part."""
    as_double = F.transform("embedding", lambda c: c.cast("double"))
    finite = F.forall("_v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    out = vectors.select(F.col("vec_id").cast("long"), as_double.alias("_v")).where(F.col("_v").isNotNull() & finite)
    scaled = lambda c: F.greatest(F.least(c * unit, F.lit(float(BOUND))), F.lit(-float(BOUND)))
    return out.select("vec_id", F.transform("_v", lambda c: F.floor(scaled(c)) + offset).alias("x"))


def matrix(column: pa.Array, dims: int, blank: int) -> np.ndarray:
    """A list column as rows of ``dims`` integers, shorter lists filled up with ``blank``."""
    size = np.diff(column.offsets.to_numpy())
    out = np.full((len(column), dims), blank, np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)] = column.flatten().to_numpy()
    return out


def column_sums(rows: DataFrame, dims: int, blank: int) -> tuple[int, list[int]]:
    """The number of rows and the exact sum of every dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dims
        for batch in batches:
            x = matrix(batch.column("x"), dims, blank)
            n += len(x)  # high and low halves apart: neither sum can leave a long
            total = [t + (int(h) << 32) + int(lo) for t, h, lo in zip(total, (x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0))]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array([n] * dims, pa.int64()), pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))], names=["i", "n", "s"])

    sums = rows.select("x").mapInArrow(run, "i int, n long, s decimal(38,0)").groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()
    by = {r["i"]: r for r in sums}
    return int(by[0]["n"]), [int(by[i]["s"]) for i in range(dims)]


def numerators(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, as longs where they fit."""
    most = max(int(np.abs(x).max(initial=0)) * n, max(map(abs, sums)))
    if most < 2**62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def deviations(num: np.ndarray) -> list[int | None]:
    """The sum of squares of each row, null where a long cannot hold it."""
    rough = (num.astype(np.float64) ** 2).sum(1)
    if num.dtype != object and rough.max(initial=0) < 9e18:
        return (num * num).sum(1).tolist()
    exact = [sum(int(v) ** 2 for v in row) if r < 1e19 else None for row, r in zip(num.tolist(), rough)]
    return [v if v is not None and v <= _LONG else None for v in exact]


def products(rows: DataFrame, of: Callable[[pa.RecordBatch], np.ndarray], width: int) -> np.ndarray:
    """The sum over all rows of the outer products of the vectors that ``of`` makes of a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            y = of(batch)
            total += y.T @ y
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], names=["i", "j", "v"])

    out = np.zeros((width, width))
    for i, j, v in rows.select("x").mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[i, j] = out[j, i] = v
    return out


# The spectrum of a symmetric matrix


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix by QDWH; the weights follow a lower bound of the least singular value."""
    x = a / np.linalg.norm(a)
    low, eye = 1e-16, np.eye(len(a))
    for _ in range(12):
        l2 = low * low
        d = (4 * (1 - l2) / (l2 * l2)) ** (1 / 3)
        root = np.sqrt(1 + d)
        p = root + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - l2) / (l2 * root))
        q = (p - 1) ** 2 / 4
        r = p + q - 1
        both = np.linalg.qr(np.concatenate((np.sqrt(r) * x, eye)))[0]
        top, bottom = both[: len(a)], both[len(a) :]
        new = q / r * x + (p - q / r) / np.sqrt(r) * top @ bottom.T
        new = (new + new.T) / 2
        moved = np.linalg.norm(new - x)
        x, low = new, min(low * (p + q * l2) / (1 + r * l2), 1.0)
        if moved < 1e-5 and low > 1 - 1e-8:  # cubic: the step after such a one is below rounding
            break
    return x


def split(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces above and below a shift; none if all eigenvalues are one."""
    d = len(a)
    mean = np.trace(a) / d
    spread = np.linalg.norm(a - mean * np.eye(d)) / np.sqrt(d)
    rng = np.random.default_rng(d)
    for step in (0.0, 0.31, -0.31, 0.17, -0.17, 0.53, -0.53, 0.05, -0.05, 0.71, -0.71):  # another shift where an eigenvalue lies on this one
        u = polar(a - (mean + step * spread) * np.eye(d))
        above = (u + np.eye(d)) / 2
        k = int(round(np.trace(above)))
        if not 0 < k < d or np.linalg.norm(above @ above - above) > 1e-10 * d:
            continue
        upper, lower = rng.normal(size=(d, k)), rng.normal(size=(d, d - k))
        for _ in range(2):
            upper, lower = np.linalg.qr(above @ upper)[0], np.linalg.qr(lower - above @ lower)[0]
        return upper, lower
    return None


def spectrum(a: np.ndarray, most: int, floor: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` greatest eigenvalues, falling, and their unit eigenvectors as columns."""
    d = len(a)
    floor = np.finfo(float).eps * np.linalg.norm(a) if floor is None else floor
    if d == 1 or np.linalg.norm(a - np.trace(a) / d * np.eye(d)) <= floor * d:
        order = np.argsort(-np.diag(a), kind="stable")[:most]
        return np.diag(a)[order], np.eye(d)[:, order]
    halves = split(a)
    if halves is None:
        raise ArithmeticError("no shift separates the spectrum")
    values, vectors = [], []
    for basis in halves:
        inner = basis.T @ a @ basis
        e, v = spectrum((inner + inner.T) / 2, most - sum(map(len, values)), floor)
        values.append(e)
        vectors.append(basis @ v)
        if sum(map(len, values)) >= most:
            break
    e, v = np.concatenate(values), np.linalg.qr(np.concatenate(vectors, 1))[0]
    order = np.argsort(-e, kind="stable")
    return e[order], v[:, order]


def whiten(vectors: DataFrame, most: int = MOST, unit: int = UNIT, offset: int = OFFSET) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` for every row that takes part and each of its components."""
    spark = vectors.sparkSession
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = stash(integers(vectors, unit, offset), "whitening-vectors")
    dims = rows.agg(F.max(F.size("x"))).first()[0]
    if not dims:
        return spark.createDataFrame([], schema)
    n, sums = column_sums(rows, dims, offset)
    centred = lambda batch: (numerators(matrix(batch.column("x"), dims, offset), n, sums) / n).astype(np.float64)
    covariance = products(rows, centred, dims) / n
    trace = float(np.trace(covariance))
    e, v = spectrum(covariance, min(most, dims))
    e = np.maximum(e, 0)
    live = e > dims * np.finfo(float).eps * trace
    scale = np.where(live, v / np.sqrt(np.where(live, e, 1)), np.nan)
    count, shares = len(e), [float(x) / trace if trace > 0 else None for x in e]
    error = None
    if live.any():  # vectors are centred, so their whitened ones are
        use = scale[:, live]
        error = float(np.abs(products(rows, lambda batch: centred(batch) @ use, use.shape[1]) / n - np.eye(use.shape[1])).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                num = numerators(matrix(batch.column("x"), dims, offset), n, sums)
                out = ((num / n).astype(np.float64) @ np.where(live, scale, 0.0)).ravel()
                rows_n = batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").take(pa.array(np.repeat(np.arange(rows_n), count))),
                        pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), rows_n)),
                        pa.array(np.full(rows_n * count, n)),
                        pa.array(deviations(num), pa.int64()).take(pa.array(np.repeat(np.arange(rows_n), count))),
                        pa.array(out, mask=np.tile(~live, rows_n)),
                        pa.array(shares * rows_n, pa.float64()),
                        pa.array([error] * (rows_n * count), pa.float64()),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(run, schema)
