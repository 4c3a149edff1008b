"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed n-grams of the lower-cased characters, weighted by their
relative frequency in the text and by the inverse document frequency over all
training documents. The regression is trained by follow-the-regularised-leader
with elastic-net penalties, which keeps most weights at zero, and a temperature
fitted on training documents set aside calibrates its probabilities.

Document frequencies cover every training document. The regression is fitted to
a bounded sample: at most ``PER_LANG`` documents of each language and ``SAMPLE``
in all, those with the least hashes. Every text is predicted whole.

A text that is null or has no letter is ``und`` with score 0, as is every text
if nothing could be learned. Rows without lang or doc_id are not learned from;
rows that repeat all three are learned from once and predicted each.
Ties between languages go to the one first by code point.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words as W
from .common import least_hashes, stash

BITS, ORDERS, PER_LANG, SAMPLE, EPOCHS, FOLDS = 15, (1, 2, 3), 2000, 8000, 2, 5
ALPHA, BETA, L1, L2, SCALE = 0.5, 1.0, 1e-4, 1e-4, 20.0
WIDTH = 1 << BITS


def features(column: pa.Array) -> tuple[list[np.ndarray], np.ndarray]:
    """For each order the feature of the n-gram at every character (``WIDTH``: none begins there), and the rows' offsets."""
    column = pc.fill_null(column, "")
    points = np.frombuffer("".join(column.to_pylist()).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    offsets = np.concatenate(([0], np.cumsum(pc.utf8_length(column).to_numpy()))).astype(np.int64)
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(points))  # characters up to the row's end
    out, h = [], np.zeros(len(points), np.uint64)
    spread = points * W._PLACE[3]
    for n in range(1, max(ORDERS) + 1):
        h[: len(points) - n + 1] = h[: len(points) - n + 1] * W._PLACE[4] + spread[n - 1 :]
        if n in ORDERS:
            f = (W.mixed(h + np.uint64(n)) >> np.uint64(64 - BITS)).astype(np.int64)
            f[left < n] = WIDTH
            out.append(f)
    return out, offsets


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """How many documents have each feature, over all of ``docs``: WIDTH numbers reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(WIDTH, np.int64), 0
        for batch in batches:
            for part in W.pieces(batch):
                orders, offsets = features(part.column("text"))
                for a, b in zip(offsets[:-1], offsets[1:]):
                    seen = np.zeros(WIDTH + 1, bool)
                    for f in orders:
                        seen[f[a:b]] = True
                    total += seen[:WIDTH]
                n += part.num_rows
        k = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(k, -1).astype(np.int32)), pa.array(np.append(total[k], n))], names=["feature", "n"])

    rows = docs.select("text").mapInArrow(run, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).toArrow()
    feature, n = rows.column("feature").to_numpy(), rows.column("n").to_numpy()
    out = np.zeros(WIDTH, np.int64)
    out[feature[feature >= 0]] = n[feature >= 0]
    return out, int(n[feature < 0].sum())


def _rows(column: pa.Array, idf: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The sparse TF-IDF row of each text: six bytes a feature, as all rows of the sample are held at once."""
    orders, offsets = features(column)
    for a, b in zip(offsets[:-1], offsets[1:]):
        f = np.concatenate([x[a:b] for x in orders])
        k, n = np.unique(f[f < WIDTH], return_counts=True)
        yield k.astype(np.uint16), (SCALE * idf[k] * n / max(1, n.sum())).astype(np.float32)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def fit(rows: list, y: np.ndarray, classes: int, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Weights (WIDTH x classes) by FTRL-proximal, and the temperature that suits every tenth of the sparse ``rows`` best."""
    aside = np.arange(len(rows)) % 10 == 9
    z, n = np.zeros((WIDTH, classes)), np.zeros((WIDTH, classes))

    def weights(k: np.ndarray) -> np.ndarray:
        w = -(z[k] - np.sign(z[k]) * L1) / ((BETA + np.sqrt(n[k])) / ALPHA + L2)
        return np.where(np.abs(z[k]) > L1, w, 0)

    for _ in range(epochs):
        for i in np.flatnonzero(~aside):
            k, x = rows[i]
            w = weights(k)
            p = _softmax(x @ w)
            p[y[i]] -= 1
            g = x[:, None] * p
            z[k] += g - (np.sqrt(n[k] + g * g) - np.sqrt(n[k])) / ALPHA * w
            n[k] += g * g
    w = weights(np.arange(WIDTH))
    held = np.flatnonzero(aside)
    if not len(held):
        return w, 1.0
    logits = np.array([rows[i][1] @ w[rows[i][0]] for i in held])
    loss = lambda t: -np.log(_softmax(logits / t)[np.arange(len(held)), y[held]] + 1e-12).mean()
    return w, float(min(np.exp(np.linspace(-3, 3, 121)), key=loss))


def train(docs: DataFrame, per_lang: int = PER_LANG, sample: int = SAMPLE):
    """``(languages, weights, temperature)`` learned from ``docs(doc_id, text, lang)``, or None without any."""
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL")
    df, n = document_frequencies(known)
    idf = np.log((1 + n) / (1 + df)) + 1
    order = Window.partitionBy("lang").orderBy("_h", "doc_id")
    known = known.withColumn("_h", F.xxhash64("doc_id", "text"))
    ids = least_hashes(known.select("doc_id", "lang", "_h"), "lang", "_h", per_lang, "langid").distinct()  # repeated rows count once
    ids = ids.withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= per_lang)
    ids = ids.orderBy("_k", "lang", "doc_id").limit(sample).select("doc_id", "lang", "_h")
    some = known.join(F.broadcast(stash(ids, "langid-ids")), ["doc_id", "lang", "_h"])  # at most ``sample`` rows
    some = some.select("doc_id", "text", "lang", "_h").dropDuplicates(["doc_id", "lang", "_h"])
    some = stash(some.orderBy("_h", "doc_id").coalesce(1), "langid-sample")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, langs = [], []
        for batch in batches:
            for part in W.pieces(batch):  # texts are let go once they are sparse rows
                rows.extend(_rows(part.column("text"), idf))
                langs.extend(part.column("lang").to_pylist())
        if not rows:
            return
        names = sorted(set(langs))
        w, t = fit(rows, np.searchsorted(names, langs), len(names))
        k = np.flatnonzero(w.any(1))
        yield pa.RecordBatch.from_arrays([pa.array([names], pa.list_(pa.string())), pa.array([k.astype("<i4").tobytes()], pa.binary()), pa.array([w[k].astype("<f8").tobytes()], pa.binary()), pa.array([t])], names=["langs", "k", "w", "t"])

    got = some.coalesce(1).mapInArrow(run, "langs array<string>, k binary, w binary, t double").collect()
    if not got:
        return None
    w = np.zeros((WIDTH + 1, len(got[0].langs)), np.float32)
    w[np.frombuffer(got[0].k, "<i4")] = np.frombuffer(got[0].w, "<f8").reshape(-1, len(got[0].langs))
    w[:WIDTH] *= (SCALE * idf[:, None]).astype(np.float32)
    return list(got[0].langs), w, got[0].t


def predict(docs: DataFrame, model) -> DataFrame:
    """``docs`` without its text, with ``lang_pred`` and ``score``."""
    keep = [c for c in docs.columns if c != "text"]
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    if model is None:
        return docs.select(*keep, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    langs, w, temperature = model
    shared = docs.sparkSession.sparkContext.broadcast(w)  # WIDTH weights for each language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            for part in W.pieces(batch):
                orders, offsets = features(part.column("text"))
                size = np.diff(offsets)
                some = np.flatnonzero(size > 0)
                logits = np.zeros((part.num_rows, len(langs)))
                for f in orders:
                    if len(some):
                        for c in range(len(langs)):
                            logits[some, c] += np.add.reduceat(w[:, c][f].astype(np.float64), offsets[:-1][some])
                n = sum(np.maximum(size - k + 1, 0) for k in ORDERS)
                p = _softmax(logits / np.maximum(n, 1)[:, None] / temperature)
                ok = part.column("_letters").to_numpy(zero_copy_only=False)
                best = p.argmax(1)
                names = pa.array([langs[b] if x else "und" for b, x in zip(best, ok)])
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), names, pa.array(np.where(ok, p[np.arange(len(p)), best], 0.0))], names=[*keep, "lang_pred", "score"])

    lowered = docs.select(*keep, F.lower("text").alias("text"), letters.alias("_letters"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    return lowered.mapInArrow(run, f"{schema}, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)``: learned from documents not held out, predicted for all."""
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS))
    docs = docs.select("doc_id", "text", "lang", F.coalesce(fold == 0, F.lit(False)).alias("held_out"))
    learned = docs.where("NOT held_out AND doc_id IS NOT NULL").select("doc_id", F.lower("text").alias("text"), "lang")
    return predict(docs.select("doc_id", "held_out", "text"), train(learned))
