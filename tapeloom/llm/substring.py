"""Substring deduplication by seed and extend.

Seeds are winnowed anchors: of every ``WINNOW`` consecutive ``SEED``-word
hashes the least, so that two equal runs of ``LENGTH`` words choose the same
anchor at the same place. Documents are joined on their anchors, and only
anchors that two documents share go on. Such a seed is extended both ways:

* as far as any window with the anchor reaches. If the whole stretch also stands in a
  document with a smaller id, all of it repeats; that settles the inside of a
  repeat with one row for each anchor.
* where the stretch is the first of its kind but its anchor has other
  surroundings elsewhere, by every split of the missing words between left and
  right; equal extensions meet under one key, so a passage that a third of all
  documents hold needs as many rows as it has copies, never pairs of them.

Overlapping extensions join to maximal repeats of at least ``LENGTH`` words,
which are removed in all but the document with the least id.

Null texts have no words. Rows without a doc_id remove nothing and keep all.
Rows with one doc_id are one document: they do not remove each other's words,
and come back as often as they occur. Windows are compared by two independent
64-bit hashes, stretches by 96 bits beside the 64 of their anchor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import arrow_map, shared_keys, stash

LENGTH, SEED = 13, 5


def anchors(h: np.ndarray, row: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the winnowed anchors."""
    g, _ = W.grams(h, row, seed)
    many = length - seed + 1
    size = len(h) - length + 1
    if size <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    best, at = g[:size].copy(), np.arange(size)
    for j in range(1, many):
        other = g[j : j + size]
        less = other < best
        best[less] = other[less]
        at[less] = np.flatnonzero(less) + j
    chosen = np.zeros(len(g), bool)
    chosen[at[row[:size] == row[length - 1 : length - 1 + size]]] = True
    where = np.flatnonzero(chosen)
    return where, g[where]


def stretches(h: np.ndarray, h2: np.ndarray, row: np.ndarray, at: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, of 64 and of 32 bits, of all the words that windows with the anchor cover, cut off at the document's ends."""
    reach = length - seed
    total, other = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
    own = row[at]
    for k, j in enumerate(range(-reach, length)):
        where = at + j
        ok = (where >= 0) & (where < len(h))
        where = np.where(ok, where, 0)
        ok &= row[where] == own
        total += np.where(ok, h2[where] * W._PLACE2[k], 0)
        other += np.where(ok, h[where] * W._PLACE[k], 0)
    return W.mixed(total), (W.mixed(other) >> np.uint64(32)).astype(np.uint32)


def _occurrences(docs: DataFrame, length: int, seed: int) -> DataFrame:
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in W.pieces(batch):
            w = W.find(part.column("text"))
            h = w.hashes()
            at, key = anchors(h, w.row, length, seed)
            ids = part.column("doc_id").to_numpy()[w.row[at]]
            stretch, more = stretches(h, w.hashes(second=True), w.row, at, length, seed)
            yield pa.RecordBatch.from_arrays(
                [pa.array(W.signed(key)), pa.array(W.signed(stretch)), pa.array(more.view(np.int32)), pa.array(ids), pa.array((at - w.first[w.row[at]]).astype(np.int32))],
                names=["anchor", "stretch", "more", "doc_id", "pos"],
            )

    return arrow_map(docs, run, "anchor long, stretch long, more int, doc_id long, pos int")


def _windows(docs: DataFrame, length: int, seed: int) -> DataFrame:
    """``(w1, w2, doc_id, pos)``: every window around the anchors at ``open`` of each document."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in W.pieces(batch):
            w = W.find(part.column("text"))
            h = w.hashes()
            g1, ok = W.grams(h, w.row, length)
            g2, _ = W.grams(w.hashes(second=True), w.row, length, second=True)
            opened = part.column("open")
            row = np.repeat(np.arange(part.num_rows), np.diff(opened.offsets.to_numpy()))
            at = opened.flatten().to_numpy() + w.first[row]
            use = np.zeros(len(h) + 1, bool)
            for j in range(length - seed + 1):
                i = at - j
                i = i[(i >= w.first[row]) & (i < len(g1))]
                use[i] = True
            use = np.flatnonzero(use[: len(g1)] & ok)
            ids = part.column("doc_id").to_numpy()[w.row[use]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(W.signed(g1[use])), pa.array(W.signed(g2[use])), pa.array(ids), pa.array((use - w.first[w.row[use]]).astype(np.int32))],
                names=["w1", "w2", "doc_id", "pos"],
            )

    return arrow_map(docs, run, "w1 long, w2 long, doc_id long, pos int")


def repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """``(doc_id, first, last)``: stretches of words (``last`` not included) that also start in a smaller doc_id; they may overlap."""
    docs = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id IS NOT NULL")
    reach = length - seed
    seeds = stash(shared_keys(_occurrences(docs, length, seed), "anchor", "doc_id", "substring"), "substring-seeds")
    firsts = stash(seeds.groupBy("anchor", "stretch", "more").agg(F.min("doc_id").alias("earliest")), "substring-firsts")
    varied = firsts.groupBy("anchor").agg(F.min(F.struct("stretch", "more")).alias("_a"), F.max(F.struct("stretch", "more")).alias("_b")).where("_a <> _b").select("anchor")
    judged = seeds.join(firsts, ["anchor", "stretch", "more"])
    full = judged.where("doc_id > earliest").select("doc_id", (F.col("pos") - reach).alias("first"), (F.col("pos") + length).alias("last"))
    pending = judged.where("doc_id = earliest").join(stash(varied, "substring-varied"), "anchor", "left_semi")
    pending = pending.groupBy("doc_id").agg(F.collect_set("pos").alias("open"))
    windows = stash(_windows(docs.join(pending, "doc_id"), length, seed), "substring-windows")
    least = windows.groupBy("w1", "w2").agg(F.min("doc_id").alias("earliest"), F.max("doc_id").alias("_hi")).where("earliest <> _hi").select("w1", "w2", "earliest")
    again = windows.join(stash(least, "substring-least"), ["w1", "w2"]).where("doc_id > earliest").select("doc_id", F.col("pos").alias("first"), (F.col("pos") + length).alias("last"))
    return full.unionByName(again)


def covered(counts: np.ndarray, row: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Flags of the words (all rows' one after the other) that lie in a stretch."""
    begin = np.concatenate(([0], np.cumsum(counts)))
    delta = np.zeros(begin[-1] + 1, np.int64)
    low = np.clip(first, 0, counts[row])
    high = np.clip(last, low, counts[row])
    np.add.at(delta, begin[row] + low, 1)
    np.add.at(delta, begin[row] + high, -1)
    return np.cumsum(delta[:-1]) > 0


def dedup(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept)``: the text of the words that stay, joined by one space."""
    found = repeats(docs, length, seed).groupBy("doc_id").agg(F.collect_list(F.struct("first", "last")).alias("_spans"))
    docs = docs.select(F.col("doc_id").cast("long"), "text").join(stash(found, "substring-spans"), "doc_id", "left")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in W.pieces(batch):
            w = W.find(part.column("text"))
            spans = part.column("_spans")
            n = np.nan_to_num(pc.list_value_length(spans).to_numpy(zero_copy_only=False)).astype(np.int64)
            flat = spans.flatten()
            gone = covered(w.counts, np.repeat(np.arange(part.num_rows), n), flat.field("first").to_numpy(), flat.field("last").to_numpy())
            removed = np.bincount(w.row[gone], minlength=part.num_rows)
            kept = []
            raw = w.data.tobytes()
            for r in range(part.num_rows):
                at = np.arange(w.first[r], w.first[r + 1])
                if removed[r]:
                    at = at[~gone[at]]
                    kept.append(b" ".join([raw[a:b] for a, b in zip(w.starts[at].tolist(), w.ends[at].tolist())]))
                else:  # white space alone is to be replaced
                    kept.append(b" ".join(raw[w.offsets[r] : w.offsets[r + 1]].split()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(w.counts), pa.array(removed), pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

    return arrow_map(docs, run, "doc_id long, n_words long, n_removed long, kept string")


def digests(done: DataFrame) -> DataFrame:
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


__all__ = ["LENGTH", "SEED", "dedup", "digests", "repeats"]
