"""Document rules and host-level verdicts.

The base rules are computed from whole texts in one pass. The failures of each
rule, and of any, are summed by host (``source``; null is a host of its own).
Every host's rates are shrunk towards beta priors, one for each rule, and a host
with a shrunk rate above ``most`` loses all its documents.

A prior is the beta-binomial that fits all hosts by moments: its mean is the
rate over all documents, its strength comes from the variance between hosts
beyond what sampling alone gives (hosts weigh by their documents). Where hosts
do not differ beyond that, or there is but one, the strength is
``STRONGEST_PRIOR``.

Null and empty texts have no words, so they fail the base rules. A null doc_id
or repeated rows are judged like any other row, each counting once for its
host; a rate of exactly ``most`` is spared. No column but doc_id, text and
source is read, and others may have any names. Lines and windows are compared
within one text by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import arrow_map, stash

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
LEAST_WORDS, MOST_REPEATED, MOST_HOST_RATE, STRONGEST_PRIOR = 50, 50, 0.5, 10_000.0
#: Rules whose failures are summed by host; the last is any of the others.
RULES = ("few", "repeated", "failed")
FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _repeats(key: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Groups of equal (key, row): for each entry its place in the group, -1 if it is alone."""
    both = W.mixed(key ^ (row.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
    order = np.argsort(both, kind="stable")
    k, r, n = key[order], row[order], len(key)
    same = np.zeros(n + 1, bool)
    same[1:n] = (k[1:] == k[:-1]) & (r[1:] == r[:-1])
    place = np.full(n, -1, np.int64)
    begin = np.maximum.accumulate(np.where(same[:n], 0, np.arange(n)))
    within = np.arange(n) - begin
    place[order] = np.where(same[:n] | same[1:], within, -1)
    return place


def features(texts: pa.Array) -> list[np.ndarray]:
    """The columns of FEATURES for a column of texts."""
    w = W.find(texts)
    n = len(w.offsets) - 1
    inside = ~W.SEPARATOR[w.data] & ((w.data & 0xC0) != 0x80)
    upto = lambda flags: np.diff(np.concatenate(([0], np.cumsum(flags)))[w.offsets])
    chars, symbols = upto(inside), upto(SYMBOLS[w.data])
    # lines with a word
    breaks = np.flatnonzero(w.data == 10)
    begins = np.sort(np.concatenate((w.offsets[:-1], breaks + 1)))
    row = np.searchsorted(w.offsets, begins, side="right") - 1
    stops = np.sort(np.concatenate((w.offsets[1:], breaks)))
    ok = np.searchsorted(w.starts, stops) > np.searchsorted(w.starts, begins)
    begins, stops, row = begins[ok], stops[ok], row[ok]
    again = _repeats(W.span_hashes(w.data, begins, stops), row) > 0 if len(begins) else np.zeros(0, bool)
    dup_lines = np.bincount(row[again], minlength=n)
    # words in windows of three that come twice
    g, ok = W.grams(w.hashes(), w.row, 3)
    at = np.flatnonzero(ok)
    covered = np.zeros(len(w.row) + 1, np.int64)
    if len(at):
        at = at[_repeats(g[at], w.row[at]) >= 0]
        np.add.at(covered, at, 1)
        np.add.at(covered, at + 3, -1)
    covered = np.cumsum(covered[:-1]) > 0
    repeated = np.bincount(w.row[covered], minlength=n)
    return [w.counts, chars, symbols, dup_lines, repeated]


def _mapped(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``k0, k1, ...`` (the columns ``keep``, which may have any names), the base features and a flag for each rule."""
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    names = [f"k{i}" for i in range(len(keep))]
    docs = docs.select(*(F.col(f"`{c}`").alias(k) for c, k in zip(keep, names)), F.col("text").alias("t"))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in W.pieces(batch, "t"):
            got = [pa.array(x, pa.int64()) for x in features(part.column("t"))]
            yield pa.RecordBatch.from_arrays([part.column(k) for k in names] + got, names=[*names, *FEATURES])

    out = arrow_map(docs, run, ", ".join([f"{k} {kinds[c]}" for c, k in zip(keep, names)] + [f"{f} long" for f in FEATURES]))
    few = F.col("n_words") < LEAST_WORDS
    repeated = 100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    return out.withColumns({"few": few, "repeated": repeated, "failed": few | repeated})


def base(docs: DataFrame) -> DataFrame:
    """``(doc_id, source, *FEATURES, few, repeated, failed)`` of every document."""
    return _mapped(docs, ["doc_id", "source"]).withColumnsRenamed({"k0": "doc_id", "k1": "source"})


def hosts(judged: DataFrame, most: float = MOST_HOST_RATE) -> DataFrame:
    """``(source, n_docs, n_<rule>, rate_<rule> ..., rejected)`` of every host."""
    by = judged.groupBy("source").agg(F.count("*").alias("n_docs"), *(F.sum(F.col(r).cast("long")).alias(f"n_{r}") for r in RULES))
    by = stash(by, "quality-hosts")
    n, many, all_ = F.col("n_docs"), F.count("*"), F.sum("n_docs")
    whole = by.agg(all_.alias("docs"), many.alias("hosts"), ((all_ - F.sum(n * n) / all_) / F.nullif(many - 1, F.lit(0))).alias("usual"), *(F.sum(f"n_{r}").alias(f"all_{r}") for r in RULES))
    spread = by.join(F.broadcast(whole), F.lit(True))  # one row
    sums = []
    for r in RULES:
        p, m = F.col(f"n_{r}") / n, F.col(f"all_{r}") / F.col("docs")
        sums += [F.sum(n * (p - m) * (p - m)).alias(f"b_{r}"), F.sum(n * p * (1 - p)).alias(f"w_{r}")]
    prior = spread.groupBy("docs", "hosts", "usual", *(f"all_{r}" for r in RULES)).agg(*sums)
    columns = []
    for r in RULES:
        between = F.col(f"b_{r}") / F.nullif(F.col("hosts") - 1, F.lit(0))
        within = F.col(f"w_{r}") / F.nullif(F.col("docs") - F.col("hosts"), F.lit(0))
        alike = (between - within) / F.nullif(between + (F.col("usual") - 1) * within, F.lit(0.0))
        strength = F.when(alike > 1 / (STRONGEST_PRIOR + 1), 1 / F.least(alike, F.lit(1.0)) - 1).otherwise(F.lit(STRONGEST_PRIOR))
        columns += [(F.col(f"all_{r}") / F.col("docs")).alias(f"m_{r}"), strength.alias(f"s_{r}")]
    out = by.join(F.broadcast(prior.select(*columns)), F.lit(True))  # one row
    out = out.withColumns({f"rate_{r}": (F.col(f"n_{r}") + F.col(f"m_{r}") * F.col(f"s_{r}")) / (n + F.col(f"s_{r}")) for r in RULES})
    out = out.withColumn("rejected", F.greatest(*(f"rate_{r}" for r in RULES)) > most)
    return stash(out.select("source", "n_docs", *(f"n_{r}" for r in RULES), *(f"rate_{r}" for r in RULES), "rejected"), "quality-verdicts")


def judge(docs: DataFrame, most: float = MOST_HOST_RATE) -> DataFrame:
    """Every document's features, ``base_failed``, its host's shrunk ``host_rate`` of failures and ``kept``."""
    judged = stash(base(docs), "quality-base")
    verdict = hosts(judged, most).select(F.col("source").alias("host"), F.col("rate_failed").alias("host_rate"), "rejected")
    out = judged.join(verdict, judged["source"].eqNullSafe(verdict["host"]), "left")
    return out.select("doc_id", *FEATURES, F.col("failed").alias("base_failed"), (~F.col("failed") & ~F.col("rejected")).alias("kept"), "host_rate")


def keep(docs: DataFrame, most: float = MOST_HOST_RATE) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns; texts are not shuffled."""
    columns = docs.columns
    rejected = hosts(base(docs), most).where("rejected").select(F.col("source").alias("host"))
    passed = _mapped(docs, columns).where("NOT failed")
    source = F.col(f"k{columns.index('source')}")
    kept = passed.join(rejected, source.eqNullSafe(rejected["host"]), "left_anti")
    return kept.select(*(F.col(f"k{i}").alias(c) for i, c in enumerate(columns)))
