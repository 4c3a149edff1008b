"""Spelling variants: words one edit apart, found by search schemes on FM-indexes of the vocabulary.

Two words that differ by one inserted, deleted or replaced code point agree in
the first or in the last half of either. So each word is searched twice: its
last half exactly and then its first half with one error, moving left over an
index of the words; and its first half exactly and then its last half with one
error, moving right over an index of the reversed words. Both halves begin at a
delimiter, so a search always extends at one end only and the two indexes
together are the two directions.

An index covers the delimited words of one shard. It is the Burrows-Wheeler
transform of their suffixes with its positions in order of (character, place):
the rank of a character before any place, and so the next interval of suffixes,
is one binary search. All words of a shard move together, one code point a
step; the characters that can replace one are read off the transform, once for
all words with the same interval.

A search replaces characters by greater ones only, and deletes; the pair is then
listed from both sides, so nothing is searched twice. Of a run of equal letters
only the last to be reached is deleted, and a run over the middle only by the
leftward search: each pair comes up once.

Shards: every half has three code points or more, so words go by their last
(or first) three. If more than ``part`` words share these, they are indexed in
several shards, and each of them is searched in all: no shard grows with the
vocabulary, and nothing is dropped.

Null texts have no words, and repeated rows count as often as they occur. In
rows without a doc_id no code point is deleted. Texts and words may be of any
length. Ties go to the word that is smaller in code-point order. An empty table
has no result; other columns are not read.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import partitions, stash

LEAST_LENGTH, LEAST_COUNT, TIMES, DIVISOR = 7, 2, 10, 31
#: Words of an index that share three code points, and words of a shard on average.
PART, SHARD, CHUNK = 16_384, 32_768, 65_536


def noised(doc_id: Column, run: Column, divisor: int) -> Column:
    """The lower-cased run, without one of its code points if ``divisor`` divides the hash of document and run."""
    h = F.crc32(F.concat(doc_id.cast("string"), F.lit(":"), run))
    at = (h % F.length(run)).cast("int")
    less = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % divisor == 0, less).otherwise(run)


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, divisor: int = DIVISOR) -> DataFrame:
    """``(word, n)``: the words of all texts; shorter runs can give no word and are not even read."""
    runs = docs.select(F.col("doc_id").alias("_doc"), F.explode(F.regexp_extract_all("text", F.lit(f"[A-Za-zÀ-ÿ]{{{least_length},}}"), F.lit(0))).alias("_run"))
    lowered = F.when(F.col("_run").rlike("[A-Z]"), F.translate("_run", string.ascii_uppercase, string.ascii_lowercase)).otherwise(F.col("_run"))
    found = runs.select("_doc", lowered.alias("_run")).select(noised(F.col("_doc"), F.col("_run"), divisor).alias("word"))
    return found.where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


class Index:
    """FM-index over words (code sequences), each with a delimiter of its own below all characters."""

    def __init__(self, codes: np.ndarray, first: np.ndarray):
        m = len(first) - 1
        size = np.diff(first)
        self.n = n = len(codes) + m
        text = np.zeros(n, np.int64)
        word = np.repeat(np.arange(m), size + 1)
        inside = np.ones(n, bool)
        inside[first[1:] + np.arange(m)] = False
        text[inside] = codes
        rank, step = np.where(inside, text + m, word), 1
        while True:  # by the first two, four, eight ... characters, until all suffixes are told apart
            key = rank * (n + int(rank.max(initial=0)) + 1) + rank[np.minimum(np.arange(n) + step, n - 1)]
            order = np.argsort(key, kind="stable")
            key = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.concatenate(([0], np.cumsum(key[1:] != key[:-1])))
            step *= 2
            if rank[order[-1]] == n - 1:
                break
        self.m, self.word = m, word[order]
        self.bwt = text[order - 1]
        by = np.argsort(self.bwt.astype(np.uint16 if self.bwt.max(initial=0) < 65536 else np.int64), kind="stable")
        self.places = self.bwt[by] * n + by

    def extend(self, c: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The bound of the suffixes that begin with ``c`` and go on with those before ``at``."""
        return np.searchsorted(self.places, c * self.n + at)


def _children(index: Index, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
    """For each interval the characters that precede its suffixes: where its list begins and ends, and the lists' characters and intervals."""
    width = hi - lo
    which = np.repeat(np.arange(len(lo)), width)
    at = W.flat_ranges(lo, width)
    wide = int(index.bwt.max(initial=0)) + 1
    pair = np.unique(which * wide + index.bwt[at])
    which, c = pair // wide, pair % wide
    which, c = which[c > 0], c[c > 0]
    return np.searchsorted(which, np.arange(len(lo))), np.searchsorted(which, np.arange(len(lo)), side="right"), c, index.extend(c, lo[which]), index.extend(c, hi[which])


def search(index: Index, codes: np.ndarray, first: np.ndarray, exact: np.ndarray, over: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, word of the index): the query's last ``exact`` characters agree, one of the others is deleted or replaced by a greater one.

    ``over``: whether a run of equal characters that goes on into the exact half is left to the other search.
    """
    size = np.diff(first)
    found_q, found_w = [], []

    def finish(q: np.ndarray, lo: np.ndarray, hi: np.ndarray, rem: np.ndarray) -> None:
        """Match what is left exactly, then look for a word that begins there."""
        while len(q):
            done = rem == 0
            if done.any():
                a, b = index.extend(np.zeros(int(done.sum()), np.int64), lo[done]), index.extend(np.zeros(int(done.sum()), np.int64), hi[done])
                hit = b > a
                found_q.append(q[done][hit])
                found_w.append(index.word[index.places[a[hit]]])
                q, lo, hi, rem = (x[~done] for x in (q, lo, hi, rem))
            c = codes[first[q] + rem - 1]
            lo, hi = index.extend(c, lo), index.extend(c, hi)
            alive = hi > lo
            q, lo, hi, rem = q[alive], lo[alive], hi[alive], rem[alive] - 1

    q = np.arange(len(size))
    lo, hi, rem = np.zeros(len(q), np.int64), np.full(len(q), index.m, np.int64), size.copy()
    stop = size - exact
    ready = [[], [], []]
    while len(q):
        at_stop = rem == stop[q]
        for kept, x in zip(ready, (q, lo, hi)):
            kept.append(x[at_stop])
        q, lo, hi, rem = (x[~at_stop] for x in (q, lo, hi, rem))
        c = codes[first[q] + rem - 1]
        lo, hi = index.extend(c, lo), index.extend(c, hi)
        alive = hi > lo
        q, lo, hi, rem = q[alive], lo[alive], hi[alive], rem[alive] - 1
    q, lo, hi = (np.concatenate(x) for x in ready)
    rem = stop[q]
    c = codes[first[q] + rem - 1]
    crossing = over & (c == codes[first[q] + rem])
    while True:
        going = rem > 0
        q, lo, hi, rem, crossing = (x[going] for x in (q, lo, hi, rem, crossing))
        if not len(q):
            break
        c = codes[first[q] + rem - 1]
        same = np.zeros(len(q), bool)  # as the next character to the left
        inner = rem > 1
        same[inner] = codes[first[q[inner]] + rem[inner] - 2] == c[inner]
        cut = ~same & ~crossing
        finish(q[cut], lo[cut], hi[cut], rem[cut] - 1)
        both = lo * (index.n + 1) + hi
        each, which = np.unique(both, return_inverse=True)
        begin, end, char, low, high = _children(index, each // (index.n + 1), each % (index.n + 1))
        count = (end - begin)[which]
        state, child = np.repeat(np.arange(len(q)), count), W.flat_ranges(begin[which], count)
        greater = char[child] > c[state]
        state, child = state[greater], child[greater]
        finish(q[state], low[child], high[child], rem[state] - 1)
        lo, hi = index.extend(c, lo), index.extend(c, hi)
        alive = hi > lo
        q, lo, hi, rem, crossing = q[alive], lo[alive], hi[alive], rem[alive] - 1, (crossing & same)[alive]
    return (np.concatenate(found_q), np.concatenate(found_w)) if found_q else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _shard_pairs(words: list[str], n: np.ndarray, own: np.ndarray, leftward: bool) -> Iterator[pa.RecordBatch]:
    """``(word, near, near_n)`` from both sides of all pairs of a word and an indexed word of one shard."""
    oriented = words if leftward else [w[::-1] for w in words]
    letters = np.frombuffer("".join(oriented).encode("utf-32-le"), np.uint32)
    codes = np.unique(letters, return_inverse=True)[1].astype(np.int64) + 1
    size = np.array([len(w) for w in words], np.int64)
    first = np.concatenate(([0], np.cumsum(size)))
    held = np.flatnonzero(own)
    if not len(held):
        return
    index = Index(codes[np.repeat(own, size)], np.concatenate(([0], np.cumsum(size[held]))))
    column = pa.array(words, pa.string())
    for a in range(0, len(words), CHUNK):
        b = min(a + CHUNK, len(words))
        half = size[a:b] // 2
        exact = size[a:b] - half if leftward else half
        q, w = search(index, codes[first[a] : first[b]], first[a : b + 1] - first[a], exact, over=not leftward)
        q, w = q + a, held[w]
        left, right = np.concatenate((q, w)), np.concatenate((w, q))
        yield pa.RecordBatch.from_arrays([column.take(pa.array(left)), column.take(pa.array(right)), pa.array(n[right])], names=["word", "near", "near_n"])


def near_pairs(counted: DataFrame, part: int = PART, shard: int = SHARD) -> DataFrame:
    """``(word, near, near_n)``: every pair of words of ``counted(word, n)`` one edit apart, from both sides and once each."""
    spark = counted.sparkSession
    shards = max(partitions(spark), -(-counted.count() // shard))

    def laid(key: Column, side: int) -> DataFrame:
        rows = counted.withColumn("_key", key)
        parts = rows.groupBy("_key").agg(F.least(F.ceil(F.count("*") / part), F.lit(shards)).cast("int").alias("_parts"))
        rows = rows.join(stash(parts, "spelling-parts"), "_key").withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
        place = F.pmod(F.pmod(F.xxhash64("_key"), F.lit(shards)) + F.col("_part"), F.lit(shards)) + side * shards
        own = F.pmod(F.xxhash64("word"), F.col("_parts")) == F.col("_part")
        return rows.select(place.cast("int").alias("place"), "word", "n", own.alias("own"))

    both = laid(F.substring("word", -3, 3), 0).unionByName(laid(F.substring("word", 1, 3), 1)).repartitionById(2 * shards, F.col("place"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if got:
            table = pa.Table.from_batches(got)
            place, n, own = (table.column(c).to_numpy() for c in ("place", "n", "own"))
            words = table.column("word").to_pylist()
            for p in np.unique(place).tolist():
                at = np.flatnonzero(place == p)
                yield from _shard_pairs([words[i] for i in at.tolist()], n[at], own[at].astype(bool), p < shards)

    return both.mapInArrow(run, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)``: the last word that ``forms(word, form)`` lead to; each turn doubles how far a word has come.

    A form occurs ten times as often as its word, so no chain is longer than the
    digits of a count and none comes back to where it began.
    """
    now = stash(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        further = now.join(on, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved"))
        further = stash(further, "spelling-roots")
        now = further.select("word", "root")
        if further.where("_moved").isEmpty():
            return now


def variants(counted: DataFrame, times: int = TIMES) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for every row of ``counted(word, n)``, whose words are distinct and of at least seven code points."""
    counted = stash(counted.select("word", F.col("n").cast("long").alias("n")), "spelling-words")
    first = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    best = near_pairs(counted).groupBy("word").agg(F.count("*").alias("n_near"), first.alias("_best"))
    rows = counted.join(best, "word", "left")
    takes = -F.col("_best.less") >= times * F.col("n")
    rows = rows.select("word", F.when(takes, F.col("_best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(takes, -F.col("_best.less")).alias("form_n"))
    rows = stash(rows, "spelling-forms")
    out = rows.join(roots(rows.where("form IS NOT NULL")), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def group(docs: DataFrame, **how) -> DataFrame:
    """Variants of the words of ``docs(doc_id, text)``."""
    return variants(vocabulary(docs, **how))
