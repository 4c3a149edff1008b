"""Language-model scores from Elias-Fano n-gram tries of words and bigrams.

The model interpolates bigrams with unigrams under a Dirichlet prior:
``p(w | c) = (n(c, w) + m p(w)) / (n(c) + m)`` with
``p(w) = (n(w) + 1) / (N + V + 1)``. It factors into a part that depends on the
context's count alone and one that depends on the pair alone, so each token is
scored where its word lives: tokens are dealt to shards by word, and a shard
that has counted its training tokens into a trie answers for all tokens it was
dealt, training or not, in one shuffle. There are as many shards as the texts'
bytes ask for, each of a size that one task holds in memory and in a partition
of its own. A word that has more than one in ``HOT`` of all tokens is dealt by
word and context instead; the counts of those words, at most ``HOT`` of them,
are sent along.

A longer context is left out: how often a context of two words was seen is
counted where its last word lives, and a model that weighs both would have to
carry that count to every token once more. Words are told apart by 64 bits,
contexts of one word by 40.

The prior's strength ``m`` is the one of ``STRENGTHS`` under which the training
documents score best with each token left out of the counts.

Null and empty texts hold only the end token. A null doc_id is neither held out
nor trained on. Repeated rows are scored (and counted) one by one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import stash
from .eftrie import CONTEXT_BITS, Trie, pack

HOT, STRENGTHS, PACK, SHARD_BYTES, FOLDS, FOLD = 2000, (1e1, 1e2, 1e3, 1e4, 1e5, 1e6, 1e7), 1_500_000, 32_000_000, 7, 2
END, START = (np.uint64(x) for x in (0x1B873593CC9E2D51, 0x52DCE729E6546B64))
_CONTEXT = np.uint64((1 << CONTEXT_BITS) - 1)


def _shard(w: np.ndarray, context: np.ndarray, hot: np.ndarray, shards: int) -> np.ndarray:
    by_word = W.mixed(w + np.uint64(0x85EBCA6B)) % np.uint64(shards)
    if not len(hot):
        return by_word.astype(np.int32)
    is_hot = hot[np.minimum(np.searchsorted(hot, w), len(hot) - 1)] == w
    by_pair = W.mixed(w * np.uint64(0x9E3779B97F4A7C15) ^ W.mixed(context)) % np.uint64(shards)
    return np.where(is_hot, by_pair, by_word).astype(np.int32)


def _tokens(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple]:
    """Documents in packs of about ``most`` tokens: words, contexts, row of each, the rows' ids and flags."""
    got, size = [], 0

    def packed() -> tuple:
        rows = np.cumsum([0] + [len(x[3]) for x in got])
        w, c, row = (np.concatenate([x[k] for x in got]) for k in (0, 1, 2))
        row = row + np.repeat(rows[:-1], [len(x[0]) for x in got])
        return w, c, row, pa.chunked_array([x[3] for x in got]).combine_chunks(), pa.chunked_array([x[4] for x in got]).combine_chunks()

    for batch in batches:
        for part in W.pieces(batch):
            found = W.find(part.column("text"), lower=True)
            n = part.num_rows
            total = len(found.starts) + n
            ends = found.first[1:] + np.arange(n)  # every text's words, then its end
            w = np.empty(total, np.uint64)
            body = np.ones(total, bool)
            body[ends] = False
            w[body], w[ends] = found.hashes(), END
            context = np.empty(total, np.uint64)
            context[1:] = w[:-1]
            context[np.concatenate(([0], ends[:-1] + 1))] = START
            row = np.repeat(np.arange(n), found.counts + 1)
            got.append((w, context, row, part.column("doc_id"), part.column("fold")))
            size += total
            if size >= most:
                yield packed()
                got, size = [], 0
    if got:
        yield packed()


def vocabulary(docs: DataFrame, shards: int) -> DataFrame:
    """``(shard, words, counts, n_types, n_tokens)``: the training words of each shard, sorted by hash."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for w, _, row, _, fold in _tokens(batches, PACK):
            w = w[(fold.fill_null(FOLD).to_numpy() != FOLD)[row]]
            keys, counts = np.unique(w, return_counts=True)
            to = _shard(keys, keys, keys[:0], shards)
            order = np.argsort(to, kind="stable")
            for s, k in _dealt(to, order):
                yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([keys[k].tobytes()], pa.binary()), pa.array([counts[k].astype(np.int64).tobytes()], pa.binary())], names=["shard", "words", "counts"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(s: int, got: list) -> pa.RecordBatch:
            (keys, counts), = _summed(got)
            row = [s, keys.tobytes(), counts.tobytes(), len(keys), int(counts.sum())]
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, (pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64()))], names=["shard", "words", "counts", "n_types", "n_tokens"])

        now, got, size = None, [], 0
        for batch in batches:
            for s, a, b in zip(*(batch.column(i) for i in range(3))):
                s = s.as_py()
                if s != now and got:
                    yield out(now, got)
                    got, size = [], 0
                now = s
                got.append((np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.int64)))
                size += len(got[-1][0])
                if size > 4_000_000:
                    got = _summed(got)
                    size = len(got[0][0]) // 2
        if got:
            yield out(now, got)

    parts = docs.mapInArrow(count, "shard int, words binary, counts binary")
    merged = parts.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard").mapInArrow(merge, "shard int, words binary, counts binary, n_types long, n_tokens long")
    return stash(merged, "lm-vocabulary")


def _dealt(to: np.ndarray, order: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each shard that is dealt something, and what; ``order`` sorts ``to``."""
    there = to[order]
    begin = np.flatnonzero(np.concatenate(([True], there[1:] != there[:-1]))) if len(there) else np.zeros(0, np.int64)
    for a, b in zip(begin.tolist(), np.append(begin[1:], len(there)).tolist()):
        yield int(there[a]), order[a:b]


def _summed(got: list) -> list:
    """One table of keys and counts from several."""
    keys, counts = (np.concatenate(x) for x in zip(*got))
    if not len(keys):
        return [(keys, counts)]
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    begin = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return [(keys[begin], np.add.reduceat(counts, begin))]


def frequent(vocab: DataFrame, n_tokens: int) -> tuple[np.ndarray, np.ndarray]:
    """Words with more than one in HOT of all tokens, and their counts: at most HOT rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in zip(batch.column("words"), batch.column("counts")):
                keys, counts = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.int64)
                k = np.flatnonzero(counts * HOT > n_tokens)
                yield pa.RecordBatch.from_arrays([pa.array(W.signed(keys[k])), pa.array(counts[k])], names=["w", "n"])

    rows = vocab.select("words", "counts").mapInArrow(run, "w long, n long").collect()
    keys = np.array([r.w for r in rows], np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], np.array([r.n for r in rows], np.int64)[order]


_DEALT = "shard int, kind int, batch long, a binary, b binary, c binary, d binary, e binary"
_KINDS = [pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 5]
_NAMES = [x.split()[0] for x in _DEALT.split(", ")]


def _row(*values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(values, _KINDS)], names=_NAMES)


def _deal(shards: int, hot: np.ndarray):
    """Tokens to shards. Kind 1: distinct words, run lengths, contexts, rows, the rows' training flags; kind 2: a pack's documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for no, (w, context, row, ids, fold) in enumerate(_tokens(batches, PACK)):
            batch = TaskContext.get().partitionId() << 24 | no
            to = _shard(w, context, hot, shards)
            order = np.lexsort((w, to))
            flags = np.where(fold.is_null().to_numpy(zero_copy_only=False), 2, fold.fill_null(0).to_numpy() != FOLD).astype(np.uint8)  # 1 trained on, 0 held out, 2 neither
            many = np.bincount(row, minlength=len(flags)).astype("<u4")
            yield _row(batch % shards, 2, batch, ids.fill_null(0).to_numpy().tobytes(), ids.is_valid().to_numpy(zero_copy_only=False).tobytes(), flags.tobytes(), many.tobytes(), None)
            for s, k in _dealt(to, order):
                x = w[k]
                begin = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1])))
                runs = np.diff(np.append(begin, len(x))).astype("<u4")
                low = np.ascontiguousarray((context[k] & _CONTEXT).astype("<u8")).view(np.uint8).reshape(-1, 8)[:, : CONTEXT_BITS // 8]
                yield _row(s, 1, batch, x[begin].tobytes(), runs.tobytes(), low.tobytes(), row[k].astype("<u4" if len(flags) > 65535 else "<u2").tobytes(), flags.tobytes())

    return run


def _unpack(row: tuple) -> tuple[np.ndarray, ...]:
    words, runs, low, rows, flags = row
    runs = np.frombuffer(runs, "<u4").astype(np.int64)
    flags = np.frombuffer(flags, np.uint8)
    raw = np.zeros((int(runs.sum()), 8), np.uint8)
    raw[:, : CONTEXT_BITS // 8] = np.frombuffer(low, np.uint8).reshape(-1, CONTEXT_BITS // 8)
    rows = np.frombuffer(rows, "<u4" if len(flags) > 65535 else "<u2").astype(np.int64)
    return np.frombuffer(words, np.uint64), runs, raw.view("<u8").reshape(-1), rows, flags


class _Shard:
    """One shard's tokens: kept as they came while its training pairs are counted, then scored."""

    def __init__(self, shard: int, hot: np.ndarray, hot_counts: np.ndarray, z: float):
        self.shard, self.z, self.words, self.counts = shard, z, hot, hot_counts
        self.rows, self.pairs, self.size = [], [], 0

    def vocabulary(self, words: bytes, counts: bytes) -> None:
        keys = np.concatenate((self.words, np.frombuffer(words, np.uint64)))
        self.words, first = np.unique(keys, return_index=True)
        self.counts = np.concatenate((self.counts, np.frombuffer(counts, np.int64)))[first]

    def add(self, batch: int, row: tuple) -> None:
        self.rows.append((batch, row))
        words, runs, context, rows, flags = _unpack(row)
        trained = flags[rows] == 1
        rank = np.repeat(np.searchsorted(self.words, words), runs)[trained]
        code = rank.astype(np.uint64) << np.uint64(CONTEXT_BITS) | context[trained]
        self.pairs.append((code, np.ones(len(code), np.int64)))
        self.size += len(code)
        if self.size > 6_000_000:
            self.pairs = _summed(self.pairs)
            self.size = len(self.pairs[0][0]) // 2

    def scored(self) -> Iterator[pa.RecordBatch]:
        codes, seen = _summed(self.pairs)[0] if self.pairs else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        self.pairs = []
        trie = Trie.mapped(pack(self.words, self.counts, codes, seen))
        left_out = np.zeros(len(STRENGTHS))
        for batch, row in self.rows:
            words, runs, context, rows, flags = _unpack(row)
            rank, count = trie.word(words)
            is_end = np.repeat(words == END, runs)
            rank, count = np.repeat(rank, runs), np.repeat(count, runs)
            code = np.maximum(rank, 0).astype(np.uint64) << np.uint64(CONTEXT_BITS) | context
            code[rank < 0] = _CONTEXT
            _, first, inverse = np.unique(code, return_index=True, return_inverse=True)
            share = trie.share(rank[first], context[first])[inverse]
            n = len(flags)
            total = lambda x: np.bincount(rows, x, n)
            gains = []
            trained = flags[rows] == 1
            c, e = count[trained], is_end[trained]
            once = np.maximum(np.round(share[trained] * (c + 1)) - 1, 0)
            for k, m in enumerate(STRENGTHS):
                gains.append(total(np.log10(1 + share * self.z / m) - np.where(is_end, 0, np.log10(1 + count / m))))
                left_out[k] += float(np.sum(np.log10(1 + once / np.maximum(c, 1) * self.z / m) - np.where(e, 0, np.log10(1 + np.maximum(c - 1, 0) / m))))
            yield _row(self.shard, 1, batch, total(count > 0).astype("<u4").tobytes(), total(np.log10(count + 1.0)).tobytes(), np.stack(gains).astype("<f4").tobytes(), None, None)
        yield _row(self.shard, 3, -1, left_out.tobytes(), None, None, None, None)


def _answer(hot: np.ndarray, hot_counts: np.ndarray, z: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            columns = [batch.column(i) for i in range(batch.num_columns)]
            for i in range(batch.num_rows):
                shard, kind, no = (columns[k][i].as_py() for k in range(3))
                if now is None or now.shard != shard:
                    if now is not None:
                        yield from now.scored()
                    now = _Shard(shard, hot, hot_counts, z)
                values = [columns[k][i].as_py() for k in range(3, 8)]
                if kind == 0:
                    now.vocabulary(values[0], values[1])
                elif kind == 1:
                    now.add(no, tuple(values))
                else:
                    yield _row(shard, 2, no, *values)
        if now is not None:
            yield from now.scored()

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of a task's shards for each strength."""
    total = np.zeros(len(STRENGTHS))
    for batch in batches:
        for a in batch.column("a"):
            total += np.frombuffer(a.as_buffer(), np.float64)
    yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], names=["i", "v"])


def score(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` of every row of ``docs(doc_id, text)``."""
    shards = 4 + int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // SHARD_BYTES
    docs = docs.select(F.col("doc_id").cast("long"), "text", F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS)).cast("int").alias("fold"))
    vocab = vocabulary(docs, shards)
    n_types, n_tokens = (int(x or 0) for x in vocab.agg(F.sum("n_types"), F.sum("n_tokens")).first())
    z = float(n_tokens + n_types + 1)
    hot, hot_counts = frequent(vocab, n_tokens)
    n_docs = int(docs.where(F.col("fold") != FOLD).count())

    none = F.lit(None).cast("binary")
    kind0 = vocab.select("shard", F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("batch"), F.col("words").alias("a"), F.col("counts").alias("b"), none.alias("c"), none.alias("d"), none.alias("e"))
    dealt = kind0.unionByName(docs.mapInArrow(_deal(shards, hot), _DEALT))
    answers = dealt.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "kind", "batch").mapInArrow(_answer(hot, hot_counts, z), _DEALT)
    answers = stash(answers.drop("shard"), "lm-answers")
    total = np.zeros(len(STRENGTHS))
    for r in answers.where("kind = 3").select("a").mapInArrow(_added, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():  # one row a strength
        total[r.i] = r.v
    best = int(np.argmax(total - n_docs * np.log10(1 + np.maximum(n_docs - 1, 0) / np.array(STRENGTHS))))
    start = math.log10(1 + n_docs / STRENGTHS[best])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, docs_, known, base, gain = None, None, 0, 0.0, 0.0

        def out() -> pa.RecordBatch:
            ids, has, flags, many = docs_
            n = np.frombuffer(many, "<u4").astype(np.int64)
            level = base - n * math.log10(z)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.frombuffer(ids, np.int64), mask=~np.frombuffer(has, bool)), pa.array(np.frombuffer(flags, np.uint8) == 0), pa.array(n), pa.array(known), pa.array(np.full(len(n), n_tokens)), pa.array(level), pa.array(level + gain - start)],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

        for batch in batches:
            for kind, no, a, b, c, d in zip(*(batch.column(k) for k in ("kind", "batch", "a", "b", "c", "d"))):
                if no.as_py() != now:
                    if now is not None:
                        yield out()
                    now, known, base, gain = no.as_py(), 0, 0.0, 0.0
                if kind.as_py() == 2:
                    docs_ = tuple(x.as_py() for x in (a, b, c, d))
                else:
                    known = known + np.frombuffer(a.as_buffer(), "<u4").astype(np.int64)
                    base = base + np.frombuffer(b.as_buffer(), np.float64)
                    gain = gain + np.frombuffer(c.as_buffer(), "<f4").reshape(len(STRENGTHS), -1)[best].astype(np.float64)
        if now is not None:
            yield out()

    rows = answers.where("kind < 3").repartition("batch").sortWithinPartitions("batch", F.desc("kind"))
    return rows.mapInArrow(gather, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
