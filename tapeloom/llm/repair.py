"""Token-id files compressed by Re-Pair grammars.

Documents are range-partitioned by doc_id and encoded in that order, so the
files hold one ascending sequence. Each partition is written as shards of about
``SHARD`` ids. A shard is compressed on its own: round after round its
frequent pairs of neighbouring symbols (``LEAST`` times or more; a pair never
spans two documents) become new symbols, until no pair is frequent or the
16-bit symbols are used up. A shard stores its documents' ids, lengths and
places in the compressed sequence, the rules round by round, and every rule's
expansion length, so any stretch of one document can be decoded without the rest.

The files are Parquet with one row for each shard and packed little-endian
columns, written by Spark to a folder all executors share.

A null text has only the end id. Rows without a doc_id come first; rows that
repeat a doc_id follow each other, ordered by text.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import words as W
from .common import arrow_map, partitions, shared_folder

SHARD, LEAST, END = 2_000_000, 32, 1


class WordIds:
    """Token ids of words, remembered by the words' bytes.

    Usable for tokenizers whose pre-tokens never hold white space: a text's ids
    are then those of its words one after the other. Words are looked up by
    hash and compared byte by byte, so two words of one hash do not meet. The
    memory is bounded: beyond ``MOST`` words it is begun anew.
    """

    MOST = 1 << 20

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        split = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        pattern = (split.get("pattern") or {}).get("Regex", "")
        self.by_word = split.get("type") == "Split" and split.get("invert") and r"[^\s" in pattern and " ?" not in pattern
        # words that hold one are left to the library, whatever their case: a normalized token is found in the lowered text
        self.added = [x["content"].lower() for x in spec.get("added_tokens") or [] if x["content"]]
        self.by_word = self.by_word and not any(re.search(r"\s", x) for x in self.added)
        lowers = any(x.get("type") == "Lowercase" for x in (spec.get("normalizer") or {}).get("normalizers", []))
        plain = pattern.replace(r"\p{L}", "a-z").replace(r"\p{N}", "0-9")
        self.ascii_pieces = re.compile(plain + "|\n", re.ASCII) if self.by_word and lowers and r"\p" not in plain else None
        self._forget()

    def _forget(self) -> None:
        """Known words in order of arrival: their keys, bytes and ids; ``slots`` holds their numbers by key."""
        self.n, self.keys, self.slots = 0, np.zeros(1 << 12, np.uint64), np.full(1 << 14, -1, np.int32)
        self.text, self.ids, self.pieces = _Store(np.uint8), _Store(np.uint16), {}

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """The ids of each word; pieces of plain letters, digits and signs go to the library's model one by one and are remembered."""
        out: list = [None] * len(words)
        plain = [i for i, x in enumerate(words) if x.isascii() and x.isprintable()] if self.ascii_pieces else []
        lowered = [words[i].lower() for i in plain]
        if any(x in y for x in self.added for y in ["\n".join(lowered)]):
            kept = [k for k, x in enumerate(lowered) if not any(y in x for y in self.added)]
            plain, lowered = [plain[k] for k in kept], [lowered[k] for k in kept]
        known, tokenize, now, place = self.pieces, self.tokenizer.model.tokenize, [], iter(plain)
        for piece in self.ascii_pieces.findall("\n".join(lowered) + "\n") if plain else []:
            if piece == "\n":
                out[next(place)] = now
                now = []
                continue
            ids = known.get(piece)
            if ids is None:
                ids = known[piece] = [t.id for t in tokenize(piece)]
            now += ids
        rest = [i for i, x in enumerate(out) if x is None]
        for i, got in zip(rest, self.tokenizer.encode_batch_fast([words[i] for i in rest], add_special_tokens=False) if rest else []):
            out[i] = got.ids
        return out

    def _place(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        """Put ``numbers`` into the first free slots from each key's own on; keys are distinct."""
        mask = np.uint64(len(self.slots) - 1)
        at = (keys & mask).astype(np.int64)
        while len(numbers):
            free = self.slots[at] < 0
            self.slots[at[free]] = numbers[free]  # of several for one slot one wins
            left = self.slots[at] != numbers
            at, numbers = (at[left] + 1) & int(mask), numbers[left]

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """The number of the known word with each key, -1 without one."""
        out = np.full(len(keys), -1)
        at, todo = (keys & np.uint64(len(self.slots) - 1)).astype(np.int64), np.arange(len(keys))
        while len(todo):
            number = self.slots[at]
            hit = (number >= 0) & (self.keys[np.maximum(number, 0)] == keys[todo])
            out[todo[hit]] = number[hit]
            on = ~hit & (number >= 0)
            at, todo = (at[on] + 1) & (len(self.slots) - 1), todo[on]
        return out

    def _learn(self, keys: np.ndarray, words: list[bytes]) -> None:
        if self.n + len(keys) > self.MOST:
            self._forget()
        got = self.encode_words([x.decode() for x in words])
        self.text.extend(np.frombuffer(b"".join(words), np.uint8), np.array([len(x) for x in words], np.int64))
        self.ids.extend(np.fromiter(chain.from_iterable(got), np.uint16), np.array([len(x) for x in got], np.int64))
        n = self.n + len(keys)
        if n > len(self.keys):
            self.keys = np.concatenate((self.keys[: self.n], np.zeros(n, np.uint64)))
        self.keys[self.n : n] = keys
        if 3 * n > len(self.slots):
            self.slots = np.full(1 << (4 * n).bit_length(), -1, np.int32)
            self._place(self.keys[:n], np.arange(n, dtype=np.int32))
        else:
            self._place(keys, np.arange(self.n, n, dtype=np.int32))
        self.n = n

    def _distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of distinct words side by side, and how many each has."""
        offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
        data = np.frombuffer(words.buffers()[2], np.uint8) if len(words) else np.zeros(0, np.uint8)
        keys = W.span_hashes(data, offsets[:-1], offsets[1:])
        number = self._find(keys)
        new = np.flatnonzero(number < 0)
        if len(new):
            _, first = np.unique(keys[new], return_index=True)
            new = new[np.sort(first)]
            if self.n + len(new) > self.MOST and self.n:
                self._forget()
                return self._distinct(words)
            raw = data.tobytes()
            self._learn(keys[new], [raw[a:b] for a, b in zip(offsets[new].tolist(), offsets[new + 1].tolist())])
            number = self._find(keys)
        # a word whose bytes differ from the known one's shares its hash with it
        size = np.diff(offsets)
        same = self.text.lengths(number) == size
        at = np.flatnonzero(same)
        equal = self.text.taken(number[at]) == data[W.flat_ranges(offsets[:-1][at], size[at])]
        begin = np.cumsum(size[at]) - size[at]
        same[at] = np.logical_and.reduceat(equal, begin) if len(at) else False
        if same.all():
            return self.ids.taken(number), self.ids.lengths(number)
        other = self.encode_words([x.as_py().decode() for x in words.take(pa.array(np.flatnonzero(~same)))])
        ids, count = self.ids.taken(number[same]), self.ids.lengths(number)
        count[~same] = [len(x) for x in other]
        out = np.empty(int(count.sum()), np.uint16)
        mine = np.repeat(same, count)
        out[mine], out[~mine] = ids, np.array([x for y in other for x in y], np.uint16)
        return out, count

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a column of texts, and how many each text has."""
        if not self.by_word:
            got = [x.ids for x in self.tokenizer.encode_batch_fast([t or "" for t in column.to_pylist()], add_special_tokens=False)]
            return np.array([x for y in got for x in y], np.uint16), np.array([len(x) for x in got], np.int64)
        w = W.find(column)
        size = w.ends - w.starts
        edge = np.zeros(len(w.data) + 1, np.int8)
        edge[w.starts] += 1
        edge[w.ends] -= 1
        inside = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
        offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
        words = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(w.data[inside])]).dictionary_encode()
        packed, count = self._distinct(words.dictionary)
        which = words.indices.to_numpy()
        at, lengths = np.cumsum(count) - count, count[which]
        ids = packed[W.flat_ranges(at[which], lengths)]
        return ids, np.bincount(w.row, lengths, len(w.offsets) - 1).astype(np.int64)


class _Store:
    """Pieces of an array, numbered in order of arrival; room grows by doubling, so adding never copies all each time."""

    def __init__(self, kind: type):
        self.flat, self.size, self.ends, self.n = np.zeros(1 << 12, kind), 0, np.zeros(1 << 12, np.int64), 0

    def extend(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        size, n = self.size + len(flat), self.n + len(lengths)
        if size > len(self.flat):
            self.flat = np.concatenate((self.flat[: self.size], np.zeros(size, self.flat.dtype)))
        if n + 1 > len(self.ends):
            self.ends = np.concatenate((self.ends[: self.n + 1], np.zeros(n + 1, np.int64)))
        self.flat[self.size : size] = flat
        self.ends[self.n + 1 : n + 1] = self.size + np.cumsum(lengths)  # the first entry is 0
        self.size, self.n = size, n

    def lengths(self, which: np.ndarray) -> np.ndarray:
        return self.ends[which + 1] - self.ends[which]

    def taken(self, which: np.ndarray) -> np.ndarray:
        """The pieces ``which``, side by side."""
        return self.flat[W.flat_ranges(self.ends[which], self.lengths(which))]


@lru_cache(maxsize=2)
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


def compress(ids: np.ndarray, counts: np.ndarray, symbols: int, least: int = LEAST):
    """Re-Pair of one shard: the symbols left, where each document's begin, the rules and their number in each round.

    A round replaces all pairs that occur ``least`` times or more, or as many
    of the most frequent as there are symbols left. A pair of two symbols that
    were there before the last round is rarer than that from then on, so only
    pairs with a symbol of the last round are counted in the next. Rounds end
    when no pair is frequent or the symbols are used up.
    """
    seq = ids.astype(np.uint16)
    last = np.zeros(len(seq), bool)  # a document's last symbol pairs with nothing after it
    last[np.cumsum(counts)[counts > 0] - 1] = True
    rules, sizes = [], []
    base = symbols
    fresh = np.flatnonzero(~last)  # places of the pairs to count
    while len(fresh) >= least and base < 1 << 16:
        code = seq[fresh].astype(np.uint64) << np.uint64(48) | seq[fresh + 1].astype(np.uint64) << np.uint64(32) | fresh.astype(np.uint64)
        code.sort()
        pair = (code >> np.uint64(32)).astype(np.uint32)
        begin = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
        many = np.diff(np.append(begin, len(pair)))
        frequent = np.flatnonzero(many >= least)
        room = (1 << 16) - base
        if len(frequent) > room:
            frequent = np.sort(frequent[np.argsort(-many[frequent], kind="stable")[:room]])
        if not len(frequent):
            break
        rule = np.full(len(seq), -1, np.int32)
        rule[(code[W.flat_ranges(begin[frequent], many[frequent])] & np.uint64(0xFFFFFFFF)).astype(np.int64)] = np.repeat(np.arange(len(frequent), dtype=np.int32), many[frequent])
        where = np.flatnonzero(rule >= 0)
        # of overlapping pairs every second one, from the left
        index = np.arange(len(where))
        start = np.maximum.accumulate(np.where(np.concatenate(([True], np.diff(where) > 1)), index, 0))
        where = where[(index - start) % 2 == 0]
        number = rule[where]
        used = np.flatnonzero(np.bincount(number, minlength=len(frequent)))  # overlaps can leave a pair without a place
        to = np.zeros(len(frequent), np.int64)
        to[used] = base + np.arange(len(used))
        chosen = pair[begin[frequent[used]]]
        rules.append(np.stack((chosen >> 16, chosen & 0xFFFF), 1).astype(np.int32))
        sizes.append(len(used))
        seq[where] = to[number]
        last[where] |= last[where + 1]
        keep = np.ones(len(seq), bool)
        keep[where + 1] = False
        seq, last = seq[keep], last[keep]
        base += len(used)
        made = where - np.arange(len(where))
        fresh = np.zeros(len(seq), bool)
        fresh[made] = True
        fresh[made[made > 0] - 1] = True
        fresh = np.flatnonzero(fresh & ~last)
    ends = np.flatnonzero(last) + 1
    upto = np.zeros(len(counts), np.int64)
    upto[counts > 0] = ends
    return seq, np.maximum.accumulate(upto), np.concatenate(rules) if rules else np.zeros((0, 2), np.int32), sizes


def expansion_lengths(rules: np.ndarray, sizes: list[int], symbols: int) -> np.ndarray:
    """How many ids each rule stands for."""
    length = np.ones(symbols + len(rules), np.int64)
    at = 0
    for n in sizes:
        length[symbols + at : symbols + at + n] = length[rules[at : at + n]].sum(1)
        at += n
    return length[symbols:]


class Grammar:
    """The expansions of all symbols of a shard, side by side.

    The places of a round's rules do not overlap, so its expansions together
    are never longer than the shard.
    """

    def __init__(self, rules: np.ndarray, sizes: list[int], symbols: int):
        self.flat = np.arange(symbols, dtype=np.int32)
        self.begin, self.length = np.arange(symbols), np.ones(symbols, np.int64)
        at = 0
        for n in sizes:
            pairs = rules[at : at + n].reshape(-1)
            size = self.length[pairs]
            both = size.reshape(-1, 2).sum(1)
            self.begin = np.concatenate((self.begin, len(self.flat) + np.cumsum(both) - both))
            self.flat = np.concatenate((self.flat, self.flat[W.flat_ranges(self.begin[pairs], size)]))
            self.length = np.concatenate((self.length, both))
            at += n

    def expand(self, seq: np.ndarray) -> np.ndarray:
        """The ids of a compressed stretch."""
        return self.flat[W.flat_ranges(self.begin[seq], self.length[seq])]


def expand(seq: np.ndarray, rules: np.ndarray, sizes: list[int], symbols: int) -> np.ndarray:
    return Grammar(rules, sizes, symbols).expand(seq)


_SCHEMA = "part int, shard int, n_ids long, symbols int, doc_ids binary, has_id binary, counts binary, upto binary, rules binary, rounds array<int>, lengths binary, seq binary"


def write(docs: DataFrame, tokenizer: str, path: str, end: int = END, shard: int = SHARD) -> None:
    """Encode ``docs(doc_id, text)`` in ascending doc_id order, append ``end`` to each, write the shards to ``path``."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.repartitionByRange(partitions(spark), "doc_id").sortWithinPartitions("doc_id", "text")

    def packed(no: int, got: list, symbols: int) -> pa.RecordBatch:
        docs_, has, counts, ids = (np.concatenate(x) for x in zip(*got))
        seq, upto, rules, sizes = compress(ids, counts, symbols)
        lengths = expansion_lengths(rules, sizes, symbols)
        row = [TaskContext.get().partitionId(), no, len(ids), symbols, docs_.tobytes(), has.tobytes(), counts.astype("<u4").tobytes(), upto.astype("<u4").tobytes(), rules.astype("<u4").tobytes(), sizes, lengths.astype("<u4").tobytes(), seq.astype("<u2").tobytes()]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 5, pa.list_(pa.int32()), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], names=[x.split()[0] for x in _SCHEMA.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _word_ids(tokenizer)
        symbols = coder.tokenizer.get_vocab_size()
        got, size, no = [], 0, 0
        for batch in batches:
            for part in W.pieces(batch):
                ids, counts = coder.encode(part.column("text"))
                at = np.cumsum(counts) + np.arange(len(counts))
                full = np.empty(len(ids) + len(counts), np.uint16)
                body = np.ones(len(full), bool)
                body[at] = False
                full[at], full[body] = end, ids
                got.append((part.column("doc_id").fill_null(0).to_numpy(), part.column("doc_id").is_valid().to_numpy(zero_copy_only=False), counts + 1, full))
                size += len(full)
                if size >= shard:
                    yield packed(no, got, symbols)
                    got, size, no = [], 0, no + 1
        if got:
            yield packed(no, got, symbols)

    docs.mapInArrow(run, _SCHEMA).write.parquet(path)


def _unpacked(row: dict) -> tuple:
    rules = np.frombuffer(row["rules"], "<u4").astype(np.int64).reshape(-1, 2)
    return np.frombuffer(row["seq"], "<u2"), np.frombuffer(row["upto"], "<u4").astype(np.int64), rules, row["rounds"], row["symbols"]


def document(row: dict, k: int, first: int = 0, many: int | None = None) -> np.ndarray:
    """``many`` ids (all, if not said) of the k-th document of a shard, from its ``first`` on.

    The stored expansion lengths tell which of the document's symbols hold
    them; only those are decoded.
    """
    seq, upto, rules, rounds, symbols = _unpacked(row)
    seq = seq[upto[k - 1] if k else 0 : upto[k]].astype(np.int64)
    stored = np.frombuffer(row["lengths"], "<u4").astype(np.int64)
    size = np.ones(len(seq), np.int64)
    size[seq >= symbols] = stored[seq[seq >= symbols] - symbols]
    edge = np.concatenate(([0], np.cumsum(size)))
    end = int(edge[-1]) if many is None else min(int(edge[-1]), first + many)
    if first >= end:
        return np.zeros(0, np.int32)
    a, b = int(np.searchsorted(edge, first, "right")) - 1, int(np.searchsorted(edge, end, "left"))
    out, stack = [], seq[a:b][::-1].tolist()
    while stack:
        x = stack.pop()
        if x < symbols:
            out.append(x)
        else:
            stack.extend(rules[x - symbols][::-1].tolist())
    return np.array(out, np.int32)[first - int(edge[a]) : end - int(edge[a])]


def read(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of every document in the files; ids as little-endian unsigned 32-bit integers."""
    shards = spark.read.parquet(path)
    before = F.sum("n_ids").over(Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1))  # one row for each shard
    places = shards.select("part", "shard", "n_ids").select(F.col("part").alias("_p"), F.col("shard").alias("_s"), F.coalesce(before, F.lit(0)).alias("begin"))
    both = shards.join(places, (F.col("part") == F.col("_p")) & (F.col("shard") == F.col("_s"))).drop("_p", "_s")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for r in range(batch.num_rows):
            (row,) = batch.slice(r, 1).to_pylist()
            seq, _, rules, rounds, symbols = _unpacked(row)
            ids = expand(seq, rules, rounds, symbols).astype("<u4")
            counts = np.frombuffer(row["counts"], "<u4").astype(np.int64)
            edge = np.concatenate(([0], np.cumsum(counts)))
            raw, doc_ids, has = ids.tobytes(), np.frombuffer(row["doc_ids"], np.int64), np.frombuffer(row["has_id"], bool)
            for i in range(0, len(counts), 500):
                k = slice(i, i + 500)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids[k], mask=~has[k]), pa.array(edge[:-1][k] + row["begin"]), pa.array(counts[k]), pa.array([raw[4 * a : 4 * b] for a, b in zip(edge[:-1][k], edge[1:][k])], pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    return arrow_map(both, run, "doc_id long, start long, n_tokens long, ids binary")


def written(docs: DataFrame, tokenizer: str, **how) -> DataFrame:
    """Write the shards of ``docs`` to the shared folder and read them back."""
    spark = docs.sparkSession
    path = f"{shared_folder(spark)}/repair-{uuid.uuid4().hex}"
    write(docs, tokenizer, path, **how)
    return read(spark, path)


def digests(done: DataFrame) -> DataFrame:
    return done.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


__all__ = ["Grammar", "compress", "digests", "document", "expand", "read", "write", "written"]
