"""Exact n-gram Jaccard join by blocks of the document by n-gram incidence.

The matrix is not multiplied out: its product has an entry for every pair of a
group of copies. Instead, rows (documents) are blocked by set size so that two
sets that can reach the threshold lie in the same or in neighbouring size
classes, and columns (n-gram hashes) so finely that two sets that differ in no
more n-grams than the sizes allow must agree in at least one whole column
block. A pair that agrees in no block is thereby below its size-derived bound
and never formed. Of the pairs left, parities of the n-grams by hash, about a
bit or two for each n-gram, rule out nearly all that are no links. Only for the
others are texts brought together and the common n-grams counted, set against
set, and the count compared with ``100 * overlap >= percent * union``. What is
written and shuffled for that follows the near pairs, not the documents that
share a block by chance, whose part grows with the table; pairs that outweigh
the texts are counted in parts, and so is the last turn's join.

Documents with equal sets count as one row of the matrix (the smallest id
stands for them), so copies are not multiplied. Only what connectivity needs is
multiplied out: in a few rounds every block compares all its documents with one
member of it; after that, just the pairs of a block whose documents are still
in different components are left. Of these, the ones that the bounds on sizes
and on differing n-grams allow are all compared; the bounds are part of the
join's condition, so the others are never formed. That last turn grows with the
square of a block whose documents stay apart. No candidate is dropped or capped.

N-grams are compared by 64-bit hashes, equal sets by two sums of those.

Null texts, and texts without words, have an empty set and no links; so do rows
without a doc_id. Rows that repeat a doc_id with the same text are one document
and come back as often as they occur.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import arrow_map, components, shared_keys, stash

N, PERCENT, STAR_ROUNDS, PARITIES = 3, 90, 3, 8
#: What weighs as much as an n-gram in a part that is shuffled by itself: the n-grams of a pair's first set, a document's key.
PAIRS, KEYS = 2, 16
_PARITY = [f"parity_{i}" for i in range(PARITIES)]


def size_classes(most: int, percent: int) -> np.ndarray:
    """Lower bounds of the size classes up to ``most``: a set's partners are in its own class or a neighbouring one."""
    bounds = [1]
    while bounds[-1] <= most:
        low = bounds[-1]
        bounds.append(max(low + 1, 100 * (low - 1) // percent + 1))
    return np.array([*bounds, max(bounds[-1] + 1, 100 * (bounds[-1] - 1) // percent + 1)], np.int64)


def blocks(low: np.ndarray, percent: int) -> np.ndarray:
    """Column blocks of each class: one more than the n-grams in which two linked sets of it and the next can differ."""
    most = (low[1:-1] - 1) + (low[2:] - 1)
    return most * (100 - percent) // (100 + percent) + 1


def spare(need: np.ndarray, low: np.ndarray) -> np.ndarray:
    """So many blocks that a set of ``low`` members or more fills ``need`` of them but for rare cases."""
    many = need.astype(float)
    for _ in range(6):
        left = many * np.exp(-low / many)
        many = need + left + 3 * np.sqrt(left)
    return np.ceil(many - 1e-2).astype(np.int64)


def sets(w: W.Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes, ascending within each row, and where each row's begin."""
    h = w.hashes()
    g, ok = W.grams(h, w.row, n)
    row = w.row[: len(g)][ok]
    g = g[ok]
    few = np.flatnonzero((w.counts > 0) & (w.counts < n))
    if len(few):  # the whole sequence is the only member
        whole = np.array([int(W.mixed(np.add.reduce(h[w.first[r] : w.first[r + 1]] * W._PLACE[32 : 32 + w.counts[r]], keepdims=True))[0]) for r in few], np.uint64)
        row, g = np.concatenate((row, few)), np.concatenate((g, whole))
    order = np.lexsort((g, row))
    row, g = row[order], g[order]
    if len(g):
        fresh = np.ones(len(g), bool)
        fresh[1:] = (g[1:] != g[:-1]) | (row[1:] != row[:-1])
        row, g = row[fresh], g[fresh]
    return g, np.searchsorted(row, np.arange(len(w.offsets)))


def _parities(g: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Of every set the parities of its n-grams by 64 * PARITIES hash values, and, of larger sets, by as many as the next power of two from its size on."""
    size = np.diff(first)
    h = W.mixed(g + np.uint64(0x1F83D9ABFB41BD6B))
    row = np.repeat(np.arange(len(size)), size)
    bits = 64 * PARITIES
    odd = np.bincount(row * bits + (h % np.uint64(bits)).astype(np.int64), minlength=len(size) * bits) & 1
    parity = np.packbits(odd.astype(np.uint8)).view("<i8").reshape(len(size), PARITIES)
    many = np.where(size > bits, 1 << np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64), 0)
    begin = np.concatenate(([0], np.cumsum(many)))
    inside = np.repeat(many > 0, size)
    at = np.repeat(begin[:-1], size)[inside] + (h[inside] & (np.repeat(many, size)[inside] - 1).astype(np.uint64)).astype(np.int64)
    fine = np.packbits((np.bincount(at, minlength=int(begin[-1])) & 1).astype(np.uint8), bitorder="little")
    offsets = (begin // 8).astype(np.int32)
    return parity, pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(fine)])


def _sizes(docs: DataFrame, n: int) -> DataFrame:
    """``(doc_id, n_shingles, d1, d2, parity_0 ..., fine)``: the size, a 128-bit digest and the parities of every row's set."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in W.pieces(batch):
            g, first = sets(W.find(part.column("text"), lower=True), n)
            total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(W.mixed(g ^ np.uint64(0x5DEECE66D)))))
            other = np.concatenate((np.zeros(1, np.uint64), np.cumsum(W.mixed(g + np.uint64(0x2545F4914F6CDD1D)))))
            d1, d2 = (W.signed(x[first[1:]] - x[first[:-1]]) for x in (total, other))
            parity, fine = _parities(g, first)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(first)), pa.array(d1), pa.array(d2), *map(pa.array, parity.T.copy()), fine], names=["doc_id", "n_shingles", "d1", "d2", *_PARITY, "fine"])

    return arrow_map(docs, run, "doc_id long, n_shingles long, d1 long, d2 long, " + "".join(f"{c} long, " for c in _PARITY) + "fine binary")


def _block_keys(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """``(key, doc_id)``: one key for each column block of each of the two classes a set may be matched in.

    Two linked sets differ in fewer blocks than ``blocks`` says. If one of them
    fills at least that many, they agree in a block that is not empty; empty
    blocks thus have keys only for sets that fill fewer.
    """

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in W.pieces(batch):
            g, first = sets(W.find(part.column("text"), lower=True), n)
            size = np.diff(first)
            if not len(g):
                continue
            low = size_classes(int(size.max()), percent)
            need = blocks(low, percent)
            many = spare(need, low[:-2])
            own = np.searchsorted(low, size, side="right") - 1
            ids = part.column("doc_id").to_numpy()
            spread = W.mixed(g + np.uint64(0x632BE59BD9B4E019))
            for step in (0, 1):  # as the smaller of two, or as the larger with a partner in the class below
                level = own - step
                use = (size > 0) & (level >= 0)
                m = np.where(use, many[np.maximum(level, 0)], 0)
                at = np.cumsum(m) - m
                inside = np.repeat(use, size)
                where = (np.repeat(at, size) + (g % np.repeat(np.maximum(m, 1), size).astype(np.uint64)).astype(np.int64))[inside]
                v, total = spread[inside], int(m.sum())
                sums = [np.bincount(where, (v >> np.uint64(s) & np.uint64(0xFFFFFFFF)).astype(np.float64), total).astype(np.uint64) for s in (0, 32)]
                place = W.flat_ranges(np.zeros(len(m), np.int64), m).astype(np.uint64)
                key = W.mixed(W.mixed(sums[0] + sums[1] * np.uint64(0x9E3779B97F4A7C15)) + place * W._PLACE[1] + np.repeat(level, m).astype(np.uint64) * W._PLACE[2])
                asks = np.bincount(where, minlength=total) > 0
                filled = np.concatenate(([0], np.cumsum(asks)))
                asks |= np.repeat(filled[at + m] - filled[at] < need[np.maximum(level, 0)], m)
                yield pa.RecordBatch.from_arrays([pa.array(W.signed(key[asks])), pa.array(np.repeat(ids, m)[asks])], names=["key", "doc_id"])

    return arrow_map(docs, run, "key long, doc_id long")


def _possible(a: str, b: str, percent: int) -> Column:
    """Size-derived bounds of a pair: of the sizes themselves, and of how many n-grams the two must differ in at least.

    N-grams outside the overlap show in the parities: a bit in which two sets
    differ takes one such n-gram at least, so no linked pair is ruled out.
    """
    na, nb = F.col(f"{a}size"), F.col(f"{b}size")
    differ = sum((F.bit_count(F.col(a + c).bitwiseXOR(F.col(b + c))) for c in _PARITY), F.lit(0))
    return (F.least(na, nb) * 100 >= percent * F.greatest(na, nb)) & (differ * (100 + percent) <= (na + nb) * (100 - percent))


def _sided(stored: DataFrame, side: str, *columns: str) -> DataFrame:
    """``stored`` with ``side`` before its columns' names, its id named ``side``."""
    return stored.select(F.col("doc_id").alias(side), *(F.col(c).alias(f"{side}_{c}") for c in ("size", *_PARITY, *columns)))


def _likely(pairs: DataFrame, stored: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` that the bounds allow, told without their n-grams."""
    return pairs.join(_sided(stored, "a"), "a").join(_sided(stored, "b"), "b").where(_possible("a_", "b_", percent)).select("a", "b")


def _differ(x: bytes, y: bytes) -> int:
    """In so many n-grams two sets differ at least, by their fine parities; those of more hash values are folded."""
    most, p, q = min(len(x), len(y)), int.from_bytes(x, "little"), int.from_bytes(y, "little")
    for half in (len(x) >> k for k in range(1, 64) if len(x) >> k >= most > 0):
        p = (p >> 8 * half) ^ (p & (1 << 8 * half) - 1)
    for half in (len(y) >> k for k in range(1, 64) if len(y) >> k >= most > 0):
        q = (q >> 8 * half) ^ (q & (1 << 8 * half) - 1)
    return (p ^ q).bit_count() if most else 0


def _near(pairs: DataFrame, stored: DataFrame, percent: int) -> DataFrame:
    """``(a, b, a_size)``: the pairs ``(a, b)`` that their fine parities allow."""
    both = pairs.join(_sided(stored, "a", "fine"), "a").join(_sided(stored, "b", "fine"), "b").select("a", "b", "a_size", "b_size", "a_fine", "b_fine")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        size = batch.column("a_size").to_numpy() + batch.column("b_size").to_numpy()
        differ = np.array([_differ(x.as_py(), y.as_py()) for x, y in zip(batch.column("a_fine"), batch.column("b_fine"))], np.int64)
        keep = pa.array(differ * (100 + percent) <= size * (100 - percent))
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("a", "b", "a_size")], names=["a", "b", "a_size"])

    return arrow_map(both, run, "a long, b long, a_size long")


def _verified(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose overlap reaches the bound; ``texts`` has each of their documents once."""
    side = lambda x: texts.select(F.col("doc_id").alias(x), F.col("text").alias(f"t{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ta", "tb")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in (p for q in W.pieces(batch, "ta") for p in W.pieces(q, "tb")):
            found, place, many = [], [], 0
            for x in ("a", "b"):  # each text once
                _, one, which = np.unique(part.column(x).to_numpy(), return_index=True, return_inverse=True)
                found.append(part.column(f"t{x}").take(pa.array(one)))
                place.append(which + many)
                many += len(one)
            g, first = sets(W.find(pa.concat_arrays(found), lower=True), n)
            ok = []
            for i, j in zip(*place):
                x, y = g[first[i] : first[i + 1]], g[first[j] : first[j + 1]]
                at = np.searchsorted(x, y)
                at[at == len(x)] = 0
                overlap = int((x[at] == y).sum())
                ok.append(100 * overlap >= percent * (len(x) + len(y) - overlap))
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([part.column("a").filter(keep), part.column("b").filter(keep)], names=["a", "b"])

    return arrow_map(both, run, "a long, b long")


def _links(pairs: DataFrame, known: DataFrame, stored: DataFrame, n: int, percent: int, grams: int) -> DataFrame:
    """The links among ``pairs``; the documents ``known`` have ``grams`` n-grams."""
    near = stash(_near(pairs, stored, percent), "jaccard-near")
    links = []
    for part in _parts(near, "a, b", PAIRS * (near.agg(F.sum("a_size")).first()[0] or 0), grams):
        need = part.select(F.col("a").alias("doc_id")).unionByName(part.select(F.col("b").alias("doc_id"))).distinct()
        texts = stash(known.join(need, "doc_id", "left_semi").dropDuplicates(["doc_id"]), "jaccard-texts")
        links.append(stash(_verified(part.select("a", "b"), texts, n, percent), "jaccard-links", spent=[texts]))
    return reduce(DataFrame.unionByName, links)


def _apart(rows: DataFrame, stored: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` of a block in ``rows(key, doc_id, comp)`` that are in different components and that the bounds allow."""
    left = rows.select("key", F.col("doc_id").alias("a"), F.col("comp").alias("comp_a")).join(_sided(stored, "a"), "a")
    right = rows.select("key", F.col("doc_id").alias("b"), F.col("comp").alias("comp_b")).join(_sided(stored, "b"), "b")
    return left.join(right, "key").where(F.expr("a < b AND comp_a <> comp_b") & _possible("a_", "b_", percent)).select("a", "b").distinct()


def _parts(rows: DataFrame, by: str, weight: int, grams: int) -> list[DataFrame]:
    """``rows`` dealt by ``by`` into so many parts that each has a ``weight`` below the number of n-grams."""
    many = 1 + weight // grams
    return [rows.where(F.expr(f"pmod(xxhash64({by}), {many}) = {k}")) for k in range(many)]


def join(docs: DataFrame, n: int = N, percent: int = PERCENT, star_rounds: int = STAR_ROUNDS) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``docs(doc_id, text)``."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    known = docs.where("doc_id IS NOT NULL")
    sized = stash(_sizes(docs, n), "jaccard-sizes")
    first = stash(sized.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("n_shingles", "d1", "d2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "jaccard-classes")
    reps = first.select(F.col("rep").alias("doc_id"))
    if 2 * first.count() <= sized.count():  # keys of copies would outweigh the texts of one of each
        known = stash(known.join(reps, "doc_id", "left_semi"), "jaccard-reps")

    # a document has a key once; repeated rows of one may pass here and are one row below
    shared = shared_keys(_block_keys(known, n, percent), "key", None, "jaccard")
    rows = stash(shared.distinct().join(reps, "doc_id", "left_semi"), "jaccard-rows")
    # a block that only one class of equal sets holds asks for nothing
    rows = stash(shared_keys(rows, "key", None, "jaccard-classes"), "jaccard-blocks", spent=[rows])
    stored = sized.join(rows.select("doc_id").distinct(), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    stored = stash(stored.select("doc_id", F.col("n_shingles").alias("size"), *_PARITY, "fine"), "jaccard-sets")
    grams = first.agg(F.sum("n_shingles")).first()[0] or 1

    links = tested = labels = None
    for turn in range(star_rounds + 1):
        spent = []
        open_rows = rows.withColumn("comp", F.col("doc_id"))
        if labels is not None:
            open_rows = rows.join(labels, rows["doc_id"] == labels["node"], "left").select("key", "doc_id", F.coalesce("component", "doc_id").alias("comp"))
            mixed = open_rows.groupBy("key").agg(F.min("comp").alias("_a"), F.max("comp").alias("_b")).where("_a <> _b").select("key")
            mixed = stash(mixed, "jaccard-open")
            if mixed.isEmpty():  # every block lies in one component
                break
            open_rows = open_rows.join(mixed, "key")
            spent.append(mixed)
        if turn < star_rounds:
            hub = F.min("doc_id") if turn == 0 else F.min_by("doc_id", F.xxhash64("doc_id", F.lit(turn)))
            hubs = stash(open_rows.groupBy("key").agg(hub.alias("hub"), F.min_by("comp", F.col("doc_id") if turn == 0 else F.xxhash64("doc_id", F.lit(turn))).alias("hub_comp")), "jaccard-hubs")
            spent.append(hubs)
            pairs = open_rows.join(hubs, "key").where("comp <> hub_comp").select(F.least("hub", "doc_id").alias("a"), F.greatest("hub", "doc_id").alias("b"))
        else:
            parts = [stash(_apart(part, stored, percent), "jaccard-apart") for part in _parts(open_rows, "key", KEYS * rows.count(), grams)]
            spent += parts
            pairs = reduce(DataFrame.unionByName, parts)
        pairs = pairs.where("a <> b").distinct()
        if turn < star_rounds:
            pairs = _likely(pairs, stored, percent)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stash(pairs, "jaccard-pairs", spent)
        if labels is not None and pairs.isEmpty():
            continue
        found = _links(pairs, known, stored, n, percent, grams)
        tested = pairs if tested is None else tested.unionByName(pairs)
        if links is not None and found.isEmpty():  # the components stay as they are
            continue
        links = found if links is None else links.unionByName(found)
        labels = components(links, "jaccard-components")

    member = first.join(labels, first["rep"] == labels["node"], "left").select("n_shingles", "d1", "d2", F.coalesce("component", "rep").alias("class_component"))
    out = sized.join(stash(member, "jaccard-members"), ["n_shingles", "d1", "d2"], "left")
    own = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("class_component", "doc_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"))


def one_of_each(docs: DataFrame, **how) -> DataFrame:
    """The documents that name their component, with their columns; rows without a doc_id stay."""
    found = join(docs, **how)
    gone = found.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(stash(gone, "jaccard-gone"), "doc_id", "left_anti").select(*docs.columns)
