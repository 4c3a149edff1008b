"""Byte-level BPE encoding by overlapping chunks, and decoding by joining raw bytes.

A text of up to ``chunk`` characters is encoded where it is read. A longer one
is cut into chunks that overlap; every chunk is pre-tokenised on its own, in
parallel, and two neighbours are stitched at the first position in their
overlap where both begin a pre-token. The pattern never looks back, so from a
common boundary on both agree with the pre-tokens of the whole text. The pieces
between the cuts are then encoded independently and their ids concatenated.
A text with an overlap in which nothing resynchronises (a run of one character,
say) is encoded in one piece instead.

Null texts count as empty and give no ids. Rows that repeat a doc_id are
encoded one by one and all returned; a null doc_id is kept. Only ``doc_id`` and
``text`` are read, so other columns may have any names.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, stash

CHUNK, OVERLAP = 1 << 14, 1 << 10
#: Characters on which regular-expression engines disagree whether they are white space.
UNSURE = frozenset("\x1c\x1d\x1e\x1f\x85᠎​﻿")


@lru_cache(maxsize=4)
def _encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def _pattern(pattern: str):
    import regex

    return regex.compile(pattern)


def boundaries(text: str, pattern: str, low: int, high: int) -> list[int]:
    """Where pre-tokens of ``text`` begin, from ``low`` to ``high``; the end of a text that is cut off is none."""
    out = []
    for m in _pattern(pattern).finditer(text):
        if m.start() > high:
            break
        if m.start() >= low and not UNSURE.intersection(text[max(0, m.start() - 2) : m.start() + 2]):
            out.append(m.start())
    return out


def encode(docs: DataFrame, ranks: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``(doc_id, n_tokens, ids, decoded)`` of every row of ``docs(doc_id, text)``.

    ``ids`` holds the ids as little-endian unsigned 32-bit integers, ``decoded``
    the bytes that they decode to. ``ranks`` is the path of a vocabulary file on
    every executor, ``pattern`` its pre-token expression.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    out = "doc_id long, n_tokens long, ids binary, decoded binary"

    def coded(texts: list[str]) -> list[pa.Array]:
        enc = _encoding(ranks, pattern)
        ids = [enc.encode_ordinary(t) for t in texts]
        return [
            pa.array([len(x) for x in ids], pa.int64()),
            pa.array([np.asarray(x, "<u4").tobytes() for x in ids], pa.binary()),
            pa.array([enc.decode_bytes(x) for x in ids], pa.binary()),
        ]

    def whole(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for i in range(0, batch.num_rows, 200):
            part = batch.slice(i, 200)
            n, ids, raw = coded(part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), n, ids, raw], names=["doc_id", "n_tokens", "ids", "decoded"])

    long = docs.where(F.length("text") > chunk).withColumn("_row", F.monotonically_increasing_id())
    short = arrow_map(docs.where(F.length("text") <= chunk), whole, out)
    return short.unionByName(_long(long, coded, pattern, chunk, overlap))


def _long(docs: DataFrame, coded, pattern: str, chunk: int, overlap: int) -> DataFrame:
    names = ["_row", "doc_id", "no", "last", "part"]

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row, doc, text in zip(*(batch.column(c).to_pylist() for c in ("_row", "doc_id", "text"))):
            n = -(-len(text) // chunk)
            for i in range(n):
                part = text[i * chunk : (i + 1) * chunk + overlap]
                yield pa.RecordBatch.from_pylist([{"_row": row, "doc_id": doc, "no": i, "last": i == n - 1, "part": part}], schema=pa.schema([("_row", pa.int64()), ("doc_id", pa.int64()), ("no", pa.int32()), ("last", pa.bool_()), ("part", pa.string())]))

    spark = docs.sparkSession
    parts = stash(arrow_map(docs, cut, "_row long, doc_id long, no int, last boolean, part string").repartition("_row", "no"), "bpe-parts")

    def bounds(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        head, tail = [], []
        for i, last, part in zip(*(batch.column(c).to_pylist() for c in ("no", "last", "part"))):
            head.append(boundaries(part, pattern, 1, overlap - 1) if i else [])
            tail.append([] if last else [p - chunk for p in boundaries(part, pattern, chunk + 1, min(len(part), chunk + overlap) - 1)])
        yield pa.RecordBatch.from_arrays([batch.column("_row"), batch.column("no"), pa.array(head, pa.list_(pa.int32())), pa.array(tail, pa.list_(pa.int32()))], names=["_row", "no", "head", "tail"])

    seen = arrow_map(parts, bounds, "_row long, no int, head array<int>, tail array<int>")
    # The cut before a chunk, counted from the chunk's begin: joined by number, not by a window over a text's chunks.
    after = seen.select("_row", (F.col("no") + 1).alias("no"), "tail")
    cuts = seen.where("no > 0").select("_row", "no", "head").join(after, ["_row", "no"]).select("_row", "no", F.array_min(F.array_intersect("head", "tail")).alias("cut"))
    cuts = stash(cuts, "bpe-cuts")
    failed = cuts.where("cut IS NULL").select("_row").distinct().withColumn("serial", F.lit(True))
    nxt = cuts.select("_row", (F.col("no") - 1).alias("no"), F.col("cut").alias("until"))
    cutted = (
        parts.join(cuts, ["_row", "no"], "left").join(nxt, ["_row", "no"], "left").join(failed, "_row", "left")
        .withColumn("begin", F.when(F.col("serial"), 0).otherwise(F.coalesce("cut", F.lit(0))))
        .withColumn("end", F.when(F.col("serial") | F.col("last"), F.lit(chunk)).otherwise(F.col("until") + chunk))
        .select("_row", "doc_id", "no", "serial", F.expr("substring(part, begin + 1, end - begin)").alias("text"))
    )
    rejoined = cutted.where("serial").groupBy("_row", "doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("no", "text"))), lambda x: x["text"]), "").alias("text"))
    ready = cutted.where("serial IS NULL").select("_row", "doc_id", "no", "text").unionByName(rejoined.select("_row", "doc_id", F.lit(0).alias("no"), "text"))

    def encoded(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for i in range(0, batch.num_rows, 20):
            part = batch.slice(i, 20)
            n, ids, raw = coded(part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([part.column("_row"), part.column("doc_id"), part.column("no"), n, ids, raw], names=["_row", "doc_id", "no", "n", "ids", "raw"])

    pieces = arrow_map(ready, encoded, "_row long, doc_id long, no int, n long, ids binary, raw binary")
    joined = lambda c: F.unhex(F.array_join(F.transform("got", lambda x: F.hex(x[c])), ""))
    return (
        pieces.groupBy("_row", "doc_id").agg(F.sum("n").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("no", "ids", "raw"))).alias("got"))
        .select("doc_id", "n_tokens", joined("ids").alias("ids"), joined("raw").alias("decoded"))
    )


def digests(coded: DataFrame) -> DataFrame:
    """The contract's columns from the operator's ids and bytes."""
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
