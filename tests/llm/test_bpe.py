"""Overlapping chunks against the library: chunks far shorter than the texts, and texts that never resynchronise."""

from __future__ import annotations

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from tapeloom.llm import bpe
from tapeloom.llm import queries as Q


@pytest.mark.parametrize("chunk,overlap", [(64, 16), (200, 40), (bpe.CHUNK, bpe.OVERLAP)])
def test_chunks_equal_the_whole(spark, tables, chunk, overlap):
    with open(Q.tokenizer_file("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    encoding = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(2)
    texts = [r["text"] for r in spark.read.parquet(f"{tables}/documents.parquet").select("text").limit(40).collect()]
    texts += ["a" * 1000, " " * 700, "\n" * 500, "x" * 63, "x" * 64, "x" * 65, "ab " * 300, "don't we'll " * 60, "1234567890" * 40, "日本語のテキスト" * 50, "é́    \x1c\x85" * 60, "😀👍🏽" * 80]
    texts += ["".join(rng.choice("ab 1.,\n\t'é日") for _ in range(rng.randrange(1, 900))) for _ in range(120)]
    texts += [" ".join(rng.choice(["word", "  ", "Zahl 12", "!?", "\r\n"]) for _ in range(200_000)), None, "", None]  # over a million characters
    rows = [(k if k % 9 else None, t, k) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row int").repartition(4)
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.digests(bpe.encode(docs, Q.tokenizer_file("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, chunk, overlap)).collect())
    want = []
    for i, t, _ in rows:
        ids = encoding.encode_ordinary(t or "")
        raw = b"".join(x.to_bytes(4, "little") for x in ids)
        want.append((-1 if i is None else i, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want)
