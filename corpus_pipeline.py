"""The corpus pipeline: five stages over ``documents``, each written and reread before the next.

Every stage takes all rows its predecessor kept. All but the last return the
columns of ``documents``; the last returns each copy's token ids as digests.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tapeloom.llm import bpe, jaccard, mixing, quality, secrets
from tapeloom.llm.common import read, shared_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that fail the base rules or whose host is rejected."""
    return quality.keep(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies: texts whose sets of five-word shingles reach a similarity of 0.8."""
    return jaccard.one_of_each(docs, n=5, percent=80)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and the bytes they decode to, as digests."""
    return bpe.digests(bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", jaccard_join),
    ("secret scans", secret_scan),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", byte_bpe),
]

#: SQL cannot express secret scans (a trained forest) and byte-pair merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, from the documents of ``sf_dir``."""
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        path = f"{shared_folder(spark)}/pipeline-{k}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
