"""The registered queries of this subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, jaccard, langid, lm, mainhtml, mixing, mtree, quality, repair, secrets, spelling, substring, whitening
from .common import read


def tokenizer_file(name: str) -> str:
    """A public vocabulary file's place on this machine and on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digests(substring.dedup(read(spark, sf_dir, "documents")))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.judge(read(spark, sf_dir, "documents"))
    return out.select("doc_id", *quality.FEATURES, "base_failed", "kept")


def op3_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.digests(repair.written(read(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json")))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(read(spark, sf_dir, "documents"))


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_k(read(spark, sf_dir, "embeddings"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(read(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "no", "start", F.length("candidate").alias("n_chars"), F.sha2("candidate", 256).alias("candidate_sha256"), "probability", "is_secret")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read(spark, sf_dir, "documents")
    return bpe.digests(bpe.encode(docs, tokenizer_file("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(read(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mainhtml.extract(read(spark, sf_dir, "pages"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and k[2:3].isdigit()}


#: Base features and host verdicts; the window and line counts follow the operator's definitions.
_QUALITY = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
tw AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1),
rep AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM tw) GROUP BY doc_id),
l AS (SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dl AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM l GROUP BY doc_id),
b AS (SELECT d.doc_id, d.source, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
  len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(dl.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN rep ON d.doc_id = rep.doc_id LEFT JOIN dl ON d.doc_id = dl.doc_id),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b),
r AS (SELECT f.doc_id, f.source, rule, coalesce(CASE rule WHEN 1 THEN n_words < 50 WHEN 2 THEN 100 * n_repeat_words > 50 * n_words ELSE base_failed END, false)::INT AS bad FROM f, (VALUES (1), (2), (3)) v(rule)),
h AS (SELECT source, rule, count(*) AS n, sum(bad) AS k FROM r GROUP BY source, rule),
t AS (SELECT rule, sum(n) AS docs, count(*) AS hosts, sum(k) / sum(n) AS m, (sum(n) - sum(n * n) / sum(n)) / nullif(count(*) - 1, 0) AS usual FROM h GROUP BY rule),
v AS (SELECT t.rule, any_value(m) AS m, any_value(usual) AS usual, sum(n * (k / n - m) ** 2) / nullif(any_value(hosts) - 1, 0) AS b, sum(n * (k / n) * (1 - k / n)) / nullif(any_value(docs) - any_value(hosts), 0) AS w
  FROM h JOIN t ON h.rule = t.rule GROUP BY t.rule),
a AS (SELECT rule, m, (b - w) / nullif(b + (usual - 1) * w, 0) AS alike FROM v),
q AS (SELECT rule, m, CASE WHEN alike > 1.0 / 10001 THEN 1 / least(alike, 1.0) - 1 ELSE 10000.0 END AS s FROM a),
x AS (SELECT source, bool_or((k + m * s) / (n + s) > 0.5) AS rejected FROM h JOIN q ON h.rule = q.rule GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT rejected AS kept
FROM f JOIN x ON f.source IS NOT DISTINCT FROM x.source
"""


_TOP_K = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10
"""


#: Windows by their words, the least document of each, and the positions that they cover.
_SUBSTRING = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, i, w[i:i + 12] AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
f AS (SELECT k, min(doc_id) AS earliest FROM p GROUP BY k),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS j FROM p JOIN f ON p.k = f.k WHERE earliest < doc_id),
u AS (SELECT doc_id, i, w[i] AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
r AS (SELECT u.doc_id, count(g.j) AS n_removed, string_agg(x, ' ' ORDER BY i) FILTER (g.j IS NULL) AS kept FROM u LEFT JOIN g ON u.doc_id = g.doc_id AND u.i = g.j GROUP BY u.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN r ON d.doc_id = r.doc_id
"""

#: Overlaps of all pairs with a common shingle, and what is reachable by links.
_JACCARD = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(CASE WHEN len(w) < 3 THEN w ELSE w[i:i + 2] END, ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, least(len(w), 1)) + 1)) AS i FROM d)),
n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT a, b FROM o JOIN n x ON o.a = x.doc_id JOIN n y ON o.b = y.doc_id WHERE 100 * shared >= 90 * (x.size + y.size - shared)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(size, 0)::BIGINT AS n_shingles, component_id FROM d LEFT JOIN n ON d.doc_id = n.doc_id JOIN c ON d.doc_id = c.a
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_substring_dedup": _SUBSTRING, "op2_quality_rules": _QUALITY, "op6_jaccard_join": _JACCARD, "op7_exact_top_k": _TOP_K}
