"""Rows without an id, repeated rows, a text of over a million characters and columns with internal names, for every operator on documents."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from tapeloom.llm import queries as Q

EXTRA = ("_row", "_id", "_hash", "_k", "_h", "shard", "fold", "key", "anchor", "rows")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(12)
    words = [f"w{k}" for k in range(800)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    one, two = text(90), text(120)
    rows = [(k, text(70), "en" if k % 2 else "de", f"h{k % 3}") for k in range(40)]
    rows += [(3, one, "en", "h0"), (3, one, "en", "h0"), (3, one, "en", "h0"), (None, one, "en", "h1"), (None, one, "en", "h1"), (None, two, None, None), (None, None, None, None), (None, "", "de", "h1")]
    rows += [(50, one, "en", "h2"), (51, two, None, None), (52, None, "en", None), (53, None, "en", None), (60, text(180_000), "de", "h0")]
    path = str(tmp_path_factory.mktemp("edges"))
    made = [(i, t, lang, s, None if t is None else len(t), *[7] * len(EXTRA)) for i, t, lang, s in rows]
    spark.createDataFrame(made, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} int" for c in EXTRA)).repartition(3).write.parquet(f"{path}/documents.parquet")
    return path


@pytest.fixture(scope="module")
def ids(spark, folder):
    return Counter(r[0] for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id").collect())


@pytest.mark.parametrize("name", ["op1_substring_dedup", "op2_quality_rules", "op3_token_ids", "op4_language_id", "op5_mixing", "op6_jaccard_join", "op8_lm_scoring", "op10_byte_bpe"])
def test_every_row_has_its_result(spark, folder, ids, name):
    got = Q.queries()[name](spark, folder).collect()
    assert Counter(r["doc_id"] for r in got) == ids
    if name == "op1_substring_dedup":  # copies of one id do not remove each other's words, a later id's do
        assert [r["n_removed"] for r in got if r["doc_id"] == 3] == [0] * 4 and [r["n_removed"] for r in got if r["doc_id"] == 50] == [90]
        assert all(r["n_removed"] == 0 for r in got if r["doc_id"] is None)
    if name == "op6_jaccard_join":
        assert {r["component_id"] for r in got if r["doc_id"] in (3, 50)} == {3}
        assert all(r["component_id"] is None for r in got if r["doc_id"] is None)
    if name in ("op4_language_id", "op8_lm_scoring"):
        assert not any(r["held_out"] for r in got if r["doc_id"] is None)
    if name == "op3_token_ids":
        order = sorted(got, key=lambda r: r["start"])
        assert [r["start"] for r in order] == [sum(x["n_tokens"] for x in order[:k]) for k in range(len(order))]
        assert [r["doc_id"] for r in order] == [None] * ids[None] + sorted(x for x in ids.elements() if x is not None)


def test_findings_of_rows_without_an_id(spark, tmp_path):
    key = "a1b2c3d4e5f6a7b8c9d0e1f2a3b4"
    rows = [(None, f'token = "{key}"', "en", None, 5), (None, f'token = "{key}"', "en", None, 5), (4, None, None, None, None), (5, "x " * 600_000 + f'secret: "{key}"', "en", "s", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = Q.op9_secret_scan(spark, str(tmp_path)).collect()
    assert Counter(r["doc_id"] for r in got if r["is_secret"]) == {None: 2, 5: 1}
    assert {r["start"] for r in got} == {9, 1_200_009}
