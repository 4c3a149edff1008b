"""Stages of the corpus pipeline against plain versions."""

from __future__ import annotations

import random
import re

import corpus_pipeline

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, texts):
    return spark.createDataFrame([(i, t, "en", "a.example", None if t is None else len(t)) for i, t in texts.items()], COLUMNS)


def edited(words, places):
    return " ".join(f"new{k}" if k in places else w for k, w in enumerate(words))


def test_near_copies_leave_one_document(spark, tables):
    rng = random.Random(5)
    texts = {r["doc_id"]: r["text"][:3000] for r in spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text").where("text IS NOT NULL").collect()}
    low = max(texts) + 1
    base = [f"w{k}" for k in range(200)]
    more = [" ".join(base), edited(base, {30, 70, 110, 150}), edited(base, {20, 60, 100, 140, 180}), None, "", "one two", "One two", "one two three four"]
    for size in (60, 250, 900):
        words = [f"v{size}x{rng.randrange(400)}" for _ in range(size)]
        more += [edited(words, set(rng.sample(range(size), k))) for k in (0, size // 60, size // 45, size // 30, size // 10)]
    texts |= {low + k: t for k, t in enumerate(more)}
    sets = {}
    for i, text in texts.items():
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(w[p : p + 5]) for p in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    assert top(low + 1) == low  # 0.81 on five words, 0.886 on three
    got = corpus_pipeline.jaccard_join(spark, table(spark, texts), tables)
    assert sorted(r["doc_id"] for r in got.select("doc_id").collect()) == [i for i in ids if top(i) == i]


def test_stages_keep_columns_whatever_their_names(spark, tables):
    rng = random.Random(6)
    words = [f"w{k}" for k in range(500)]
    rows = []
    for k in range(60):
        text = " ".join(rng.choice(words) for _ in range(80))
        rows.append((k, text, "en", f"h{k % 4}", len(text), k, k, k, k, k, k))
    rows += [rows[3], rows[3], (None, rows[0][1] + " more words", "en", None, 5, -1, -1, -1, -1, -1, -1), (99, None, None, None, None, -2, -2, -2, -2, -2, -2), (98, "", "en", "h1", 0, -3, -3, -3, -3, -3, -3)]
    docs = spark.createDataFrame(rows, COLUMNS + ", _id int, _hash int, _copy int, _copies int, _n_words int, node int")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, tables)
        assert out.schema.simpleString() == docs.schema.simpleString(), name
        for r in out.collect():
            assert r["_id"] == r["_hash"] == r["_copy"] == r["_copies"] == r["_n_words"] == r["node"], name
    kept = {r["doc_id"] for r in corpus_pipeline.quality_rules(spark, docs, tables).collect()}
    assert kept == {None, *range(60)}
    assert corpus_pipeline.byte_bpe(spark, docs, tables).count() == len(rows)


def test_run_on_plain_documents_and_on_none(spark, tmp_path):
    """The chain against what it must do to a small table: short texts go, one of each copy stays, keys are masked, copies follow the mix."""
    import hashlib
    from collections import Counter

    rng = random.Random(8)
    words = [f"w{k}" for k in range(2000)]
    texts = {k: " ".join(rng.choice(words) for _ in range(100)) for k in range(40)}
    texts |= {40: texts[1], 41: texts[2] + " w1", 42: "too short", 43: None, 44: texts[5] + f' token = "{hashlib.sha256(b"x").hexdigest()}" ' + texts[6]}
    rows = [(k, t, "en", f"h{k % 3}", None if t is None else len(t)) for k, t in texts.items()]
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{tmp_path}/full/documents.parquet")
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/empty/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").count() == 0
    got = corpus_pipeline.run(spark, f"{tmp_path}/full").collect()
    kept = {k for k in texts if k not in (40, 41, 42, 43)}
    masked = re.sub('"[0-9a-f]{64}"', '"[SECRET]"', texts[44])
    want = {k: hashlib.sha256((masked if k == 44 else texts[k]).encode()).hexdigest() for k in kept}
    assert {(r["doc_id"], r["decoded_sha256"]) for r in got} <= set(want.items())
    sizes = {k: len(WORD.findall(masked if k == 44 else texts[k])) for k in kept}
    total, taken, times = Counter(), Counter(), Counter(r["doc_id"] for r in got)
    for k in kept:
        total[k % 3] += sizes[k]
        taken[k % 3] += sizes[k] * times[k]
    assert max(times.values()) <= 2
    assert abs(sum(taken.values()) - 1.5 * sum(total.values())) <= max(sizes.values())
    assert all(taken[h] <= 2 * total[h] for h in total)
    assert taken[0] == 2 * total[0]  # weighs most: its target is all it has, twice
