"""Token ids of texts that hold the text of an added token."""

from __future__ import annotations

import zlib

from tokenizers import Tokenizer

from tapeloom.llm import queries as Q


def test_added_tokens_are_encoded_as_the_library_does(spark, tmp_path):
    path = Q.tokenizer_file("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    texts = ["one two"]
    for x in tokenizer.get_added_tokens_decoder().values():
        t = x.content
        texts += [t, f"one {t} two", f"one{t}two", f" {t}{t}\n{t} ", f"({t})", t.upper(), t[:-1], f"h\u00e9llo{t}w\u00f6rld", f"One {t}, Two."]
    texts += [None, "", "one two"]
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in Q.op3_token_ids(spark, str(tmp_path)).collect()}
    assert len(texts) > 4 and len(got) == len(texts)
    start = 0
    for i, text in enumerate(texts):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        raw = b"".join(x.to_bytes(4, "little") for x in ids)
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (start, len(ids), zlib.crc32(raw)), text
        start += len(ids)


def test_any_stretch_of_a_document_is_decoded_alone(spark, tables, tmp_path):
    from tapeloom.llm import repair

    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text").collect()]
    rows += [(10_000 + k, "the same passage again and again " * 40) for k in range(30)] + [(20_000, None), (20_001, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    path = str(tmp_path / "ids")
    repair.write(docs, Q.tokenizer_file("word_bpe_49k.json"), path, shard=40_000)
    whole = {r["doc_id"]: r["ids"] for r in repair.read(spark, path).collect()}
    import numpy as np

    seen, folded = 0, 0
    for shard in spark.read.parquet(path).collect():
        row = shard.asDict()
        folded += row["n_ids"] - len(row["seq"]) // 2
        for k, i in enumerate(np.frombuffer(row["doc_ids"], np.int64).tolist()):
            ids = np.frombuffer(whole[i], "<u4")
            assert (repair.document(row, k) == ids).all()
            for first, many in ((0, 1), (len(ids) // 3, 7), (len(ids) - 1, 5), (len(ids), 3)):
                assert (repair.document(row, k, first, many) == ids[first : first + many]).all()
            seen += 1
    assert seen == len(rows) and folded > 0


def test_grammar_runs_until_no_pair_is_frequent():
    import numpy as np

    from tapeloom.llm import repair

    rng = np.random.default_rng(5)
    for ids in (np.tile(np.arange(2, 66), 200), rng.integers(2, 9, 5000), np.full(3000, 7), rng.zipf(1.3, 20_000).clip(max=900)):
        counts = np.array([len(ids) // 3, 0, len(ids) - len(ids) // 3])
        seq, upto, rules, sizes = repair.compress(ids.astype(np.uint16), counts, 1000, least=8)
        assert (repair.expand(seq.astype(np.int64), rules, sizes, 1000) == ids).all()
        inner = np.ones(max(len(seq) - 1, 0), bool)
        inner[upto[(upto > 0) & (upto < len(seq))] - 1] = False
        _, many = np.unique((seq[:-1].astype(np.int64) << 16 | seq[1:])[inner], return_counts=True)
        # a pair can overlap with itself, so of a run of one symbol as many as twice are left
        assert many.max(initial=0) < 16
        assert (repair.expansion_lengths(rules, sizes, 1000) == repair.Grammar(rules, sizes, 1000).length[1000:]).all()


def test_words_with_one_hash_keep_their_own_ids(monkeypatch):
    import numpy as np
    import pyarrow as pa

    from tapeloom.llm import repair
    from tapeloom.llm import words as W

    monkeypatch.setattr(W, "span_hashes", lambda data, starts, ends, second=False: (ends - starts).astype(np.uint64))
    coder = repair.WordIds(Q.tokenizer_file("word_bpe_49k.json"))
    texts = ["alpha gamma alpha", "delta omega gamma", "héllo wörld alpha", None, "omega"]
    want = [coder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    for _ in range(2):
        ids, n = coder.encode(pa.array(texts))
        assert n.tolist() == [len(x) for x in want] and ids.tolist() == [x for y in want for x in y]


def test_settings_of_the_session_stay(spark, tmp_path):
    before = {k: spark.conf.get(k) for k in ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch")}
    spark.createDataFrame([(1, "one two three", "en", "s", 13)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    Q.op3_token_ids(spark, str(tmp_path)).collect()
    assert before == {k: spark.conf.get(k) for k in before}
