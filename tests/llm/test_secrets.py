"""The secret scan on planted keys."""

from __future__ import annotations

import hashlib
import re

import corpus_pipeline
from tapeloom.llm import queries as Q
from tapeloom.llm import secrets

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, texts):
    return spark.createDataFrame([(i, t, "en", "a.example", None if t is None else len(t)) for i, t in enumerate(texts)], COLUMNS)


def key(k, size=40):
    return hashlib.sha256(str(k).encode()).hexdigest()[:size]


def test_keys_are_found_where_no_finding_is_surely_harmless(spark, tmp_path):
    texts = [f'plain words before token = "{key(k)}" and after' for k in range(6)] + [f"TOKEN: {key(6)}\n", None, "", "plain words"]
    table(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    found = Q.op9_secret_scan(spark, str(tmp_path)).toPandas()
    assert sorted(found.doc_id[found.is_secret]) == list(range(7))
    assert set(found.candidate_sha256) == {hashlib.sha256(key(k).encode()).hexdigest() for k in range(7)}
    clean = {r["doc_id"]: r for r in corpus_pipeline.secret_scan(spark, table(spark, texts), str(tmp_path)).collect()}
    for i, text in enumerate(texts):
        want = text and text.replace(key(i), secrets.MASK)
        assert (clean[i]["text"], clean[i]["n_chars"]) == (want, None if want is None else len(want))


def test_short_and_unusual_values_of_credentials_are_found(spark, tmp_path):
    planted = {
        'password = "tr0ub4dor3xyz"': "tr0ub4dor3xyz",
        "api_key='" + key(1, 16) + "'": key(1, 16),
        'db.password: "p@ss.w0rd!9x"': "p@ss.w0rd!9x",
        '{"passwd": "Zx9!kQ2m", "a": 1}': "Zx9!kQ2m",
        'MY_VERY_LONG_APPLICATION_SECRET_NAME="q7Hd82kLw0"': "q7Hd82kLw0",
        f'token = "{key(2)}"': key(2),
    }
    harmless = ["The password: required for all", "access: unlimited, says the author: Johannes", "commit " + key(3), "Donaudampfschifffahrtsgesellschaft"]
    texts = [f"Some words. {line} and more" for line in [*planted, *harmless] for _ in range(4)]
    table(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    found = Q.op9_secret_scan(spark, str(tmp_path)).toPandas()
    hits = found[found.is_secret]
    assert sorted(hits.doc_id) == list(range(4 * len(planted)))
    for r in hits.to_dict("records"):
        value = list(planted.values())[r["doc_id"] // 4]
        assert texts[r["doc_id"]][r["start"] : r["start"] + r["n_chars"]] == value
        assert r["candidate_sha256"] == hashlib.sha256(value.encode()).hexdigest()
    clean = {r["doc_id"]: r["text"] for r in secrets.redact(table(spark, texts)).collect()}
    for i, text in enumerate(texts):
        assert clean[i] == (text.replace(list(planted.values())[i // 4], secrets.MASK) if i < 4 * len(planted) else text)


def test_candidates_and_their_places(spark):
    cases = {
        "token=abcdefgh12345678XYZ9 end": ["abcdefgh12345678XYZ9"],
        f"https://a.example/x?token={key(1)}&next=page": [key(1)],
        "Authorization: Bearer abc123def456.": ["abc123def456"],
        'secret: "two words 12" and pwd => \'short\'': ["two words 12"],
        f"see {key(2)}, then (password: s3cr3t;value).": [key(2), "s3cr3t;value"],
        'password = "' + "x1" * 300 + '"': ["x1" * 300],
        "no credential = somevalue1 but name = other": ["somevalue1"],
        "name = somevalue1": [],
    }
    rows = secrets.findings(table(spark, list(cases))).orderBy("doc_id", "no").collect()
    for i, (text, want) in enumerate(cases.items()):
        got = [r for r in rows if r["doc_id"] == i]
        assert [r["candidate"] for r in got] == want, text
        assert all(text[r["start"] : r["start"] + len(r["candidate"])] == r["candidate"] for r in got)


def test_candidates_and_places_equal_a_plain_version(spark, tables):
    pattern = re.compile(secrets.CANDIDATE.replace(r"\z", r"\Z"), re.ASCII)
    docs = spark.read.parquet(f"{tables.replace('0.001', '0.01')}/documents.parquet")
    got = {(r["doc_id"], r["no"]): (r["start"], r["candidate"]) for r in secrets.findings(docs).select("doc_id", "no", "start", "candidate").collect()}
    want = {}
    for r in docs.select("doc_id", "text").collect():
        for no, m in enumerate(pattern.finditer(r["text"] or "")):
            k = 3 if m.group(3) else 2
            want[r["doc_id"], no] = (m.start(k), m.group(k))
    assert len(want) > 10 and got == want


def test_the_dictionary_is_the_corpus_own(spark):
    docs = table(spark, ["alpha beta Beta gamma abc", "beta gamma delta, delta", None, ""])
    assert secrets.dictionary(docs, 3) == ("beta", "delta", "gamma")
    assert secrets.dictionary(docs.where("false")) == ()


def test_held_out_strings_of_given_labels(spark):
    """Labels that the rules would not give: keys with a prefix, in plain sentences, among words and identifiers."""
    lines, label = [], {}
    for k in range(300):
        for value, of in ((f"sk_live_{key(k, 24)}", 1.0), (f"{'internationalisation' * 2}{chr(97 + k % 26) * (k // 26 + 1)}", 0.0)):
            lines.append(f"the value {value} was seen here")
            label[value] = of
    found = secrets.findings(table(spark, lines), ("international", "isation", "value"))
    labels = spark.createDataFrame(list(label.items()), "candidate string, label double")
    got = secrets.measure(found.join(labels, "candidate"))
    assert got["n"] > 60 and got["precision"] > 0.95 and got["recall"] > 0.95


def test_redact_keeps_columns_whatever_their_names(spark):
    rows = [(0, f'token = "{key(1)}"', "en", "s", 5, 1, "a", "b"), (0, f'token = "{key(1)}"', "en", "s", 5, 1, "a", "b"), (None, None, None, None, None, 2, "c", "d"), (None, f'password = "{key(2)}"', "en", None, 9, 3, "e", "f")]
    docs = spark.createDataFrame(rows, COLUMNS + ", _id long, _hash string, _secrets string")
    out = secrets.redact(docs)
    assert out.schema == docs.schema
    got = sorted((r["_id"], r["text"], r["n_chars"], r["_hash"]) for r in out.collect())
    one = f'token = "{secrets.MASK}"'
    assert got == [(1, one, len(one), "a")] * 2 + [(2, None, None, "c"), (3, f'password = "{secrets.MASK}"', len(f'password = "{secrets.MASK}"'), "e")]


def test_a_quoted_value_of_any_length_is_one_candidate(spark):
    phrase = " ".join(f"word{k}" for k in range(200))
    texts = [f'password = "{phrase}" and more', f"secret: '{phrase}'\nnext line", 'token = "' + "open quote without an end " * 40_000, 'password="' * 20_000]
    got = secrets.findings(table(spark, texts)).select("doc_id", "candidate").collect()
    assert [r["candidate"] for r in got if r["doc_id"] in (0, 1)] == [phrase, phrase]
