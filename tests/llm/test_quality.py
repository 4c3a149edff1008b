"""Host verdicts: rejected, spared by shrinking, and null hosts; columns with any names."""

from __future__ import annotations

import pytest
from compare import database, difference

from tapeloom.llm import queries as Q
from tapeloom.llm import quality

GOOD = " ".join(f"w{k}" for k in range(60))
BAD = "too few words"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, _n_words string, k0 int, failed boolean"

#: Documents of each host that pass and fail. A few hosts fail throughout, so the prior is weak; "one" has too little to be judged by.
HOSTS = {"bad.example": (5, 195), "good.example": (300, 10), "fair.example": (200, 20), "plain.example": (150, 3), "one.example": (1, 1), None: (10, 190), "half.example": (40, 20)}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("hosts"))
    rows, at = [], 0
    for host, (good, bad) in HOSTS.items():
        for text in [GOOD] * good + [BAD] * bad:
            rows.append((at, text, "en", host, len(text), "mine", at % 3, True))
            at += 1
    rows += [(at, None, None, "good.example", None, None, None, None), (None, GOOD, "en", "good.example", 0, "x", 1, False), (None, GOOD, "en", "good.example", 0, "x", 1, False)]
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{path}/documents.parquet")
    return path


def test_verdicts_match_sql(spark, folder):
    got = Q.op2_quality_rules(spark, folder).toPandas()
    db = database(folder)
    db.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    assert difference(got, db.execute(Q.oracle_sql()["op2_quality_rules"].replace("GROUP BY doc_id)", "GROUP BY doc_id)")).df()) is None


def test_hosts_are_rejected_and_spared(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = {r["source"]: r for r in quality.hosts(quality.base(docs)).collect()}
    assert {h for h, r in found.items() if r["rejected"]} == {"bad.example", None}
    bad, one = found["bad.example"], found["one.example"]
    assert bad["n_few"] == bad["n_failed"] == 195 and bad["n_repeated"] == 0
    assert 0.5 < bad["rate_failed"] < 195 / 200  # shrunk towards the mean
    assert one["rate_failed"] < 0.5
    kept = quality.keep(docs)
    assert kept.columns == docs.columns and kept.schema == docs.schema
    assert kept.count() == sum(g for h, (g, b) in HOSTS.items() if h not in ("bad.example", None)) + 2
    assert {r["_n_words"] for r in kept.select("_n_words").distinct().collect()} == {"mine", "x"}


def test_one_host_and_no_rows(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert quality.keep(docs.where("source = 'good.example'")).count() == 302
    assert quality.keep(docs.where("false")).count() == 0
