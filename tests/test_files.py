"""File sources and sinks: bad lines, missing fields and files, empty files, partitions, evolving schemas."""

from __future__ import annotations

import json

import pytest

from tapeloom.operators import keywords as K
from tapeloom.sinks import tables as S
from tapeloom.sources import files as R


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_bad_lines_are_set_apart_and_fields_cast(spark, tmp_path):
    lines = [
        '{"ticker": "AAPL", "d": "2026-07-01", "cash": 0.2, "n": "4"}', '{"ticker": "NVDA", "d": "soon", "cash": "x"}', '{"ticker": null, "d": "2026-07-01"}', "not json", '{"ticker": "MS',
        '{"ticker": "F", "d": "2026-08-01", "extra": [1, 2]}', "",
    ]
    path = put(tmp_path / "faulty/a.ndjson", "\n".join(lines))
    rows, bad = R.tolerant(spark, path, {"ticker": "string", "d": "date", "cash": "double", "n": "int"}, ["ticker"])
    got = {r["ticker"]: (r["d"] and str(r["d"]), r["cash"], r["n"]) for r in rows.collect()}
    assert got == {"AAPL": ("2026-07-01", 0.2, 4), "NVDA": (None, None, None), "F": ("2026-08-01", None, None)}
    assert sorted(r[0] for r in bad.collect()) == ["not json", '{"ticker": "MS']


def test_records_of_documents_that_are_missing_or_hold_no_list(spark, tmp_path):
    schema = "ticker string, x double"
    assert R.records(spark, str(tmp_path / "nowhere.json"), "tickers", schema).count() == 0
    assert R.records(spark, put(tmp_path / "a.json", json.dumps({"tickers": "none"})), "tickers", schema).count() == 0
    assert R.records(spark, put(tmp_path / "b.json", json.dumps({"other": []})), "tickers", schema).count() == 0
    found = R.records(spark, put(tmp_path / "c.json", json.dumps({"tickers": [{"ticker": "A", "x": 1}, {"ticker": "B"}]}, indent=1)), "tickers", schema)
    assert [tuple(r) for r in found.orderBy("ordinal").collect()] == [(0, "A", 1.0), (1, "B", None)]


def test_lists_and_maps(spark, tmp_path):
    text = put(tmp_path / "list.txt", " aapl, MSFT\nmsft,,\n \r\nbrk.b ,aapl")
    assert [tuple(r) for r in R.ticker_list(spark, text).orderBy("place").collect()] == [("AAPL", 0), ("MSFT", 1), ("BRK.B", 2)]
    assert R.ticker_list(spark, put(tmp_path / "empty.txt", "")).count() == 0
    path = put(tmp_path / "universe.csv", "Symbol,Name\n aapl ,Apple\nAAPL,again\n  ,blank\nmsft,Microsoft\n")
    assert sorted(r[0] for r in R.csv_universe(spark, path).collect()) == ["AAPL", "MSFT"]
    path = put(tmp_path / "map.csv", "ticker,sector,industry,source\naapl,Tech,,sp500\n,Tech,x,y\nmsft, , ,z\nf,,Autos,\n")
    assert sorted(map(tuple, R.csv_sector_map(spark, path).collect())) == [("AAPL", "Tech", None, "sp500"), ("F", None, "Autos", None)]


@pytest.mark.parametrize("kind,line,want", [
    ("dividends", {"_ticker": "AAPL", "ex_dividend_date": "2026-07-01", "cash_amount": 0.25, "frequency": 4}, ("AAPL", "2026-07-01", 0.25, None, None, None, 4, None, None)),
    ("splits", {"_ticker": "NVDA", "execution_date": "2026-06-12", "split_from": 1, "split_to": 10}, ("NVDA", "2026-06-12", 1, 10)),
    ("weekly", {"_ticker": "F", "t": 1, "c": 2.5, "n": 7}, ("F", 1, None, None, None, 2.5, None, None, 7)),
])
def test_api_rows(spark, tmp_path, kind, line, want):
    path = put(tmp_path / f"{kind}.ndjson", json.dumps(line) + "\n" + json.dumps({"other": 1}))
    (row,) = R.api_rows(spark, path, kind).collect()
    assert tuple(str(x) if hasattr(x, "year") else x for x in row) == want


def test_partitions_are_replaced_alone(spark, tmp_path):
    rows = lambda *x: spark.createDataFrame(list(x), "ticker string, v int, as_of_date date")
    from datetime import date

    one, two, path = date(2026, 1, 1), date(2026, 1, 2), str(tmp_path / "t")
    S.replace_partitions(rows(("A", 1, one), ("B", 2, one), ("A", 3, two)), path)
    S.replace_partitions(rows(("C", 9, one)), path)
    assert sorted((r["ticker"], r["v"], r["as_of_date"]) for r in spark.read.parquet(path).collect()) == [("A", 3, two), ("C", 9, one)]
    assert [tuple(r)[:2] for r in K.latest_partition(spark.read.parquet(path).select("ticker", "v", "as_of_date")).collect()] == [("A", 3)]


def test_columns_come_and_go(spark, tmp_path):
    path = str(tmp_path / "e")
    assert S.evolve(spark, spark.createDataFrame([(1, "a")], "k bigint, x string"), path).count() == 1
    got = S.evolve(spark, spark.createDataFrame([(2, 0.5)], "k int, y double"), path)
    assert sorted(tuple(r) for r in got.select("k", "x", "y").collect()) == [(1, "a", None), (2, None, 0.5)]


def test_missing_relations_stop_the_job(spark):
    S.create_views(spark, {"tl_there": lambda: spark.range(1)})
    S.require(spark, ["tl_there"])
    with pytest.raises(LookupError, match="tl_gone"):
        S.require(spark, ["tl_there", "tl_gone"])
    S.drop_views(spark, ["tl_there"])
    with pytest.raises(LookupError):
        S.require(spark, ["tl_there"])
