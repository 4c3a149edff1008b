"""What is read or computed once: bars dealt by ticker, a ticker's last bar in one pass, a merge's stage."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tapeloom.operators import factors as X
from tapeloom.operators import indicators as I
from tapeloom.operators import merge as M
from tapeloom.operators import views as V
from tapeloom.sinks import commits
from tapeloom.plans import q_factors
from tapeloom.sources import tables as T
from tapeloom.sources.tables import daily_bars


def bars(spark, n, ticker="a"):
    rows = [(ticker, t * 86_400_000, 10.0 + t % 7, 12.0 + t % 7, 9.0 + t % 7, 10.5 + t * 37 % 11, 900.0 if t % 29 == 28 else 100.0 + t % 5, 10.0) for t in range(n)]
    return spark.createDataFrame(rows, "ticker string, timestamp long, open double, high double, low double, close double, volume double, vwap double")


def test_dealt_bars_are_shuffled_and_sorted_once(spark, tables, capsys):
    I.standing(daily_bars(spark, tables, dealt=True)).explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange") == 1 and plan.count("- Sort ") == 1, plan


def test_standing_is_the_views_last_row(spark):
    rows = bars(spark, 230).unionByName(bars(spark, 29, "b")).unionByName(bars(spark, 1, "c"))
    got = {r["ticker"]: r.asDict() for r in I.standing(rows, V.BAR).collect()}
    for want in (V.latest(V.daily(rows)), V.latest(I.with_recurrences(rows, V.BAR))):
        found = want.collect()
        assert len(found) == len(got) == 3
        for row in found:
            for name, value in row.asDict().items():
                have = got[row["ticker"]][name]
                assert have == value or math.isclose(have, value, rel_tol=1e-9), (row["ticker"], name, have, value)


def test_backfill_agrees_with_windows(spark):
    rows = bars(spark, 260)
    got = {r["timestamp"]: r for r in I.backfill(rows, "daily").collect()}
    assert len(got) == 61
    for row in I.bollinger_full(I.anchored_vwap(V.with_averages(rows, full=True))).where("timestamp >= 199 * 86400000L").collect():
        for name in ("sma_20", "sma_200", "bb_upper", "bb_width", "anchored_vwap", "vwap_anchor", "volume_spike"):
            have, value = got[row["timestamp"]][name], row[name]
            assert have == value or math.isclose(have, value, rel_tol=1e-9), (name, have, value)
    assert [r.asDict() for r in I.backfill(rows, "daily", newest=True).collect()] == [got[259 * 86_400_000].asDict()]


def test_a_merge_computes_its_stage_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        seen.add(1)
        return x

    rows = bars(spark, 10).withColumn("transactions", F.lit(1))
    path = str(tmp_path / "t")
    first = commits.create(rows.withColumn("close", counted("close")), path)
    assert seen.value == 10 and sum(first.rows.values()) == 10
    counts = commits.merge(path, rows.withColumn("timestamp", F.col("timestamp") + 5 * 86_400_000).withColumn("close", counted("close")), M.provisional)
    assert seen.value == 20 and counts["inserted"] == 5


def test_provisional_with_nulls(spark):
    """Rows without ticker or time meet nothing; an official bar replaces its date's provisional one."""
    kind = "ticker string, timestamp long, close double, transactions int"
    target = spark.createDataFrame([("a", 0, 1.0, None), ("a", 86_400_000, 2.0, None), ("a", 172_800_000, 3.0, 7), (None, 0, 4.0, None)], kind)
    stage = spark.createDataFrame([("a", 5, 10.0, None), ("a", 9, 11.0, 3), ("a", 86_400_001, 12.0, None), ("a", 172_800_001, 13.0, 3), (None, 0, 14.0, 3), ("b", 0, 15.0, None), ("b", 1, 16.0, None)], kind)
    got = sorted(r["close"] for r in M.provisional(target, stage).collect())
    assert got == [2.0, 3.0, 4.0, 11.0, 14.0, 15.0]


def test_features_make_bars_once(spark, tables, monkeypatch):
    made = []
    plain = T._bars
    monkeypatch.setattr(T, "_bars", lambda *a, **k: made.append(1) or plain(*a, **k))
    got = {r["ticker"]: r for r in q_factors._features(spark, tables).collect()}
    assert len(made) == 1
    want = X.returns(daily_bars(spark, tables)).collect()
    assert got and set(got) <= {r["ticker"] for r in want}
    for row in want:
        for name, value in row.asDict().items() if row["ticker"] in got else ():
            have = got[row["ticker"]][name]
            assert have == value or math.isclose(have, value, rel_tol=1e-12), (row["ticker"], name, have, value)


def test_last_values_of_many_tickers_in_small_batches(spark):
    """Tickers that span batches, with missing prices and times, short ones, and prices that stand still."""
    kind = "ticker string, timestamp long, open double, high double, low double, close double, volume double"
    rows = []
    for t, n in enumerate([1, 2, 9, 14, 15, 20, 26, 34, 35, 70, 300, 40, 40, 30, 3]):
        for k in range(n):
            close = 50.0 if t == 11 else float((k * 37 + t * 11) % 23 - (2 if t % 3 == 0 else -1))
            gone = t == 12 and k % 7 == 3 or t == 14
            rows.append((f"t{t}", None if t == 13 and k == 5 else 40 * k * 86_400_000, close, close + 1, close - 1, None if gone else close, None if t == 10 and k == 290 else float(k % 5)))
    bars = spark.createDataFrame(rows, kind).repartition(3)
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {r["ticker"]: r for r in I.standing(bars, ranks=X.RETURN_RANKS).collect()}
        returned = {r["ticker"]: r for r in X.with_returns(I.standing(bars, ranks=X.RETURN_RANKS)).collect()}
        assert {r["ticker"] for r in I.standing(bars, least=30).collect()} == {"t7", "t8", "t9", "t10", "t11", "t12", "t13"}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    same = lambda a, b: a == b or a is not None and b is not None and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    assert len(got) == 15
    for row in I.with_recurrences(bars, part=slice(-1, None)).collect():
        for name, value in row.asDict().items():
            assert same(got[row["ticker"]][name], value), (row["ticker"], name, got[row["ticker"]][name], value)
    for row in V.latest(V.daily(bars.where("ticker <> 't13'"))).collect():
        for name, value in row.asDict().items():
            assert same(got[row["ticker"]][name], value), (row["ticker"], name, got[row["ticker"]][name], value)
    want = X.returns(bars).collect()
    assert len(want) == len(returned) < 15
    for row in want:
        for name, value in row.asDict().items():
            assert same(returned[row["ticker"]][name], value), (row["ticker"], name, returned[row["ticker"]][name], value)
