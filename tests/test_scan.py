"""The parallel scan against the pass over each ticker."""

from __future__ import annotations

import math
import random

import pytest

from tapeloom.operators import indicators as I
from tapeloom.operators import scan
from tapeloom.sources import tables as T

HOUR = 3_600_000


@pytest.mark.parametrize("length", [2000, 64, 7, 1])
def test_segments_of_any_length_give_the_whole_series(spark, length):
    rng = random.Random(3)
    rows = []
    for ticker, n, gap in (("LONG", 900, 1), ("SPARSE", 300, 40), ("SHORT", 20, 1), ("ONE", 1, 1), ("UP", 60, 1)):
        at, price = rng.randrange(10**6), 100.0
        for k in range(n):
            at += rng.randint(1, gap)
            price = price + 1 if ticker == "UP" else max(1.0, price + rng.choice([-2.5, -1, 0, 0.5, 3]))
            rows.append((ticker, at * HOUR, price + rng.random(), price - rng.random(), price))
    bars = spark.createDataFrame(rows, "ticker string, timestamp long, high double, low double, close double").repartition(6)
    got = {(r["ticker"], r["timestamp"]): r for r in scan.with_recurrences(bars, HOUR, length).collect()}
    want = I.with_recurrences(bars).collect()
    assert len(got) == len(want) == len(rows)
    for r in want:
        for name in I.RECURRENT:
            a, b = got[r["ticker"], r["timestamp"]][name], r[name]
            assert (a is None) == (b is None), (r["ticker"], name)
            assert b is None or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9), (r["ticker"], name, a, b)


def test_no_bars(spark):
    assert scan.with_recurrences(spark.createDataFrame([], "ticker string, timestamp long, high double, low double, close double"), HOUR).count() == 0


def test_trades_dealt_by_segment_are_shuffled_and_sorted_once(spark, tables, monkeypatch, capsys):
    """Tasks follow the trades in number; bars are neither shuffled nor sorted again on their way to the rows."""
    monkeypatch.setattr(T, "PER_TASK", 200)
    tasks = T.table(spark, tables, "lineitem").count() // 200 + 1
    scan.with_recurrences(T.daily_bars(spark, tables, span=500 * T.DAY), T.DAY, 500).explain()
    plan = capsys.readouterr().out
    assert f", {tasks}), REPARTITION_BY_NUM" in plan and "SortMergeJoin" not in plan, plan
    by_time = [line for line in plan.splitlines() if "Sort [" in line and "timestamp#" in line]
    assert by_time and 2 * len(by_time) == plan.count("- SortAggregate("), plan  # a sort for each roll-up, in two steps, and no other
