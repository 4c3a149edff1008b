"""Indicators on series that are short enough to work out by hand, with gaps and missing values."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from tapeloom.operators import indicators as I
from tapeloom.operators import views as V

nan = float("nan")


def bars(spark, close, high=None, low=None, volume=None):
    number = lambda x: None if x is None else float(x)
    rows = [("T", k * 86_400_000, *map(number, (c, h, lo, c, v))) for k, (c, h, lo, v) in enumerate(zip(close, high or close, low or close, volume or [1.0] * len(close)))]
    return spark.createDataFrame(rows, "ticker string, timestamp bigint, open double, high double, low double, close double, volume double")


def column(df, name):
    return [r[name] for r in df.orderBy("timestamp").collect()]


def test_true_range(spark):
    df = bars(spark, [100.0, 102, 101, 99, 103], [102.0, 104, 103, 101, 105], [99.0, 101, 100, 97, 101])
    assert column(df.withColumn("tr", I.true_range()), "tr") == [3, 4, 3, 4, 6]


def test_full_average_needs_all_values(spark):
    df = bars(spark, [10.0, 20, 30, 40, 50])
    assert column(df.withColumn("m", V.moving("close", 3, full=True)), "m") == [None, None, 20, 30, 40]


def test_ema_starts_from_the_first_value():
    assert I.ema(pd.Series([10.0, 10, 10, 20, 20]), 3).tolist()[2:] == [10, 15, 17.5]


def test_wilder():
    x = np.arange(1.0, 16)
    got = I.wilder(x, 14)
    assert np.isnan(got[:13]).all()
    assert got[13:] == pytest.approx([7.5, 112.5 / 14])
    gap = np.array([nan, 2.0, 4.0, nan, 6.0])
    assert I.wilder(gap, 3)[2:] == pytest.approx([3.0, 3.0, 4.0])  # the mean of what is there, carried over a gap
    assert np.isnan(I.wilder(np.array([nan, nan, nan, 1.0]), 3)).all()
    assert np.isnan(I.wilder(x, 16)).all()


@pytest.mark.parametrize("close,want", [(np.arange(1.0, 31), 100.0), (np.arange(30.0, 0, -1), 0.0), (np.full(30, 5.0), 100.0)])
def test_rsi_rising_falling_flat(close, want):
    got = I.rsi(close)
    assert np.isnan(got[:14]).all() and got[14:] == pytest.approx(want)


def test_atr_and_keltner(spark):
    rows = I.with_recurrences(bars(spark, [51.0] * 40, [52.0] * 40, [50.0] * 40)).orderBy("timestamp").collect()
    assert [r["atr_14"] for r in rows[:13]] == [None] * 13
    assert rows[-1]["atr_14"] == pytest.approx(2.0)
    assert (rows[-1]["keltner_middle"], rows[-1]["keltner_upper"], rows[-1]["keltner_lower"]) == pytest.approx((51, 55, 47))
    assert rows[18]["ema_20"] is None and rows[19]["ema_20"] == pytest.approx(51)


def test_missing_prices_are_null_not_nan(spark):
    close = [float(k) for k in range(60)]
    close[30] = None
    rows = I.with_recurrences(bars(spark, close)).orderBy("timestamp").collect()
    assert rows[30]["close"] is None
    assert all(x is None or x == x for r in rows for x in r if not isinstance(x, str))


def test_pivots(spark):
    (row,) = V.pivots(bars(spark, [10.0, 11], [12.0, 12], [8.0, 9])).collect()[:1] or [None]
    names = {k.lower(): v for k, v in row.asDict().items()}
    pick = lambda *keys: next(names[k] for k in keys if k in names)
    assert (pick("pp", "pivot", "pivot_pp"), pick("r1", "pivot_r1"), pick("s1", "pivot_s1")) == pytest.approx((10, 12, 8))
