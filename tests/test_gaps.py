"""The gap report on hand-made bars."""

from __future__ import annotations

from tapeloom.operators import bars as B
from tapeloom.sources.tables import DAY


def test_gap_report_lists_every_source_ticker_without_recent_derived_bars(spark):
    frame = lambda rows: spark.createDataFrame(rows, "ticker string, timestamp long")
    source = frame([("gone", 1 * DAY), ("gone", 2 * DAY), ("old", 60 * DAY), ("edge", 100 * DAY), ("fresh", 100 * DAY)])
    derived = frame([("old", 60 * DAY), ("edge", 70 * DAY), ("fresh", 71 * DAY), ("other", 100 * DAY)])
    found = lambda **how: {r["ticker"]: (r["bars"], r["last_ts"]) for r in B.gap_report(source, derived, **how).collect()}
    assert found() == {"gone": (2, 2 * DAY), "old": (1, 60 * DAY), "edge": (1, 100 * DAY)}
    assert found(days=None) == {"gone": (2, 2 * DAY)}
    assert B.gap_report(source, derived.where("false")).count() == 4


def test_a_target_bar_at_four_stops_the_roll_up_of_its_date(spark):
    four = 4 * 3_600_000
    columns = "ticker string, timestamp long, open double, high double, low double, close double, volume double, vwap double"
    target = spark.createDataFrame([("A", 10 * DAY + four, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 7), ("A", 12 * DAY - 1, 2.0, 2.0, 2.0, 2.0, 2.0, 2.0, None)], columns + ", transactions int")
    rolled = [(t, d * DAY, *[9.0] * 6, 6, 0, 1) for t, d in (("A", 10), ("A", 11), ("A", 12), ("B", 10))]
    rolled = spark.createDataFrame(rolled, columns + ", bar_count long, first_ts long, last_ts long")
    got = {(r["ticker"], r["timestamp"], r["close"], r["transactions"]) for r in B.materialise(target, rolled).collect()}
    assert got == {("A", 10 * DAY + four, 1.0, 7), ("A", 12 * DAY - 1, 2.0, None), ("A", 12 * DAY, 9.0, None), ("B", 10 * DAY, 9.0, None)}
    again = B.materialise(B.materialise(target, rolled), rolled)
    assert again.count() == 4
    assert [tuple(r) for r in B.dry_run(target, rolled, 1).select("ticker", "timestamp", "would_insert").collect()] == [("A", 12 * DAY, 2)]
