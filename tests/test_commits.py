"""Tables of files whose merges commit as a whole: killed, raced and repeated merges, periods left alone, streams that run a batch again."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tapeloom.operators import merge as M
from tapeloom.sinks import commits as K
from tapeloom.sources.tables import DAY
from tapeloom.streaming import bars as T

SCHEMA = "ticker string, timestamp long, close double, transactions int"
MONTH = 31 * DAY


def bars(spark, *rows):
    return spark.createDataFrame([(t, None if at is None else int(at), float(c), n) for t, at, c, n in rows], SCHEMA)


def rows_of(spark, path, **how):
    return {tuple(r) for r in K.read(spark, path, **how).collect()}


def by_date(target, stage):
    return M.absent_date(target, stage, F.col("timestamp"))


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "bars")
    K.create(bars(spark, ("A", 0, 1, 5), ("B", DAY, 2, None), ("A", MONTH, 3, 5), ("A", 3 * MONTH, 4, 5)), path)
    return path


def test_a_merge_rewrites_touched_periods_only(spark, table):
    before = K.manifest(spark, table)
    counts = K.merge(table, bars(spark, ("B", DAY + 5, 9, 7), ("C", 2 * DAY, 8, 7)), M.provisional)
    after = K.manifest(spark, table)
    assert counts == {"version": 1, "staged": 2, "before": 4, "after": 5, "inserted": 1}
    assert rows_of(spark, table) == {("A", 0, 1.0, 5), ("B", DAY + 5, 9.0, 7), ("C", 2 * DAY, 8.0, 7), ("A", MONTH, 3.0, 5), ("A", 3 * MONTH, 4.0, 5)}
    assert {p for p in after.parts if after.parts[p] != before.parts.get(p)} == {"1970-01"} and after.rows["1970-01"] == 3
    assert rows_of(spark, table, at=before) == {("A", 0, 1.0, 5), ("B", DAY, 2.0, None), ("A", MONTH, 3.0, 5), ("A", 3 * MONTH, 4.0, 5)}  # an old version stays readable
    assert rows_of(spark, table, periods=["1970-02"]) == {("A", MONTH, 3.0, 5)}
    files = K.read(spark, table, periods=["1970-01"]).inputFiles()
    assert files and all("1970-01" in f for f in files)


def test_a_merge_killed_before_its_commit_leaves_the_old_table(spark, table, monkeypatch):
    old = rows_of(spark, table)

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(K, "_commit", killed)
        with pytest.raises(KeyboardInterrupt):
            K.merge(table, bars(spark, ("Z", 0, 1, 1)), by_date)
    assert rows_of(spark, table) == old and K.latest(spark, table) == 0 and len(K.unused(spark, table)) == 2
    K.merge(table, bars(spark, ("Z", 0, 1, 1)), by_date)
    assert rows_of(spark, table) == old | {("Z", 0, 1.0, 1)}


def test_a_merge_that_fails_while_writing_leaves_the_old_table(spark, table):
    old = rows_of(spark, table)
    with pytest.raises(Exception, match="unlucky"):
        K.merge(table, bars(spark, ("Z", 0, 1, 1)), lambda target, stage: target.withColumn("close", F.raise_error(F.lit("unlucky")).cast("double")))
    assert rows_of(spark, table) == old


def test_a_raced_merge_of_the_same_period_is_done_anew(spark, table):
    turns = []

    def slow(target, stage):
        turns.append(1)
        if len(turns) == 1:  # another writer commits meanwhile
            K.merge(table, bars(spark, ("Z", 0, 7, 1)), by_date)
        return by_date(target, stage)

    counts = K.merge(table, bars(spark, ("Z", 5, 9, 1), ("Y", 5, 9, 1)), slow)
    got = rows_of(spark, table)
    assert len(turns) == 2 and counts["version"] == 2 and (counts["before"], counts["after"]) == (5, 6)
    assert ("Z", 0, 7.0, 1) in got and ("Y", 5, 9.0, 1) in got and ("Z", 5, 9.0, 1) not in got


def test_a_raced_merge_of_other_periods_moves_onto_the_winner(spark, table):
    turns = []

    def slow(target, stage):
        turns.append(1)
        K.merge(table, bars(spark, ("Z", MONTH, 7, 1)), by_date)
        return by_date(target, stage)

    counts = K.merge(table, bars(spark, ("Y", 5, 9, 1)), slow)
    assert len(turns) == 1 and counts["version"] == 2 and {("Z", MONTH, 7.0, 1), ("Y", 5, 9.0, 1)} < rows_of(spark, table)


def test_a_merge_that_is_always_overtaken_gives_up(spark, table):
    def beaten(target, stage):
        K.merge(table, bars(spark, ("W", 0, K.latest(spark, table), 1)), lambda t, s: t.unionByName(s))
        return by_date(target, stage)

    with pytest.raises(K.Overtaken):
        K.merge(table, bars(spark, ("Y", 5, 9, 1)), beaten, attempts=2)
    assert not any(r[0] == "Y" for r in rows_of(spark, table))


def test_edges(spark, table, tmp_path):
    assert K.merge(table, bars(spark), by_date)["version"] == 0
    with pytest.raises(FileExistsError):
        K.create(bars(spark, ("A", 0, 1, 1)), table)
    with pytest.raises(ValueError, match="does not touch"):
        K.merge(table, bars(spark, ("A", 0, 1, 1)), lambda t, s: t.unionByName(bars(spark, ("A", 9 * MONTH, 1, 1))))
    K.merge(table, bars(spark, ("N", None, 1, 1)), lambda t, s: t.unionByName(s))
    assert ("N", None, 1.0, 1) in rows_of(spark, table) and "none" in K.manifest(spark, table).parts
    K.merge(table, bars(spark, ("N", None, 1, 1)), lambda t, s: t.where("false"))  # a period that empties goes
    assert "none" not in K.manifest(spark, table).parts
    empty = str(tmp_path / "empty")
    K.create(bars(spark), empty)
    assert rows_of(spark, empty) == set()
    with pytest.raises(LookupError):
        K.manifest(spark, str(tmp_path / "nowhere"))


def test_a_stream_that_runs_a_batch_again_merges_it_once(spark, table, tmp_path):
    arrived = str(tmp_path / "stage")
    source = lambda: spark.readStream.schema(SCHEMA).parquet(arrived)
    bars(spark, ("B", DAY, 9, 7), ("C", 2 * DAY, 8, None)).write.parquet(arrived)
    T.provisional(source(), table)
    once, version = rows_of(spark, table), K.latest(spark, table)
    assert {("B", DAY, 9.0, 7), ("C", 2 * DAY, 8.0, None)} < once
    for name in os.listdir(f"{table}-stage-progress/commits"):  # as if it had died after the merge, before the stream noted it
        os.remove(f"{table}-stage-progress/commits/{name}")
    T.provisional(source(), table)
    assert rows_of(spark, table) == once and K.latest(spark, table) == version
    bars(spark, ("C", 2 * DAY, 6, 3)).write.mode("append").parquet(arrived)  # the official bar comes late
    T.provisional(source(), table)
    assert ("C", 2 * DAY, 6.0, 3) in rows_of(spark, table) and K.latest(spark, table) == version + 1


def test_coverage_follows_every_commit(spark, table):
    cover = lambda: {(r["ticker"], r["period"]): (r["bars"], r["days"], r["last_ts"]) for r in K.coverage(spark, table).collect()}
    assert cover() == {("A", "1970-01"): (1, 1, 0), ("B", "1970-01"): (1, 2, DAY), ("A", "1970-02"): (1, 1, MONTH), ("A", "1970-04"): (1, 8, 3 * MONTH)}
    K.merge(table, bars(spark, ("A", 30 * DAY, 9, 7), ("C", MONTH + 5, 8, 7)), by_date)
    assert cover() == {("A", "1970-01"): (2, 1 | 1 << 30, 30 * DAY), ("B", "1970-01"): (1, 2, DAY), ("A", "1970-02"): (1, 1, MONTH), ("C", "1970-02"): (1, 1, MONTH + 5), ("A", "1970-04"): (1, 8, 3 * MONTH)}


def test_newest_bars_read_few_months(spark, tmp_path):
    path = str(tmp_path / "bars")
    K.create(bars(spark, *(("A", k * 10 * DAY, k, 1) for k in range(100)), *(("B", k * 10 * DAY, k, 1) for k in range(60, 100)), ("OLD", 5, 1, 1), ("NEW", 990 * DAY, 1, 1)), path)
    for count in (1, 4, 30, 1000):
        got = K.newest(spark, path, count)
        want = {(t, at) for t, at in ((r["ticker"], r["timestamp"]) for r in K.read(spark, path).collect())}
        tail = {(t, at) for t, at in want if sum(1 for u, x in want if u == t and x > at) < count}
        assert tail <= {(r["ticker"], r["timestamp"]) for r in got.collect()}
        from tapeloom.operators import views as V

        assert {(r["ticker"], r["timestamp"]) for r in V.latest(got, count).collect()} == tail
    few = sum("-cover" not in f for f in K.newest(spark, path, 4).inputFiles())
    all_files = len(K.read(spark, path).inputFiles())
    assert few <= 5 < all_files


def test_gaps_from_coverage_equal_the_report(spark, tmp_path):
    from tapeloom.operators import bars as B

    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    source = bars(spark, ("gone", 1 * DAY, 1, 1), ("gone", 2 * DAY, 1, 1), ("old", 60 * DAY, 1, 1), ("edge", 100 * DAY, 1, 1), ("fresh", 100 * DAY, 1, 1))
    derived = bars(spark, ("old", 60 * DAY, 1, 1), ("edge", 70 * DAY, 1, 1), ("fresh", 71 * DAY, 1, 1), ("other", 100 * DAY, 1, 1))
    K.create(source, one)
    K.create(derived.where("false"), two)
    rows = lambda frame: sorted(tuple(r) for r in frame.select("ticker", "bars", "last_ts").collect())
    assert rows(K.gaps(spark, one, two)) == rows(B.gap_report(source, derived.where("false")))
    K.merge(two, derived, by_date)
    for days in (30, None):
        assert rows(K.gaps(spark, one, two, days)) == rows(B.gap_report(source, derived, days))
    assert sorted(tuple(r) for r in K.missing_days(spark, one, two).collect()) == [("edge", "1970-04", 1), ("fresh", "1970-04", 1), ("gone", "1970-01", 2)]
