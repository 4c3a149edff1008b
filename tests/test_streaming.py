"""Streams: late bars, duplicates, state carried over restarts, batches that are run again."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from tapeloom.operators import indicators as I
from tapeloom.operators import views as V
from tapeloom.sinks import tables as S
from tapeloom.streaming import bars as T

HOUR = 3_600_000


def message(sym, s, price, ev="AM", v=1.0):
    return {"ev": ev, "sym": sym, "v": v, "av": s, "o": price, "h": price, "l": price, "c": price, "vw": price, "s": s, "e": s + 60_000}


def put(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines))


def test_parse_skips_what_is_not_wanted_and_not_json(spark, tmp_path):
    put(tmp_path / "in", "a", [message("A", 1, 2.0), message("B", 1, 2.0), message("A", 2, 3.0, ev="T"), {"ev": "status"}], "broken", [])
    T.drain(T.parse(spark.readStream.text(str(tmp_path / "in")), ["AM"], ["A"]).select("sym", "s", "c"), str(tmp_path / "out"))
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [("A", 1, 2.0)]


def test_late_bars_do_not_change_a_closed_hour(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")

    def run():
        T.drain(T.rollup(T.parse(spark.readStream.text(str(source)), ["AM"])), out)
        return {(r["ticker"], r["timestamp"]): (r["open"], r["close"], r["volume"]) for r in spark.read.parquet(out).collect()}

    put(source, "a", [message("A", 5, 1.0), message("A", 10, 2.0), message("A", 3 * HOUR, 9.0)])
    first = run()
    assert first == {("A", 0): (1.0, 2.0, 2.0)}
    put(source, "b", [message("A", 1, 7.0), message("A", 2 * HOUR + 3_000_000, 8.0), message("A", 9 * HOUR, 9.0)])  # too late, late but in time, new
    again = run()
    assert again[("A", 0)] == first[("A", 0)]
    assert again[("A", 2 * HOUR)] == (8.0, 8.0, 1.0) and again[("A", 3 * HOUR)] == (9.0, 9.0, 1.0)
    assert ("A", 9 * HOUR) not in again


def test_duplicates_over_restarts(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    for name in ("a", "b"):
        put(source, name, [message("A", 1, 1.0), message("A", 1, 1.0), message("B", 1, 1.0)])
        T.drain(T.distinct(T.parse(spark.readStream.text(str(source)), ["AM"]), "1 hour").select("sym", "s"), out)
    assert sorted(tuple(r) for r in spark.read.parquet(out).collect()) == [("A", 1), ("B", 1)]


def test_late_bars_do_not_change_a_closed_day(spark, tmp_path):
    source, out, day = tmp_path / "in", str(tmp_path / "out"), 24 * HOUR
    run = lambda: T.drain(T.daily(T.parse(spark.readStream.text(str(source)), ["AM"])), out)
    days = lambda: {(r["ticker"], r["timestamp"]): (r["open"], r["high"], r["close"], r["volume"], r["bar_count"]) for r in spark.read.parquet(out).collect()}
    full = [message("A", k * HOUR + 60_000 * m, float(k + m)) for k in range(8) for m in (1, 2)]
    put(source, "a", [*full, message("B", HOUR, 5.0), message("A", day + HOUR, 50.0)])
    run()
    first = days()
    assert first == {("A", 0): (1.0, 9.0, 9.0, 16.0, 8)}  # one hour of B is too few
    put(source, "b", [message("A", 7 * HOUR, 99.0), *(message("A", day + k * HOUR, 60.0 + k) for k in range(2, 9)), message("A", day, 7.0), message("A", 2 * day + HOUR, 1.0)])  # the first is of a closed day, the last but one of an hour still open
    run()
    assert days() == first | {("A", day): (7.0, 68.0, 68.0, 9.0, 9)}


def _series(spark, ticker, close):
    rows = [(ticker, (k + 1) * HOUR, c, c + 1, c - 1.5, c, 1.0) for k, c in enumerate(close)]
    return spark.createDataFrame(rows, "ticker string, timestamp bigint, open double, high double, low double, close double, volume double")


def _carry(spark, folder, schema, progress, out, **how):
    with T.state_on_disk(spark):
        T.drain_batches(T.carried(spark.readStream.schema(schema).parquet(folder), **how), progress, T.versions(out), "update")
    return spark.read.parquet(out).orderBy(F.desc("batch"), "ticker")


def test_a_ticker_without_bars_leaves_the_state(spark, tmp_path):
    close = [50 + (k * 37 % 23) - k * 0.1 for k in range(30)]
    gone, going = _series(spark, "GONE", close), _series(spark, "GOING", close)
    source, out, progress = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "progress")
    step = lambda rows: (rows.write.mode("append").parquet(source), _carry(spark, source, gone.schema, progress, out, keep_days=2, late="1 hour"))[1]
    held = lambda: {r["key"]["ticker"] for r in spark.read.format("statestore").option("stateVarName", "carried").load(progress).select("key").collect()}
    step(gone.unionByName(going))
    assert held() == {"GONE", "GOING"}
    later = going.withColumn("timestamp", F.col("timestamp") + 40 * HOUR)
    step(later)
    step(later.withColumn("timestamp", F.col("timestamp") + 60 * HOUR))
    assert held() == {"GOING"}
    last = step(gone.limit(1).withColumn("timestamp", F.lit(131 * HOUR)))  # it returns, and begins anew
    row = last.where("ticker = 'GONE'").first()
    assert row["carried"]["n"] == 1 and row["ema_20"] is None and held() == {"GONE", "GOING"}


def test_a_new_stream_begins_where_the_stored_rows_end(spark, tmp_path):
    close = [50 + (k * 37 % 23) - k * 0.1 for k in range(70)]
    whole = _series(spark, "T", close).unionByName(_series(spark, "NEW", close[:40]).where(f"timestamp >= {31 * HOUR}"))
    source = lambda n: str(tmp_path / f"in{n}")
    whole.where(f"timestamp < {31 * HOUR}").write.parquet(source(1))
    whole.where(f"timestamp >= {31 * HOUR}").write.parquet(source(2))
    stored = _carry(spark, source(1), whole.schema, str(tmp_path / "p1"), str(tmp_path / "o1"))
    got = {r["ticker"]: r for r in _carry(spark, source(2), whole.schema, str(tmp_path / "p2"), str(tmp_path / "o2"), stored=stored).collect()}
    want = {r["ticker"]: r for r in V.latest(I.with_recurrences(whole)).collect()}
    assert got["NEW"]["carried"]["n"] == 10 and got["NEW"]["rsi_14"] is None
    for name in ("ema_20", "rsi_14", "atr_14"):
        assert abs(got["T"][name] - want["T"][name]) < 1e-9


def test_each_batch_reads_the_newest_profile(spark, tmp_path):
    minutes = lambda *rows: spark.createDataFrame([("A", m * 60_000, float(v)) for m, v in rows], "ticker string, minute_ts bigint, volume double")
    source, out, profile = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "profile")
    run = lambda: T.volume_signals(spark.readStream.schema("ticker string, minute_ts bigint, volume double").parquet(source), profile, out)
    averages = lambda *rows: S.publish(spark.createDataFrame([("A", m, float(a)) for m, a in rows], "ticker string, et_minute int, avg double"), profile)
    averages((600 - 240, 10), (660 - 240, 10))
    minutes((600, 30)).write.parquet(source)
    run()
    averages((660 - 240, 400))
    (tmp_path / "profile/v=2").mkdir()  # a version that is still being written
    minutes((660, 50)).write.mode("append").parquet(source)
    run()
    got = [(r["cum_vol"], r["avg_cum_vol"], r["ratio"], r["signal"]) for r in spark.read.parquet(out).orderBy("batch").collect()]
    assert got == [(30.0, 10.0, 3.0, "above"), (80.0, 400.0, 0.2, "below")]


def test_carried_state_equals_the_whole_series(spark, tmp_path):
    close = [50 + (k * 37 % 23) - k * 0.1 for k in range(70)]
    whole = _series(spark, "T", close)
    (want,) = V.latest(I.with_recurrences(whole)).collect()
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for a, b in ((0, 9), (9, 30), (25, 70)):  # the last part brings some bars again
        whole.where(F.col("timestamp").between((a + 1) * HOUR, b * HOUR)).write.mode("append").parquet(source)
        _carry(spark, source, whole.schema, f"{out}-progress", out)
    got = spark.read.parquet(out).orderBy(F.desc("batch")).first()
    assert got["timestamp"] == 70 * HOUR
    for name in ("ema_20", "rsi_14", "atr_14"):
        assert abs(got[name] - want[name]) < 1e-9
