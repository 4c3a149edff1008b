"""Queries over bars, views and indicators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import bars as B
from ..operators import indicators as I
from ..operators import scan as C
from ..operators import views as V
from ..registry import query
from ..sinks import commits as K
from ..sources.folders import fresh
from ..sources.tables import DAY, HOUR, daily_bars, hourly_bars, millis, table
from .sql import DAILY, FOUR_HOURS, HOURLY, recurrences, with_

_ROLLUP = """arg_min(open, timestamp) AS open, max(high) AS high, min(low) AS low, arg_max(close, timestamp) AS close, sum(volume) AS volume,
 CASE WHEN sum(volume) > 0 THEN sum(volume * coalesce(vwap, close)) / sum(volume) ELSE arg_max(close, timestamp) END AS vwap,
 count(*) AS bar_count, min(timestamp) AS first_ts, max(timestamp) AS last_ts"""
_SMA = ", ".join(f"avg(close) OVER (PARTITION BY ticker ORDER BY timestamp ROWS {k - 1} PRECEDING) AS sma_{k}" for k in (20, 50, 200))
_BAR = "ticker, timestamp, open, high, low, close, volume"


@query(with_(HOURLY) + f"SELECT ticker, timestamp // 86400000 * 86400000 AS timestamp, {_ROLLUP} FROM hourly GROUP BY ticker, timestamp // 86400000 * 86400000 HAVING count(*) >= 6")
def bar_daily_from_hourly(spark, sf_dir):
    return B.daily_from_hourly(hourly_bars(spark, sf_dir))


@query(with_(DAILY, "w AS (SELECT *, timestamp - (extract(dow FROM make_timestamp(timestamp * 1000)) - 1) * 86400000 + 6 * 86400000 AS week FROM daily WHERE extract(dow FROM make_timestamp(timestamp * 1000)) BETWEEN 1 AND 5)") + f"SELECT ticker, week AS timestamp, {_ROLLUP} FROM w GROUP BY ticker, week HAVING count(*) >= 3")
def bar_weekly_from_daily(spark, sf_dir):
    return B.weekly_from_daily(daily_bars(spark, sf_dir))


@query(with_(HOURLY, FOUR_HOURS) + "SELECT * FROM four")
def bar_4h_floor(spark, sf_dir):
    return B.four_hours(hourly_bars(spark, sf_dir))


VIEW_DAILY = f"""view_daily AS (SELECT {_BAR}, {_SMA}, avg(volume) OVER (PARTITION BY ticker ORDER BY timestamp ROWS 19 PRECEDING) AS avg_vol_20,
 coalesce(before > 0 AND volume > before * 3.0, false) AS volume_spike
 FROM (SELECT *, avg(volume) OVER (PARTITION BY ticker ORDER BY timestamp ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS before FROM daily))"""


@query(with_(DAILY, VIEW_DAILY) + "SELECT * FROM view_daily QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY timestamp DESC) = 1")
def view_daily_latest(spark, sf_dir):
    return V.latest(V.daily(daily_bars(spark, sf_dir)))


@query(with_(DAILY, VIEW_DAILY) + "SELECT * FROM view_daily")
def view_daily(spark, sf_dir):
    return V.daily(daily_bars(spark, sf_dir))


@query(with_(HOURLY) + f"SELECT {_BAR}, {_SMA} FROM hourly")
def view_1h(spark, sf_dir):
    return V.hourly(hourly_bars(spark, sf_dir))


@query(with_(HOURLY, "b AS (SELECT *, round_even(timestamp / 14400000, 0)::BIGINT * 14400000 AS k FROM hourly)", "f AS (SELECT ticker, k AS timestamp, arg_min(open, timestamp) AS open, max(high) AS high, min(low) AS low, arg_max(close, timestamp) AS close, sum(volume) AS volume FROM b GROUP BY ticker, k)") + f"SELECT {_BAR}, {_SMA} FROM f")
def view_4h_rounded(spark, sf_dir):
    return V.four_hours_rounded(hourly_bars(spark, sf_dir))


@query(with_(DAILY, "p AS (SELECT ticker, timestamp, lag(high) OVER w AS h, lag(low) OVER w AS l, lag(close) OVER w AS c FROM daily WINDOW w AS (PARTITION BY ticker ORDER BY timestamp))", "q AS (SELECT *, (h + l + c) / 3.0 AS pp FROM p WHERE h IS NOT NULL)") + "SELECT ticker, timestamp, pp, 2 * pp - l AS r1, 2 * pp - h AS s1, pp + (h - l) AS r2, pp - (h - l) AS s2 FROM q")
def view_pivots(spark, sf_dir):
    return V.pivots(daily_bars(spark, sf_dir))


_SIGMA = "avg(close) OVER w AS m, stddev_samp(close) OVER w AS s, count(close) OVER w AS k"
_W20 = "WINDOW w AS (PARTITION BY ticker ORDER BY timestamp ROWS 19 PRECEDING)"


@query(with_(DAILY, f"b AS (SELECT *, {_SIGMA} FROM daily {_W20})") + f"SELECT {_BAR}, m AS sma_20, round(m + 2.0 * s, 4) AS bb_upper, round(m - 2.0 * s, 4) AS bb_lower, round(4.0 * s / nullif(m, 0), 4) AS bb_width FROM b WHERE s IS NOT NULL")
def view_bollinger(spark, sf_dir):
    return V.bollinger(daily_bars(spark, sf_dir)).withColumns({c: F.round(c, 4) for c in ("bb_upper", "bb_lower", "bb_width")})


@query(with_(DAILY, f"b AS (SELECT *, {_SIGMA} FROM daily WHERE vwap > 0 {_W20})") + f"SELECT {_BAR}, vwap, abs(close - vwap) / vwap * 100.0 AS vwp_pct, round(vwap + s, 4) AS vwap_r1, round(vwap - s, 4) AS vwap_s1, round(vwap + 2 * s, 4) AS vwap_r2, round(vwap - 2 * s, 4) AS vwap_s2 FROM b WHERE s IS NOT NULL")
def view_vwap_bands(spark, sf_dir):
    return V.vwap_bands(daily_bars(spark, sf_dir)).withColumns({c: F.round(c, 4) for c in ("vwap_r1", "vwap_s1", "vwap_r2", "vwap_s2")})


@query(with_(DAILY) + "SELECT ticker, timestamp, greatest(high - low, abs(high - lag(close) OVER w), abs(low - lag(close) OVER w)) AS true_range FROM daily WINDOW w AS (PARTITION BY ticker ORDER BY timestamp)")
def ts_true_range(spark, sf_dir):
    return daily_bars(spark, sf_dir).select("ticker", "timestamp", I.true_range().alias("true_range"))


@query(with_(DAILY) + "SELECT ticker, timestamp, " + ", ".join(f"CASE WHEN count(close) OVER w{k} = {k} THEN avg(close) OVER w{k} END AS sma_{k}" for k in (20, 50, 200)) + " FROM daily WINDOW " + ", ".join(f"w{k} AS (PARTITION BY ticker ORDER BY timestamp ROWS {k - 1} PRECEDING)" for k in (20, 50, 200)))
def ts_sma_full(spark, sf_dir):
    return V.with_averages(daily_bars(spark, sf_dir), full=True).select("ticker", "timestamp", "sma_20", "sma_50", "sma_200")


_BB_FULL = "round(CASE WHEN k = 20 THEN m + 2.0 * s END, 4) AS bb_upper, round(CASE WHEN k = 20 THEN m - 2.0 * s END, 4) AS bb_lower, round(CASE WHEN k = 20 THEN ((m + 2.0 * s) - (m - 2.0 * s)) / nullif(m, 0) END, 4) AS bb_width"


@query(with_(DAILY, f"b AS (SELECT *, {_SIGMA} FROM daily {_W20})") + f"SELECT ticker, timestamp, {_BB_FULL} FROM b")
def ts_bollinger_full(spark, sf_dir):
    out = I.bollinger_full(daily_bars(spark, sf_dir))
    return out.select("ticker", "timestamp", *(F.round(c, 4).alias(c) for c in ("bb_upper", "bb_lower", "bb_width")))


SPIKES = "spikes AS (SELECT *, coalesce(CASE WHEN count(volume) OVER w = 20 THEN volume > 3.0 * avg(volume) OVER w END, false) AS volume_spike FROM daily WINDOW w AS (PARTITION BY ticker ORDER BY timestamp ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING))"
ANCHORED = """grouped AS (SELECT *, sum(volume_spike::INT) OVER (PARTITION BY ticker ORDER BY timestamp ROWS UNBOUNDED PRECEDING) AS grp FROM spikes),
anchored AS (SELECT *, CASE WHEN grp > 0 THEN sum((high + low + close) / 3.0 * volume) OVER w / nullif(sum(volume) OVER w, 0) END AS anchored_vwap,
 CASE WHEN grp > 0 THEN strftime(make_timestamp(min(timestamp) OVER w * 1000), '%Y-%m-%d') ELSE '' END AS vwap_anchor
 FROM grouped WINDOW w AS (PARTITION BY ticker, grp ORDER BY timestamp ROWS UNBOUNDED PRECEDING))"""


@query(with_(DAILY, SPIKES) + "SELECT ticker, timestamp, volume, volume_spike FROM spikes")
def ts_spike(spark, sf_dir):
    return I.spikes(daily_bars(spark, sf_dir)).select("ticker", "timestamp", "volume", "volume_spike")


@query(with_(DAILY, SPIKES, ANCHORED) + "SELECT ticker, timestamp, volume_spike, round(anchored_vwap, 4) AS anchored_vwap, vwap_anchor FROM anchored")
def ts_anchored_vwap(spark, sf_dir):
    return I.anchored_vwap(daily_bars(spark, sf_dir)).select("ticker", "timestamp", "volume_spike", F.round("anchored_vwap", 4).alias("anchored_vwap"), "vwap_anchor")


@query(with_(DAILY) + "SELECT ticker, timestamp, abs(close - vwap) / nullif(vwap, 0) * 100.0 AS vwp_pct, vwap AS poc_approx FROM daily")
def ts_vwap_dev(spark, sf_dir):
    return I.vwap_deviation(daily_bars(spark, sf_dir)).select("ticker", "timestamp", "vwp_pct", "poc_approx")


_REC = with_(DAILY, *recurrences("daily"), recursive=True)


def _recurrent(spark, sf_dir, *columns):
    out = I.with_recurrences(daily_bars(spark, sf_dir).select("ticker", "timestamp", "high", "low", "close"), ["ticker", "timestamp"])
    return out.select("ticker", "timestamp", *(F.round(c, 6).alias(c) for c in columns))


def _rounded(columns):
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


_KELTNER = [f"keltner_{x}" for x in ("middle", "upper", "lower", "upper_1_5", "lower_1_5", "upper_3_0", "lower_3_0")]
_MACD = ["macd_line", "macd_signal", "macd_histogram"]


@query(_REC + f"SELECT ticker, timestamp, {_rounded(['ema_20'])} FROM rec")
def ts_ema(spark, sf_dir):
    return _recurrent(spark, sf_dir, "ema_20")


@query(_REC + f"SELECT ticker, timestamp, {_rounded(['rsi_14'])} FROM rec")
def ts_rsi(spark, sf_dir):
    return _recurrent(spark, sf_dir, "rsi_14")


@query(_REC + f"SELECT ticker, timestamp, {_rounded(['atr_14'])} FROM rec")
def ts_atr(spark, sf_dir):
    return _recurrent(spark, sf_dir, "atr_14")


@query(_REC + f"SELECT ticker, timestamp, {_rounded(_KELTNER)} FROM rec")
def ts_keltner(spark, sf_dir):
    return _recurrent(spark, sf_dir, *_KELTNER)


@query(_REC + f"SELECT ticker, timestamp, {_rounded(_MACD)} FROM rec")
def ts_macd(spark, sf_dir):
    return _recurrent(spark, sf_dir, *_MACD)


@query(_REC + f"SELECT ticker, timestamp, {_rounded(I.RECURRENT)} FROM rec")
def ts_recurrences_scan(spark, sf_dir):
    """All recurrences by the parallel scan, in segments of 500 days."""
    return C.with_recurrences(daily_bars(spark, sf_dir, span=500 * DAY), DAY, 500).select("ticker", "timestamp", *(F.round(c, 6).alias(c) for c in I.RECURRENT))


_FULL = ["sma_20", "sma_50", "sma_200", "ema_20", "rsi_14", "atr_14", *_KELTNER, "anchored_vwap", "bb_upper", "bb_lower", "bb_width", *_MACD, "vwap", "poc_approx"]


def _indicator_rows(df, columns):
    return df.select("ticker", "timestamp", "timeframe", "open", "high", "low", "close", "volume", "volume_spike", "vwap_anchor", *(F.round(c, 4).alias(c) for c in columns))


@query(
    with_(DAILY, SPIKES, ANCHORED, *recurrences("anchored", 200), recursive=True)
    + f""", full_set AS (SELECT *, 'daily' AS timeframe, {', '.join(f'avg(close) OVER w{k} AS sma_{k}' for k in (20, 50, 200))}, vwap AS poc_approx,
 avg(close) OVER w20 + 2.0 * stddev_samp(close) OVER w20 AS bb_upper, avg(close) OVER w20 - 2.0 * stddev_samp(close) OVER w20 AS bb_lower,
 4.0 * stddev_samp(close) OVER w20 / nullif(avg(close) OVER w20, 0) AS bb_width
 FROM rec WINDOW {', '.join(f'w{k} AS (PARTITION BY ticker ORDER BY timestamp ROWS {k - 1} PRECEDING)' for k in (20, 50, 200))})
SELECT ticker, timestamp, timeframe, open, high, low, close, volume, volume_spike, vwap_anchor, {', '.join(f'round({c}, 4) AS {c}' for c in _FULL)} FROM full_set WHERE rn >= 200"""
)
def indicators_backfill(spark, sf_dir):
    return _indicator_rows(I.backfill(daily_bars(spark, sf_dir, dealt=True), "daily"), _FULL)


def _tail(source, rows):
    return f"tail AS (SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY timestamp DESC) <= {rows})"


_LAST = "WHERE rn = bars"
_LATEST = ["ema_20", "rsi_14", "atr_14", *_KELTNER]


@query(
    with_(DAILY, VIEW_DAILY, _tail("daily", 260), *recurrences("tail", 50), recursive=True)
    + f"SELECT r.ticker, r.timestamp, 'daily' AS timeframe, r.close, v.sma_20, v.sma_50, v.sma_200, v.volume_spike, {', '.join(f'round(r.{c}, 6) AS {c}' for c in _LATEST)}, NULL::DOUBLE AS macd_line FROM rec r JOIN view_daily v ON r.ticker = v.ticker AND r.timestamp = v.timestamp {_LAST}"
)
def indicators_latest_daily(spark, sf_dir):
    out = I.latest_daily(daily_bars(spark, sf_dir))
    return out.select("ticker", "timestamp", "timeframe", "close", "sma_20", "sma_50", "sma_200", "volume_spike", *(F.round(c, 6).alias(c) for c in _LATEST), "macd_line")


@query(
    with_(DAILY, VIEW_DAILY, _tail("daily", 260), *recurrences("tail", 50), recursive=True)
    + f"SELECT r.ticker, r.timestamp, 'daily' AS timeframe, r.close, v.sma_20, v.sma_50, v.sma_200, v.volume_spike, {', '.join(f'round(r.{c}, 6) AS {c}' for c in _LATEST)}, NULL::DOUBLE AS macd_line FROM rec r JOIN view_daily v ON r.ticker = v.ticker AND r.timestamp = v.timestamp {_LAST}"
)
def indicators_latest_stored(spark, sf_dir):
    """The newest daily indicators from a table of months, of which only those that hold each ticker's last 260 bars are read."""
    path = fresh(spark, "bars")
    K.create(daily_bars(spark, sf_dir), path)
    out = I.latest_daily(K.newest(spark, path, 260))
    return out.select("ticker", "timestamp", "timeframe", "close", "sma_20", "sma_50", "sma_200", "volume_spike", *(F.round(c, 6).alias(c) for c in _LATEST), "macd_line")


@query(with_(HOURLY, _tail("hourly", 1000), *recurrences("tail", 50), recursive=True) + f"SELECT ticker, timestamp, '1h' AS timeframe, close, {_rounded(_LATEST + _MACD)} FROM rec {_LAST}")
def indicators_latest_1h(spark, sf_dir):
    return I.latest_only(hourly_bars(spark, sf_dir), "1h", 1000).select("ticker", "timestamp", "timeframe", "close", *(F.round(c, 6).alias(c) for c in _LATEST + _MACD))


@query(with_(HOURLY, _tail("hourly", 2000), FOUR_HOURS.replace("FROM hourly", "FROM tail"), *recurrences("four", 50), recursive=True) + f"SELECT ticker, timestamp, '4h' AS timeframe, close, {_rounded(_LATEST + _MACD)} FROM rec {_LAST}")
def indicators_latest_4h(spark, sf_dir):
    four = B.four_hours(V.latest(hourly_bars(spark, sf_dir), 2000))
    return I.latest_only(four, "4h", 2000).select("ticker", "timestamp", "timeframe", "close", *(F.round(c, 6).alias(c) for c in _LATEST + _MACD))


@query(with_(DAILY, _tail("daily", 260), *recurrences("tail", 20), recursive=True) + f"SELECT ticker, timestamp, round(rsi_14, 6) AS calc_rsi_14, round(atr_14, 6) AS calc_atr_14, round(atr_14 / nullif(close, 0) * 100, 6) AS calc_atr_pct, round(ema_20, 6) AS calc_ema_20 FROM rec {_LAST}")
def indicators_snapshot(spark, sf_dir):
    out = I.snapshot_indicators(daily_bars(spark, sf_dir))
    return out.select("ticker", "timestamp", *(F.round(c, 6).alias(c) for c in ("calc_rsi_14", "calc_atr_14", "calc_atr_pct", "calc_ema_20")))


# Gaps: hourly bars that stand at the first of a month, one hour for each day with trades, so that a month with few trades gives
# no daily bar; and the orders of a customer as its daily bars, few of which fall into one week.
_SPREAD = "spread AS (SELECT * REPLACE (epoch_us(date_trunc('month', make_timestamp(timestamp * 1000))) // 1000 + (extract(day FROM make_timestamp(timestamp * 1000)) - 1) * 3600000 AS timestamp) FROM daily)"
_THIN = "thin AS (SELECT o_custkey::VARCHAR AS ticker, epoch_us(o_orderdate) // 1000 AS timestamp FROM orders)"


def _spread(spark, sf_dir):
    at = F.timestamp_millis("timestamp")
    return daily_bars(spark, sf_dir).withColumn("timestamp", F.unix_millis(F.date_trunc("month", at)) + (F.dayofmonth(at) - 1) * HOUR)


def _thin(spark, sf_dir):
    price = F.col("o_totalprice")
    prices = [price.alias(c) for c in ("open", "high", "low", "close", "vwap")]
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("ticker"), millis("o_orderdate").alias("timestamp"), *prices, F.lit(1.0).alias("volume"))


@query(
    with_(
        DAILY, _SPREAD, _THIN,
        "days AS (SELECT ticker, timestamp // 86400000 * 86400000 AS timestamp FROM spread GROUP BY ALL HAVING count(*) >= 6)",
        "w AS (SELECT ticker, timestamp - (extract(dow FROM make_timestamp(timestamp * 1000)) - 1) * 86400000 + 6 * 86400000 AS week FROM thin WHERE extract(dow FROM make_timestamp(timestamp * 1000)) BETWEEN 1 AND 5)",
        "weeks AS (SELECT ticker FROM w GROUP BY ticker, week HAVING count(*) >= 3)",
    )
    + """SELECT 'daily' AS grain, ticker, count(*) AS bars, max(timestamp) AS last_ts FROM daily
 WHERE ticker NOT IN (SELECT ticker FROM days WHERE timestamp > (SELECT max(timestamp) FROM days) - 30::BIGINT * 86400000) GROUP BY ticker
 UNION ALL SELECT 'weekly', ticker, count(*), max(timestamp) FROM thin WHERE ticker NOT IN (SELECT ticker FROM weeks) GROUP BY ticker"""
)
def gap_report(spark, sf_dir):
    """Tickers with daily bars of their own but no hourly-derived one of the last 30 days; tickers with finer bars but no derived week."""
    daily, thin = daily_bars(spark, sf_dir), _thin(spark, sf_dir)
    of_days = B.gap_report(daily, B.daily_from_hourly(_spread(spark, sf_dir)), days=30).select(F.lit("daily").alias("grain"), "ticker", "bars", "last_ts")
    of_weeks = B.gap_report(thin, B.weekly_from_daily(thin), days=None).select(F.lit("weekly").alias("grain"), "ticker", "bars", "last_ts")
    return of_days.unionByName(of_weeks)


@query(
    with_(DAILY, _SPREAD, "days AS (SELECT ticker, timestamp // 86400000 * 86400000 AS timestamp FROM spread GROUP BY ALL HAVING count(*) >= 6)")
    + """SELECT ticker, count(*) AS bars, max(timestamp) AS last_ts FROM daily
 WHERE ticker NOT IN (SELECT ticker FROM days WHERE timestamp > (SELECT max(timestamp) FROM days) - 30::BIGINT * 86400000) GROUP BY ticker"""
)
def gap_report_covered(spark, sf_dir):
    """The daily half of the gap report from the coverage of two tables; the derived one grew by two merges."""
    source, derived = fresh(spark, "bars"), fresh(spark, "bars")
    K.create(daily_bars(spark, sf_dir), source)
    rolled = B.daily_from_hourly(_spread(spark, sf_dir)).select(*B.BAR)
    late = F.col("timestamp") >= 788_918_400_000
    K.create(rolled.where(~late), derived)
    K.merge(derived, rolled.where(late), B.materialise)
    return K.gaps(spark, source, derived)


@query(
    with_(DAILY, _SPREAD, "days AS (SELECT ticker, timestamp // 86400000 * 86400000 AS timestamp FROM spread GROUP BY ALL HAVING count(*) >= 6)")
    + "SELECT ticker, strftime(make_timestamp(timestamp * 1000), '%Y-%m') AS period, count(*)::INTEGER AS days FROM daily d WHERE NOT EXISTS (SELECT 1 FROM days x WHERE x.ticker = d.ticker AND x.timestamp = d.timestamp) GROUP BY ALL"
)
def gap_days_covered(spark, sf_dir):
    """Days with a daily bar and no derived one, by ticker and month, from the bitmaps."""
    source, derived = fresh(spark, "bars"), fresh(spark, "bars")
    K.create(daily_bars(spark, sf_dir), source)
    K.create(B.daily_from_hourly(_spread(spark, sf_dir)), derived)
    return K.missing_days(spark, source, derived)


# A table of daily bars that lacks each fourth day; its own bars are stamped 04:00, as a vendor's are.
_HAVE = """d AS (SELECT ticker, timestamp // 86400000 * 86400000 AS timestamp, """ + _ROLLUP + """ FROM hourly GROUP BY ticker, timestamp // 86400000 * 86400000 HAVING count(*) >= 6),
have AS (SELECT ticker, timestamp + 14400000 AS timestamp, open, high, low, close, volume, vwap, bar_count::INTEGER AS transactions FROM d WHERE timestamp // 86400000 % 4 <> 0),
new AS (SELECT * FROM d WHERE NOT EXISTS (SELECT 1 FROM have h WHERE h.ticker = d.ticker AND make_timestamp(h.timestamp * 1000)::DATE = make_timestamp(d.timestamp * 1000)::DATE))"""
_TABLE = "ticker, timestamp, open, high, low, close, volume, vwap"


def _have(rolled):
    rows = rolled.where(F.expr(f"timestamp div {DAY} % 4 <> 0")).withColumn("timestamp", F.col("timestamp") + 4 * HOUR)
    return rows.withColumn("transactions", F.col("bar_count").cast("int")).select(*_TABLE.split(", "), "transactions")


@query(with_(HOURLY, _HAVE) + "SELECT ticker, timestamp, count(*) OVER () AS would_insert FROM new QUALIFY row_number() OVER (ORDER BY timestamp DESC, ticker) <= 5")
def bar_dry_run(spark, sf_dir):
    """What a daily roll-up would insert: the count and a sample of five rows."""
    rolled = B.daily_from_hourly(hourly_bars(spark, sf_dir))
    return B.dry_run(_have(rolled), rolled).select("ticker", "timestamp", "would_insert")


@query(with_(HOURLY, _HAVE) + f"SELECT {_TABLE}, transactions FROM have UNION ALL SELECT {_TABLE}, NULL FROM new")
def bar_materialise_daily(spark, sf_dir):
    rolled = B.daily_from_hourly(hourly_bars(spark, sf_dir))
    return B.materialise(_have(rolled), rolled)


@query(
    with_(
        DAILY,
        "w AS (SELECT *, timestamp - (extract(dow FROM make_timestamp(timestamp * 1000)) - 1) * 86400000 + 6 * 86400000 AS week FROM daily WHERE extract(dow FROM make_timestamp(timestamp * 1000)) BETWEEN 1 AND 5)",
        f"d AS (SELECT ticker, week AS timestamp, {_ROLLUP} FROM w GROUP BY ticker, week HAVING count(*) >= 3)",
        "have AS (SELECT ticker, timestamp + 14400000 AS timestamp, open, high, low, close, volume, vwap, bar_count::INTEGER AS transactions FROM d WHERE timestamp // 86400000 % 4 <> 0)",
    )
    + f"SELECT {_TABLE}, transactions FROM have UNION ALL SELECT {_TABLE}, NULL FROM d WHERE NOT EXISTS (SELECT 1 FROM have h WHERE h.ticker = d.ticker AND make_timestamp(h.timestamp * 1000)::DATE = make_timestamp(d.timestamp * 1000)::DATE)"
)
def bar_materialise_weekly(spark, sf_dir):
    rolled = B.weekly_from_daily(daily_bars(spark, sf_dir))
    return B.materialise(_have(rolled), rolled)


@query(
    with_(
        HOURLY, DAILY,
        "days AS (SELECT ticker, timestamp // 86400000 * 86400000 AS timestamp FROM hourly GROUP BY ALL HAVING count(*) >= 6)",
        "w AS (SELECT ticker, timestamp - (extract(dow FROM make_timestamp(timestamp * 1000)) - 1) * 86400000 + 6 * 86400000 AS week FROM daily WHERE extract(dow FROM make_timestamp(timestamp * 1000)) BETWEEN 1 AND 5)",
        "weeks AS (SELECT ticker FROM w GROUP BY ticker, week HAVING count(*) >= 3)",
    )
    + """SELECT 'daily' AS grain, ticker, count(*) AS bars, max(timestamp) AS last_ts FROM hourly
 WHERE ticker NOT IN (SELECT ticker FROM days WHERE timestamp > (SELECT max(timestamp) FROM days) - 30::BIGINT * 86400000) GROUP BY ticker
 UNION ALL SELECT 'weekly', ticker, count(*), max(timestamp) FROM daily WHERE ticker NOT IN (SELECT ticker FROM weeks) GROUP BY ticker"""
)
def gap_report_grains(spark, sf_dir):
    """Both halves of the gap report; bars of the finer grain stand for the source's, which the given tables lack."""
    hourly, daily = hourly_bars(spark, sf_dir), daily_bars(spark, sf_dir)
    of_days = B.gap_report(hourly, B.daily_from_hourly(hourly)).select(F.lit("daily").alias("grain"), "ticker", "bars", "last_ts")
    of_weeks = B.gap_report(daily, B.weekly_from_daily(daily), days=None).select(F.lit("weekly").alias("grain"), "ticker", "bars", "last_ts")
    return of_days.unionByName(of_weeks)
