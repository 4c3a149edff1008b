"""Queries over ticker lists, stale tickers, fan-out and the strict gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import vendor_symbol
from ..operators import audit as A
from ..operators import bars as B
from ..operators import indicators as I
from ..operators import views as V
from ..registry import query
from ..sources.tables import DAY, HOUR, companies, daily_bars, hourly_bars, table
from .q_bars import _BAR, _SMA, VIEW_DAILY
from .sql import COMPANIES, DAILY, FOUR_HOURS, HOURLY, recurrences, with_


@query(with_(DAILY, COMPANIES) + "SELECT d.ticker, d.timestamp, d.close FROM daily d WHERE EXISTS (SELECT 1 FROM companies c WHERE c.ticker = d.ticker AND no % 3 = 1)")
def bars_of_tickers(spark, sf_dir):
    """Daily bars of a list in which tickers come twice."""
    listed = companies(spark, sf_dir).where("no % 3 = 1").select("ticker")
    return I.of_tickers(daily_bars(spark, sf_dir), listed.unionByName(listed)).select("ticker", "timestamp", "close")


@query(with_(COMPANIES) + "SELECT ticker, replace(replace(industry || '/' || exchange || '.' || no, '/', '-'), '.', '-') AS vendor FROM companies")
def vendor_symbols(spark, sf_dir):
    return companies(spark, sf_dir).select("ticker", vendor_symbol(F.concat("industry", F.lit("/"), "exchange", F.lit("."), F.col("no").cast("string"))).alias("vendor"))


# What is stored: nothing for every fourth company, and for every third no row of the last 30 days.
STORED = f"""stored AS (SELECT d.ticker, d.timestamp FROM daily d JOIN companies c ON d.ticker = c.ticker WHERE no % 4 <> 0 AND NOT (no % 3 = 0 AND d.timestamp > (SELECT max(timestamp) FROM daily) - {90 * DAY})),
due AS (SELECT ticker FROM (SELECT ticker, max(timestamp) AS last FROM daily GROUP BY ticker) b LEFT JOIN (SELECT ticker, max(timestamp) AS have FROM stored GROUP BY ticker) s USING (ticker) WHERE have IS NULL OR have < last)"""


def _stored(spark, sf_dir):
    bars = daily_bars(spark, sf_dir)
    newest = bars.agg(F.max("timestamp").alias("newest"))
    rows = bars.select("ticker", "timestamp").join(companies(spark, sf_dir).select("ticker", "no"), "ticker").join(F.broadcast(newest), F.lit(True))  # one row
    return bars, rows.where(f"no % 4 <> 0 AND NOT (no % 3 = 0 AND timestamp > newest - {90 * DAY})").select("ticker", "timestamp")


@query(with_(DAILY, COMPANIES, STORED) + "SELECT ticker FROM due")
def indicators_stale(spark, sf_dir):
    return I.stale(*_stored(spark, sf_dir))


_SHOWN = "round(ema_20, 6) AS ema_20, round(rsi_14, 6) AS rsi_14, round(atr_14, 6) AS atr_14"


@query(
    with_(DAILY, COMPANIES, STORED, VIEW_DAILY, "tail AS (SELECT * FROM daily WHERE ticker IN (SELECT ticker FROM due) QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY timestamp DESC) <= 260)", *recurrences("tail", 50), recursive=True)
    + f"SELECT r.ticker, r.timestamp, v.sma_20, v.sma_200, v.volume_spike, {_SHOWN}, NULL::DOUBLE AS bb_upper FROM rec r JOIN view_daily v ON r.ticker = v.ticker AND r.timestamp = v.timestamp WHERE rn = bars"
)
def indicators_refresh_daily(spark, sf_dir):
    """Stale tickers only."""
    bars, stored = _stored(spark, sf_dir)
    out = I.refresh(bars, stored, "daily", 260)
    return out.select("ticker", "timestamp", "sma_20", "sma_200", "volume_spike", *(F.round(c, 6).alias(c) for c in ("ema_20", "rsi_14", "atr_14")), "bb_upper")


@query(
    with_(HOURLY, "tail AS (SELECT * FROM hourly WHERE ticker <> 'click' QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY timestamp DESC) <= 1000)", *recurrences("tail", 50), recursive=True)
    + f"SELECT ticker, timestamp, '1h' AS timeframe, NULL::DOUBLE AS sma_20, false AS volume_spike, {_SHOWN} FROM rec WHERE rn = bars"
)
def indicators_refresh_1h(spark, sf_dir):
    """All but one ticker are stale; intraday rows have no averages and no spike."""
    bars = hourly_bars(spark, sf_dir)
    stored = bars.where(f"ticker = 'click' OR timestamp div {HOUR} % 2 = 0").where(f"ticker = 'click' OR timestamp < 1704067200000 + {10 * DAY}").select("ticker", "timestamp")
    out = I.refresh(bars, stored, "1h", 1000)
    return out.select("ticker", "timestamp", "timeframe", "sma_20", "volume_spike", *(F.round(c, 6).alias(c) for c in ("ema_20", "rsi_14", "atr_14")))


# Hourly bars under the tickers of companies, in the order of the types; those of the last type have no daily bars.
RENAMED = "renamed AS (SELECT * REPLACE (CASE ticker WHEN 'click' THEN '1' WHEN 'error' THEN '2' WHEN 'purchase' THEN '3' WHEN 'view' THEN '4' ELSE 'none' END AS ticker) FROM hourly)"


@query(
    with_(DAILY, HOURLY, RENAMED, FOUR_HOURS.replace("FROM hourly", "FROM renamed"))
    + """, pair AS (SELECT DISTINCT ticker FROM daily WHERE ticker IN (SELECT ticker FROM renamed)), u AS (SELECT 'daily' AS timeframe, ticker, timestamp, close FROM daily UNION ALL SELECT '1h', ticker, timestamp, close FROM renamed UNION ALL SELECT '4h', ticker, timestamp, close FROM four)
SELECT timeframe, ticker, timestamp, close FROM (SELECT *, row_number() OVER (PARTITION BY timeframe, ticker ORDER BY timestamp) AS rn FROM u WHERE ticker IN (SELECT ticker FROM pair)) WHERE rn >= 200"""
)
def indicators_fan_out(spark, sf_dir):
    """Three timeframes of the tickers that have daily and hourly bars."""
    named = F.create_map(*[F.lit(x) for pair in (("click", "1"), ("error", "2"), ("purchase", "3"), ("view", "4")) for x in pair])
    hourly = hourly_bars(spark, sf_dir).withColumn("ticker", F.coalesce(F.try_element_at(named, "ticker"), F.lit("none")))
    return I.fan_out(daily_bars(spark, sf_dir), hourly).select("timeframe", "ticker", "timestamp", "close")


# strict gates

_TODAY = "2024-01-20"
RUNS = """runs AS (SELECT o_orderdate::DATE AS as_of_date, count(*) AS row_count, count(*) FILTER (o_totalprice > 1000) AS with_price, count(*) FILTER (o_orderstatus = 'F') AS with_calc, max(o_orderdate)::DATE AS max_price_date, max(o_orderdate)::DATE - 3 AS max_calc_indicator_date FROM orders GROUP BY 1),
last AS (SELECT * FROM runs ORDER BY as_of_date DESC LIMIT 1), least AS (SELECT floor(count(DISTINCT ticker) * 0.95) AS n FROM companies)"""


@query(
    with_(COMPANIES, DAILY, HOURLY, RUNS)
    + f""", u AS (SELECT ticker FROM companies), t AS (SELECT 'daily' AS table_name, ticker, timestamp FROM daily UNION ALL SELECT 'indicators', ticker, timestamp FROM daily WHERE timestamp < (SELECT max(timestamp) FROM daily) - {2 * DAY} UNION ALL SELECT 'hourly', ticker, timestamp FROM hourly),
c AS (SELECT n.table_name, count(DISTINCT CASE WHEN u.ticker IS NOT NULL THEN t.ticker END) * 100.0 / (SELECT count(*) FROM u) AS pct FROM (VALUES ('daily'), ('indicators'), ('hourly')) n(table_name) LEFT JOIN t USING (table_name) LEFT JOIN u ON t.ticker = u.ticker GROUP BY 1),
l AS (SELECT table_name, max(make_timestamp(timestamp * 1000)::DATE) AS d FROM t GROUP BY 1)
SELECT 'missing table' AS issue, 'history' AS table_name, 0.0::DOUBLE AS value, 1.0::DOUBLE AS threshold UNION ALL SELECT 'coverage', table_name, pct, 95 FROM c WHERE pct < 95
UNION ALL SELECT 'stale', table_name, date_diff('day', d, DATE '{_TODAY}'), 7 FROM l WHERE date_diff('day', d, DATE '{_TODAY}') > 7
UNION ALL SELECT 'behind its source', 'indicators', date_diff('day', a.d, b.d), 0 FROM l a, l b WHERE a.table_name = 'indicators' AND b.table_name = 'daily' AND a.d < b.d
UNION ALL SELECT 'future provisional rows', 'hourly', n, 0 FROM (SELECT count(*) AS n FROM hourly WHERE make_timestamp(timestamp * 1000)::DATE > DATE '{_TODAY}' AND timestamp // {HOUR} % 3 = 0) WHERE n > 0
UNION ALL SELECT 'run below the universe', k, v, n FROM (SELECT 'row_count' AS k, row_count AS v FROM last UNION ALL SELECT 'with_price', with_price FROM last UNION ALL SELECT 'with_calc', with_calc FROM last), least WHERE v < n
UNION ALL SELECT 'run behind its prices', 'max_calc_indicator_date', 3, 0 FROM last"""
)
def audit_strict(spark, sf_dir):
    """A table that is missing, one that covers little, old ones, indicators behind their bars, bars of the future, and a short last run."""
    universe = companies(spark, sf_dir).select("ticker")
    daily, hourly = daily_bars(spark, sf_dir), hourly_bars(spark, sf_dir)
    newest = daily.agg(F.max("timestamp").alias("newest"))
    behind = daily.join(F.broadcast(newest), F.lit(True)).where(f"timestamp < newest - {2 * DAY}").drop("newest")  # one row
    tables = {"daily": daily, "indicators": behind, "hourly": hourly}
    latest = A.latest_dates(tables)
    marked = hourly.withColumn("transactions", F.when(F.expr(f"timestamp div {HOUR} % 3 <> 0"), F.col("transactions")))
    day = F.col("o_orderdate").cast("date")
    runs = table(spark, sf_dir, "orders").groupBy(day.alias("as_of_date")).agg(
        F.count("*").alias("row_count"), F.count_if(F.col("o_totalprice") > 1000).alias("with_price"), F.count_if(F.col("o_orderstatus") == "F").alias("with_calc"), F.max(day).alias("max_price_date"), F.date_sub(F.max(day), 3).alias("max_calc_indicator_date")
    )
    found = A.issues(A.coverage(universe, tables), dict.fromkeys(tables, 95.0), latest, _TODAY, dict.fromkeys(tables, 7), A.duplicates({"daily": (daily, ["ticker", "timestamp"])}))
    return A.strict(
        A.missing_tables(spark, [*tables, "history"], list(tables)), found, A.behind(latest, "indicators", "daily"), A.future_provisional(A.provisional(marked, _TODAY), "hourly"),
        A.short_runs(runs, universe, ["row_count", "with_price", "with_calc"]),
    )


_AS_OF = 1706115600000  # a Wednesday, 12:00 in New York
_AGE = f"({_AS_OF} - max(timestamp)) / 3600000.0"


@query(
    with_(HOURLY, DAILY, FOUR_HOURS)
    + f""", g AS (SELECT ticker, timestamp, close, row_number() OVER (PARTITION BY ticker ORDER BY timestamp) AS rn FROM four), p AS (SELECT 'hourly' AS probe, {_AGE} AS age_hours FROM hourly WHERE timestamp <= {_AS_OF} UNION ALL SELECT 'daily', {_AGE} FROM daily UNION ALL SELECT 'indicators', {_AGE} FROM daily WHERE timestamp < 800000000000 UNION ALL SELECT '4h indicators', {_AGE} FROM g WHERE rn >= 500)
SELECT probe, age_hours, 30 AS threshold, coalesce(age_hours <= 30, false) AS fresh FROM p"""
)
def audit_freshness_gate(spark, sf_dir):
    """Four probes on a weekday; one finds no data."""
    hourly, daily = hourly_bars(spark, sf_dir), daily_bars(spark, sf_dir)
    four = I.gate(B.four_hours(hourly), 100_000)
    four = four.where("close IS NOT NULL")
    probes = {"hourly": hourly.where(f"timestamp <= {_AS_OF}"), "daily": daily, "indicators": daily.where("timestamp < 800000000000"), "4h indicators": four}
    return A.freshness(probes, "2024-01-24 17:00:00")


@query(
    with_(DAILY, HOURLY, VIEW_DAILY, f"view_hourly AS (SELECT {_BAR}, {_SMA} FROM hourly)")
    + """SELECT 'v_daily' AS view_name, ticker, close, sma_20, sma_50, sma_200, true AS has_row FROM (SELECT * FROM view_daily WHERE ticker = '7' ORDER BY timestamp DESC LIMIT 1) UNION ALL SELECT 'v_1h', ticker, close, sma_20, sma_50, sma_200, true FROM (SELECT * FROM view_hourly WHERE ticker = 'view' ORDER BY timestamp DESC LIMIT 1)
UNION ALL SELECT v, NULL, NULL, NULL, NULL, NULL, (SELECT count(*) > 0 FROM daily) FROM (VALUES ('v_pivots'), ('v_bollinger'), ('v_vwap_bands')) x(v) UNION ALL SELECT 'v_empty', NULL, NULL, NULL, NULL, NULL, false"""
)
def audit_view_probes(spark, sf_dir):
    daily, hourly = daily_bars(spark, sf_dir), hourly_bars(spark, sf_dir)
    views = {"v_daily": (V.daily(daily), "7"), "v_1h": (V.hourly(hourly), "view")}
    return A.view_probes(views, {"v_pivots": V.pivots(daily), "v_bollinger": V.bollinger(daily), "v_vwap_bands": V.vwap_bands(daily), "v_empty": daily.where("false")})


@query(with_(DAILY, VIEW_DAILY) + "SELECT '7' AS ticker, count(*) AS spikes FROM view_daily WHERE ticker = '7' AND volume_spike")
def audit_spike_count(spark, sf_dir):
    return A.spike_count(V.daily(daily_bars(spark, sf_dir)), "7")
