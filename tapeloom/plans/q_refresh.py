"""The whole refresh over the given tables: from hourly and official bars to factor memberships and gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import refresh as R
from ..operators import snapshot as S
from ..registry import query
from ..sinks import commits as K
from ..sinks.tables import published
from ..sources.folders import fresh
from ..sources.tables import GRADES, companies, daily_bars, table
from . import q_factors as Q
from .q_bars import _ROLLUP, _SPREAD, VIEW_DAILY, _spread, _tail
from .q_news import CACHED, _classified
from .sql import COMPANIES, DAILY, listed, recurrences, with_

_HALF = 852_076_800_000  # the table holds official bars up to 1997; later ones arrive with the refresh
_NAMES = {"holding_pct_value": "(no + 1) / 10.0", "dollar_volume_20d_polygon": "(no + 1) * 1e6", "volatility_annual_polygon": "(no % 60) / 100.0", "short_pct_float": "(no % 15)::DOUBLE"}

_BARS = [
    DAILY.replace("daily AS", "api AS", 1),
    _SPREAD.replace("FROM daily)", "FROM api)"),
    f"rolled AS (SELECT ticker, timestamp // 86400000 * 86400000 AS timestamp, {_ROLLUP} FROM spread GROUP BY ticker, timestamp // 86400000 * 86400000 HAVING count(*) >= 6)",
    """daily AS (SELECT ticker, timestamp, open, high, low, close, volume, vwap, transactions FROM api UNION ALL
  SELECT ticker, timestamp, open, high, low, close, volume, vwap, NULL FROM rolled r WHERE NOT EXISTS (SELECT 1 FROM api a WHERE a.ticker = r.ticker AND a.timestamp // 86400000 = r.timestamp // 86400000))""",
]
_RICH = f"""held AS (SELECT ticker, name AS holding_name, {_NAMES['holding_pct_value']} AS holding_pct_value FROM companies WHERE no % 10 <> 9),
priced AS (SELECT * FROM daily QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY timestamp DESC) = 1), averaged AS (SELECT * FROM view_daily QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY timestamp DESC) = 1),
recl AS (SELECT ticker, ema_20, rsi_14, atr_14, keltner_upper, keltner_lower FROM rec WHERE rn = bars),
cal AS (SELECT o_custkey::VARCHAR AS ticker, {listed(GRADES, 'o_orderkey')} AS value_grade, {listed(GRADES, '(o_orderkey + 2)')} AS growth_grade, {listed(GRADES, '(o_orderkey * 3)')} AS momentum_grade FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate::DATE, o_orderkey) = 1),
vendor AS (SELECT ticker, CASE WHEN no % 5 <> 4 THEN {_NAMES['dollar_volume_20d_polygon']} END AS dollar_volume_20d_polygon, CASE WHEN no % 7 <> 0 THEN {_NAMES['volatility_annual_polygon']} END AS volatility_annual_polygon, {_NAMES['short_pct_float']} AS short_pct_float FROM companies WHERE no % 6 <> 1),
fac AS (SELECT ticker, CASE WHEN no % 2 = 0 THEN 'Cybersecurity, Oil & Gas' ELSE 'Oil & Gas' END AS keyword_factor_baskets, CASE WHEN no % 2 = 0 THEN 7.5 ELSE 4.0 END AS primary_keyword_factor_score FROM companies WHERE no % 7 <> 0),
rich AS (SELECT h.ticker, DATE '2024-06-01' AS as_of_date, coalesce(c.name, h.holding_name) AS company_name, k.sector AS raw_sector, k.industry, c.exchange, c.market_cap, holding_pct_value, p.close, p.volume, avg_vol_20, sma_20, sma_50, sma_200, ema_20, rsi_14, atr_14, keltner_upper, keltner_lower,
  p.close * p.volume AS dollar_volume, dollar_volume_20d_polygon, (p.close / sma_20 - 1.0) * 100.0 AS price_vs_sma20_pct, (p.close / sma_50 - 1.0) * 100.0 AS price_vs_sma50_pct, (p.close / sma_200 - 1.0) * 100.0 AS price_vs_sma200_pct, p.volume / avg_vol_20 AS volume_vs_20d,
  volatility_annual_polygon, short_pct_float, value_grade, growth_grade, momentum_grade, keyword_factor_baskets, primary_keyword_factor_score
  FROM held h LEFT JOIN priced p ON h.ticker = p.ticker LEFT JOIN companies c ON h.ticker = c.ticker LEFT JOIN averaged a ON h.ticker = a.ticker LEFT JOIN recl r ON h.ticker = r.ticker LEFT JOIN cal ON h.ticker = cal.ticker
  LEFT JOIN vendor w ON h.ticker = w.ticker LEFT JOIN fac f ON h.ticker = f.ticker LEFT JOIN c3 k ON h.ticker = k.ticker)"""
_CHAIN = with_(*_BARS, COMPANIES, VIEW_DAILY, _tail("daily", R.LOOKBACK), *recurrences("tail", 50), CACHED, _RICH, Q._UNI, *Q._MEM, recursive=True)
_GATES = with_(*_BARS, COMPANIES, VIEW_DAILY, _tail("daily", R.LOOKBACK), *recurrences("tail", 50), CACHED, _RICH, Q._UNI, *Q._PRODUCED, recursive=True)


def _refreshed(spark, sf_dir):
    """The folder and the counts of a refresh: official bars up to 1997 are there, all hourly ones and the later official ones arrive."""
    no, home = F.col("no"), fresh(spark, "refresh")
    base, daily = companies(spark, sf_dir), daily_bars(spark, sf_dir)
    old = F.col("timestamp") < _HALF
    K.create(daily.where(old), f"{home}/daily")
    held = S.universe(base.where("no % 10 <> 9").select(no.alias("ordinal"), "ticker", F.lit(None).cast("string").alias("cusip"), "name", F.lit("1").alias("valUSD"), ((no + 1) / 10.0).cast("string").alias("pctVal")))
    pick = lambda n: F.get(F.array(*map(F.lit, GRADES)), (n % len(GRADES)).cast("int"))
    key = F.col("o_orderkey")
    cal = table(spark, sf_dir, "orders").select(key.alias("ordinal"), F.col("o_custkey").cast("string").alias("ticker"), F.col("o_orderdate").cast("date").cast("string").alias("earnings_date"), F.lit("bmo").alias("earnings_when"), F.lit(None).cast("boolean").alias("is_t1"), pick(key).alias("value_grade"), pick(key + 2).alias("growth_grade"), pick(key * 3).alias("momentum_grade"))
    vendor = base.where("no % 6 <> 1").select("ticker", F.lit(0).cast("bigint").alias("polygon_keyword_count"), F.when(no % 5 != 4, (no + 1) * 1e6).alias("dollar_volume_20d_polygon"), F.when(no % 7 != 0, (no % 60) / 100.0).alias("volatility_annual_polygon"), (no % 15).cast("double").alias("short_pct_float"))
    member = lambda rows, name, score: rows.select(F.lit("2024-06-01").cast("date").alias("as_of_date"), "ticker", F.lit(name).alias("basket_name"), F.lit(score).alias("score"), F.lit("[]").alias("matched_keywords_json"), F.lit(1).alias("matched_keyword_count"))
    some = base.where("no % 7 <> 0")
    members = member(some, "Oil & Gas", 4.0).unionByName(member(some.where("no % 2 = 0"), "Cybersecurity", 7.5))
    details = base.select("ticker", "name", "exchange", "market_cap")
    classes = _classified(spark, sf_dir)[1]
    counts = R.refresh(spark, home, _spread(spark, sf_dir), daily.where(~old), held, [details, S.calendar(cal), vendor, S.factors(members)], classes, "2024-06-01")
    return home, counts


@query(_CHAIN + f"SELECT ticker, basket_type, basket_name, quant_factor_quintile, {Q.rounded('basket_score', 'quant_factor_score')} FROM mem")
def refresh_membership(spark, sf_dir):
    """Basket memberships at the end of the chain."""
    home, _ = _refreshed(spark, sf_dir)
    return published(spark, f"{home}/membership").withColumns({c: F.round(c, 6) for c in ("basket_score", "quant_factor_score")})


@query(_GATES + """SELECT 'sector_universe_rows' AS name, (SELECT count(*) FROM uni) AS value, (SELECT count(*) FROM uni) > 0 AS ok UNION ALL SELECT 'production_score_rows', (SELECT count(*) FROM prod), (SELECT count(*) FROM prod) > 0
 UNION ALL SELECT 'relative_long_idea_rows', (SELECT count(*) FROM prod WHERE production_factor_quintile = 1), (SELECT count(*) FROM prod WHERE production_factor_quintile = 1) > 0
 UNION ALL SELECT 'market_cap_filter_violations', 0, true UNION ALL SELECT 'macro_theme_violations', 0, true
 UNION ALL SELECT 'daily_bars', (SELECT count(*) FROM daily), true UNION ALL SELECT 'official_staged', (SELECT count(*) FROM api WHERE timestamp >= 852076800000), true""")
def refresh_gates(spark, sf_dir):
    """The factor gates at the end of the chain, and two counts of its merges."""
    home, counts = _refreshed(spark, sf_dir)
    more = [("daily_bars", counts["official"]["after"], True), ("official_staged", counts["official"]["staged"], True)]
    return published(spark, f"{home}/gates").unionByName(spark.createDataFrame(more, "name string, value long, ok boolean"))
