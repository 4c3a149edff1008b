"""The domain relations in SQL, for the registered queries' reference texts."""

from __future__ import annotations

DAILY = """daily AS (SELECT l_suppkey::VARCHAR AS ticker, epoch_ms(l_shipdate) AS timestamp,
  arg_min(p, o) AS open, max(p) AS high, min(p) AS low, arg_max(p, o) AS close, sum(l_quantity) AS volume,
  sum(p * l_quantity) / sum(l_quantity) AS vwap, count(*)::INTEGER AS transactions
  FROM (SELECT *, round(l_extendedprice * 100) AS p, row(l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity) AS o FROM lineitem)
  GROUP BY ALL)"""
HOURLY = """hourly AS (SELECT event_type AS ticker, epoch_us(ts) // 3600000000 * 3600000 AS timestamp,
  arg_min(p, o) AS open, max(p) AS high, min(p) AS low, arg_max(p, o) AS close, count(*)::DOUBLE AS volume,
  sum(p) / count(*) AS vwap, count(*)::INTEGER AS transactions
  FROM (SELECT *, round(value * 100) AS p, row(ts, event_id) AS o FROM events) GROUP BY ALL)"""
COMPANIES = """companies AS (SELECT s_suppkey::VARCHAR AS ticker, s_suppkey AS no, s_name AS name, s_acctbal * 1e8 AS market_cap, r_name AS exchange,
  printf('%02d00', s_nationkey * 4) AS sic_code, n_name AS industry, (s_suppkey % 11)::INTEGER AS sector_no, (s_suppkey + 1) * 1e6 AS shares_outstanding
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)"""

FOUR_HOURS = """four AS (SELECT ticker, timestamp // 14400000 * 14400000 AS timestamp, arg_min(open, timestamp) AS open, max(high) AS high,
  min(low) AS low, arg_max(close, timestamp) AS close, sum(volume) AS volume FROM hourly GROUP BY ticker, timestamp // 14400000 * 14400000)"""


def with_(*relations: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(relations) + "\n"


def recurrences(source: str, gate: int = 0) -> list[str]:
    """EMA 12/20/26, MACD signal, Wilder RSI 14 and ATR 10/14 of ``source`` by recursion over row numbers."""
    return [
        f"""n0 AS (SELECT *, row_number() OVER w AS rn, count(*) OVER (PARTITION BY ticker) AS bars, close - lag(close) OVER w AS d,
  greatest(high - low, abs(high - lag(close) OVER w), abs(low - lag(close) OVER w)) AS tr FROM {source} WINDOW w AS (PARTITION BY ticker ORDER BY timestamp))""",
        f"n AS (SELECT *, CASE WHEN d IS NOT NULL THEN greatest(d, 0) END AS gain, CASE WHEN d IS NOT NULL THEN greatest(-d, 0) END AS loss FROM n0 WHERE bars >= {gate})",
        """seed AS (SELECT ticker, avg(gain) FILTER (rn <= 14) AS g, avg(loss) FILTER (rn <= 14) AS l, avg(tr) FILTER (rn <= 10) AS a10, avg(tr) FILTER (rn <= 14) AS a14 FROM n GROUP BY ticker)""",
        """r AS (SELECT n.ticker, n.rn, n.close AS e12, n.close AS e20, n.close AS e26, NULL::DOUBLE AS sig, NULL::DOUBLE AS g, NULL::DOUBLE AS l, NULL::DOUBLE AS a10, NULL::DOUBLE AS a14
  FROM n WHERE rn = 1 UNION ALL
  SELECT ticker, rn, e12, e20, e26, CASE WHEN rn < 26 THEN NULL WHEN rn = 26 THEN e12 - e26 ELSE 0.8 * sig + 0.2 * (e12 - e26) END, g, l, a10, a14 FROM (
    SELECT n.ticker, n.rn, (1 - 2.0::DOUBLE / 13) * r.e12 + 2.0::DOUBLE / 13 * n.close AS e12, (1 - 2.0::DOUBLE / 21) * r.e20 + 2.0::DOUBLE / 21 * n.close AS e20, (1 - 2.0::DOUBLE / 27) * r.e26 + 2.0::DOUBLE / 27 * n.close AS e26, r.sig,
    CASE WHEN n.rn < 14 THEN NULL WHEN n.rn = 14 THEN s.g ELSE 13.0::DOUBLE / 14 * r.g + n.gain / 14 END AS g,
    CASE WHEN n.rn < 14 THEN NULL WHEN n.rn = 14 THEN s.l ELSE 13.0::DOUBLE / 14 * r.l + n.loss / 14 END AS l,
    CASE WHEN n.rn < 10 THEN NULL WHEN n.rn = 10 THEN s.a10 ELSE 9.0::DOUBLE / 10 * r.a10 + n.tr / 10 END AS a10,
    CASE WHEN n.rn < 14 THEN NULL WHEN n.rn = 14 THEN s.a14 ELSE 13.0::DOUBLE / 14 * r.a14 + n.tr / 14 END AS a14
    FROM r JOIN n ON n.ticker = r.ticker AND n.rn = r.rn + 1 JOIN seed s ON s.ticker = r.ticker))""",
        """rec AS (SELECT n.*, CASE WHEN n.rn >= 20 THEN e20 END AS ema_20, CASE WHEN n.rn < 15 THEN NULL WHEN l = 0 THEN 100.0 ELSE 100 - 100 / (1 + g / l) END AS rsi_14,
  a14 AS atr_14, CASE WHEN n.rn >= 20 THEN e20 END AS keltner_middle,
  CASE WHEN n.rn >= 20 THEN e20 + 1.5 * a10 END AS keltner_upper_1_5, CASE WHEN n.rn >= 20 THEN e20 - 1.5 * a10 END AS keltner_lower_1_5,
  CASE WHEN n.rn >= 20 THEN e20 + 2 * a10 END AS keltner_upper, CASE WHEN n.rn >= 20 THEN e20 - 2 * a10 END AS keltner_lower,
  CASE WHEN n.rn >= 20 THEN e20 + 3 * a10 END AS keltner_upper_3_0, CASE WHEN n.rn >= 20 THEN e20 - 3 * a10 END AS keltner_lower_3_0,
  CASE WHEN n.rn >= 26 THEN e12 - e26 END AS macd_line, CASE WHEN n.rn >= 34 THEN sig END AS macd_signal, CASE WHEN n.rn >= 34 THEN (e12 - e26) - sig END AS macd_histogram
  FROM n JOIN r ON n.ticker = r.ticker AND n.rn = r.rn)""",
    ]


def listed(values: list, index: str) -> str:
    """The element of a constant list at a zero-based index."""
    return "[" + ", ".join("NULL" if v is None else f"'{v}'" for v in values) + f"][{index} % {len(values)} + 1]"


def rich() -> list[str]:
    """The relations up to ``rich``."""
    from ..sources.tables import GRADES, SECTORS, THEMES
    from .q_bars import VIEW_DAILY

    return [
        DAILY, COMPANIES, VIEW_DAILY, *recurrences("daily"),
        f"""rich AS (SELECT c.ticker, DATE '2002-01-01' AS as_of_date, c.name AS company_name, CASE WHEN no % 23 = 5 THEN 'No Data' ELSE {listed(SECTORS, 'sector_no')} END AS raw_sector, industry, exchange,
  market_cap, shares_outstanding / 1e6 AS holding_pct_value, v.timestamp, v.close, v.volume, avg_vol_20, sma_20, sma_50, sma_200, ema_20, rsi_14, atr_14, keltner_upper, keltner_lower,
  v.close * v.volume AS dollar_volume, CASE WHEN no % 5 <> 4 THEN v.close * avg_vol_20 END AS dollar_volume_20d_polygon,
  (v.close / sma_20 - 1.0) * 100.0 AS price_vs_sma20_pct, (v.close / sma_50 - 1.0) * 100.0 AS price_vs_sma50_pct, (v.close / sma_200 - 1.0) * 100.0 AS price_vs_sma200_pct, v.volume / avg_vol_20 AS volume_vs_20d,
  CASE WHEN no % 7 <> 0 THEN (no % 60) / 100 END AS volatility_annual_polygon, (no % 15)::DOUBLE AS short_pct_float,
  {listed(GRADES, 'no')} AS value_grade, {listed(GRADES, '(no + 2)')} AS growth_grade, {listed(GRADES, '(no * 3)')} AS momentum_grade,
  {listed(THEMES, 'no')} AS keyword_factor_baskets, (no % 11)::DOUBLE AS primary_keyword_factor_score
  FROM companies c JOIN view_daily v ON c.ticker = v.ticker JOIN rec r ON r.ticker = v.ticker AND r.timestamp = v.timestamp WHERE r.rn = r.bars)""",
    ]
