"""Sector universe, returns, factor scores, baskets, spreads.

The ladders are ordered lists of (condition, label); the first that holds wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranking import cume_dists, cut, ntile, order_statistics

# Sector synonyms, grade points, themes, labels, thresholds and weights that the views are defined by.
SECTOR_NAMES = {
    "Technology": "Information Technology", "Information Technology": "Information Technology", "Healthcare": "Health Care", "Health Care": "Health Care",
    "Financial Services": "Financials", "Financials": "Financials", "Consumer Cyclical": "Consumer Discretionary", "Consumer Discretionary": "Consumer Discretionary",
    "Consumer Defensive": "Consumer Staples", "Consumer Staples": "Consumer Staples", "Basic Materials": "Materials", "Materials": "Materials",
    "Communication Services": "Communication Services", "Industrials": "Industrials", "Energy": "Energy", "Utilities": "Utilities", "Real Estate": "Real Estate",
}
GRADE_POINTS = {"A": 10.0, "B": 7.5, "C": 5.0, "D": 2.5, "F": 0.0}
THEMES = ["Semiconductors", "AI Infrastructure", "Cybersecurity", "Cloud Software", "Crypto / Digital Assets", "Healthcare / Biotech", "Defense / Aerospace", "Industrial Automation", "Energy Transition", "Oil & Gas", "Financials / Credit", "Consumer / Retail", "Housing / Real Estate", "Commodities / Materials"]
RETURN_RANKS = {"1w": 6, "1m": 22, "3m": 64, "6m": 127, "1y": 253}
_UP = "close > sma_20 AND close > sma_50 AND close > sma_200"
RSI_SCORES = [("rsi_14 BETWEEN 55 AND 72", 10.0), ("rsi_14 BETWEEN 50 AND 55", 8.0), ("rsi_14 BETWEEN 72 AND 80", 7.0), ("rsi_14 BETWEEN 40 AND 50", 5.0), ("rsi_14 BETWEEN 30 AND 40", 4.0), ("rsi_14 > 80", 3.0), ("rsi_14 < 30", 3.0), ("true", 5.0)]
TREND_POINTS = [
    [("close > sma_20", 2.0)], [("close > sma_50", 1.5)], [("close > sma_200", 1.5)], [("sma_20 > sma_50", 1.5)], [("sma_50 > sma_200", 1.5)],
    [("close > keltner_upper", 1.0), ("close < keltner_lower", -1.5)], [("price_vs_sma200_pct > 20", 1.0), ("price_vs_sma200_pct < -10", -1.0)],
]
MOMENTUM = {"ret_1m_pctile": 0.35, "ret_3m_pctile": 0.30, "ret_6m_pctile": 0.20, "ret_ytd_pctile": 0.15}
QUANT = {"price_momentum_score": 0.28, "trend_structure_score": 0.22, "rsi_regime_score": 0.12, "vol_risk_score": 0.10, "liquidity_score": 0.08, "coalesce(dolt_momentum_score, 5.0)": 0.07, "coalesce(dolt_growth_score, 5.0)": 0.07, "coalesce(dolt_value_score, 5.0)": 0.06}
PATTERNS = [
    (f"ret_1m_pctile >= 0.80 AND ret_3m_pctile >= 0.70 AND {_UP} AND rsi_14 BETWEEN 55 AND 80", "Momentum Breakout / Leadership"),
    (f"{_UP} AND sma_20 > sma_50 AND sma_50 > sma_200 AND rsi_14 BETWEEN 50 AND 75", "Persistent Uptrend / Compounder"),
    ("rsi_14 > 80 OR (close > keltner_upper AND ret_1m_pctile >= 0.90)", "Extended Overbought Momentum"),
    ("rsi_14 < 35 OR close < keltner_lower", "Oversold / Mean-Reversion Watch"),
    ("close < sma_50 AND close < sma_200 AND ret_3m_pctile <= 0.30", "Weak Downtrend / Avoid Momentum"),
    ("true", "Neutral / Transition"),
]
STYLES = [
    ("coalesce(dolt_growth_score, -1) >= 7.5 AND coalesce(dolt_momentum_score, -1) >= 7.5", "DoltHub Growth + Momentum"),
    ("coalesce(dolt_value_score, -1) >= 7.5 AND ret_1m_pctile >= 0.60", "DoltHub Value Catch-Up"),
    ("coalesce(dolt_value_score, -1) >= 7.5 AND coalesce(dolt_growth_score, -1) >= 7.5", "DoltHub Balanced V/G"),
    ("has_dolthub_vgm", "DoltHub Mixed/Weak VGM"),
    ("true", "No DoltHub VGM Coverage"),
]
TREND_VOL = [
    ("close > sma_50 AND close > sma_200 AND low_vol_pctile >= 0.70", "Low-Vol Uptrend"),
    ("price_momentum_score >= 8.0 AND volatility_annual_polygon >= 0.45", "High-Vol Momentum"),
    ("price_momentum_score <= 3.0 AND volatility_annual_polygon >= 0.45", "High-Vol Breakdown"),
    ("abs(coalesce(price_vs_sma50_pct, 0)) <= 5 AND rsi_14 BETWEEN 40 AND 60", "Base Building / Coiled"),
    ("true", "Normal Vol/Trend"),
]
SIZES = [("market_cap >= 1e12", "Mega Cap >$1T"), ("market_cap >= 2.5e11", "Mega Cap $250B-$1T"), ("market_cap >= 5e10", "Large Cap $50B-$250B"), ("market_cap >= 1e10", "Upper Mid / Large $10B-$50B"), ("true", "Lower Liquid $5B-$10B")]
LIQUIDITY = [("liquidity_pctile >= 0.90", "Top Decile Liquidity"), ("liquidity_pctile >= 0.75", "Top Quartile Liquidity"), ("liquidity_pctile >= 0.50", "Above-Median Liquidity"), ("liquidity_pctile >= 0.25", "Below-Median Liquidity"), ("true", "Low Relative Liquidity")]
REGIMES = [
    ("ret_1m_pct >= 20 AND ret_3m_pct >= 30", "Explosive 1M+3M Momentum"), ("ret_1m_pct >= 10 AND ret_3m_pct >= 15", "Strong Positive Momentum"), ("ret_1m_pct >= 0 AND ret_3m_pct >= 0", "Positive / Grinding Higher"),
    ("ret_1m_pct < -10 AND ret_3m_pct < -15", "Sharp Negative Momentum"), ("ret_1m_pct < 0 AND ret_3m_pct < 0", "Negative / Drifting Lower"), ("true", "Mixed Momentum"),
]
OVERLAYS = [
    ("has_dolthub_vgm AND coalesce(dolt_growth_score, 0) >= 7.5 AND coalesce(dolt_momentum_score, 0) >= 7.5", "Sparse DoltHub: Growth+Momentum Confirmed"),
    ("has_dolthub_vgm AND coalesce(dolt_value_score, 0) >= 7.5 AND price_momentum_score >= 6.0", "Sparse DoltHub: Value Catch-Up Confirmed"),
    ("has_dolthub_vgm AND coalesce(dolt_value_score, 0) >= 7.5", "Sparse DoltHub: Value Only"),
    ("has_dolthub_vgm", "Sparse DoltHub: Mixed/Weak"),
    ("true", "No DoltHub Overlay"),
]
SIZE_POINTS = [("market_cap >= 2.5e11", 1.0), ("market_cap >= 5e10", 0.8), ("market_cap >= 1e10", 0.6), ("true", 0.4)]
CORE = {"production_price_momentum_score": 0.26, "trend_structure_score": 0.20, "size_liquidity_momentum_score": 0.16, "institutional_momentum_score": 0.12, "rsi_regime_score": 0.10, "vol_risk_score": 0.08, "liquidity_score": 0.05, "clean_theme_score": 0.03}
PRODUCTION = [
    ("market_cap >= 2.5e11 AND liquidity_pctile >= 0.70 AND production_price_momentum_score >= 7.0 AND trend_structure_score >= 7.0", "Mega-Cap Liquid Momentum Leadership"),
    ("market_cap >= 5e10 AND liquidity_pctile >= 0.65 AND size_liquidity_momentum_score >= 7.0 AND aligned_uptrend_flag = 1", "Institutional Large-Cap Accumulation"),
    ("market_cap < 5e10 AND production_price_momentum_score >= 8.0 AND volatility_annual_polygon >= 0.45", "Smaller-Cap High-Beta Breakout"),
    ("production_theme IS NOT NULL AND production_price_momentum_score >= 7.0 AND trend_structure_score >= 6.0", "Thematic Momentum Leadership"),
    ("aligned_uptrend_flag = 1 AND vol_risk_score >= 7.0", "Quality / Low-Vol Uptrend"),
    ("rsi_14 > 80 OR (keltner_position_flag = 1 AND ret_1m_pctile >= 0.90)", "Extended Momentum Risk"),
    ("rsi_14 < 35 OR keltner_position_flag = -1", "Oversold / Mean-Reversion Watch"),
    ("close < sma_50 AND close < sma_200 AND ret_3m_pctile <= 0.30", "Broken Momentum / Avoid"),
    ("true", "Neutral / Transition"),
]
BREAKOUTS = ["Mega-Cap Liquid Momentum Leadership", "Institutional Large-Cap Accumulation", "Smaller-Cap High-Beta Breakout", "Thematic Momentum Leadership"]
LEAST_CAP = 5e9


def ladder(steps: list[tuple[str, object]], otherwise=None) -> Column:
    out = F
    for condition, value in steps:
        out = out.when(F.expr(condition), F.lit(value))
    return out if otherwise is None else out.otherwise(F.lit(otherwise))


def weighted(weights: dict[str, float], default: float | None = None) -> Column:
    terms = [F.lit(w) * (F.expr(c) if default is None else F.coalesce(F.expr(c), F.lit(default))) for c, w in weights.items()]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total


def share(column: str, *keys: str) -> Column:
    """A row's share of its group's sum; null for a zero sum."""
    return F.col(column) / F.nullif(F.sum(column).over(Window.partitionBy(*keys)), F.lit(0.0))


def sector_universe(rich: DataFrame, least: float = LEAST_CAP) -> DataFrame:
    """Classified tickers above ``least``: folded sector, weights and ranks in the sector and overall."""
    names = F.create_map(*[F.lit(x) for pair in SECTOR_NAMES.items() for x in pair])
    rows = rich.where((F.col("market_cap") > least) & F.col("raw_sector").isNotNull() & ~F.col("raw_sector").isin("", "No Data"))
    rows = rows.withColumn("sector", names[F.col("raw_sector")]).where("sector IS NOT NULL")
    rows = cut(rows)  # read for the totals and for the ranks
    total = rows.agg(F.nullif(F.sum("market_cap"), F.lit(0.0)).alias("_cap"), F.nullif(F.sum("holding_pct_value"), F.lit(0.0)).alias("_pct"))
    rows = rows.join(F.broadcast(total), F.lit(True))  # one row
    by_cap = [F.desc_nulls_last("market_cap"), F.col("ticker")]
    rows = rows.withColumns({
        "sector_market_cap_weight": share("market_cap", "sector"), "universe_market_cap_weight": F.col("market_cap") / F.col("_cap"),
        "sector_vti_weight": share("holding_pct_value", "sector"), "universe_vti_weight": F.col("holding_pct_value") / F.col("_pct"),
        "sector_market_cap_rank": F.row_number().over(Window.partitionBy("sector").orderBy(*by_cap)),
    }).drop("_cap", "_pct")
    from ..functions.ranking import position

    return position(rows, "market_cap", "universe_market_cap_rank", "ticker", descending=True).drop("_total")


def sector_slice(universe: DataFrame, sector: str) -> DataFrame:
    return universe.where(F.col("sector") == sector)


SUMMARY_MEASURES = ["rsi_14", "price_vs_sma20_pct", "price_vs_sma50_pct", "price_vs_sma200_pct", "volatility_annual_polygon", "short_pct_float"]


def sector_summary(universe: DataFrame) -> DataFrame:
    """Counts, caps with their median, and cap-weighted measures of each sector."""
    universe = cut(universe)
    sums = universe.groupBy("sector").agg(
        F.count("*").alias("ticker_count"), F.sum("market_cap").alias("aggregate_market_cap"), F.sum("holding_pct_value").alias("aggregate_vti_holding_pct"),
        F.avg("market_cap").alias("avg_market_cap"), F.sum("dollar_volume_20d_polygon").alias("aggregate_20d_dollar_volume"),
        *(F.sum(F.col("sector_market_cap_weight") * F.col(m)).alias(f"cap_weighted_{m}") for m in SUMMARY_MEASURES),
    )
    n = F.col("_n")
    middle = order_statistics(universe, ["sector"], "market_cap", {"_lower": F.floor((n + 1) / 2), "_upper": F.floor(n / 2) + 1}).withColumnRenamed("sector", "_sector")
    both = sums.join(middle, F.col("sector").eqNullSafe(F.col("_sector")), "left")
    return both.withColumn("median_market_cap", (F.col("_lower") + F.col("_upper")) / 2).drop("_sector", "_lower", "_upper")


def returns(bars: DataFrame) -> DataFrame:
    """Percent returns to the last close from 6, 22, 64, 127 and 253 bars back (counted from 1), and from the year's first."""
    w = Window.partitionBy("ticker")
    rows = bars.where("close > 0").select("ticker", "timestamp", "close")
    rows = rows.withColumn("_rn", F.row_number().over(w.orderBy(F.desc("timestamp")))).withColumn("_last", F.max("timestamp").over(w))
    year = lambda c: F.year(F.timestamp_millis(c))
    rows = rows.withColumn("_same", year("timestamp") == year("_last"))
    got = rows.groupBy("ticker").agg(
        F.max("_last").alias("latest_timestamp"), F.max(F.when(F.col("_rn") == 1, F.col("close"))).alias("latest_close"),
        *(F.max(F.when(F.col("_rn") == k, F.col("close"))).alias(f"_{n}") for n, k in RETURN_RANKS.items()), F.expr("min_by(close, timestamp) FILTER (WHERE _same)").alias("_ytd"),
    )
    return got.select("ticker", *_percents("latest_timestamp", "latest_close", "_"))


def _percents(last: str, close: str, before: str) -> list[Column]:
    """The last day and close, and the returns to it from the closes named ``before`` and the span."""
    pct = lambda n: (100.0 * (F.col(close) / F.nullif(f"{before}{n}", F.lit(0.0)) - 1.0)).alias(f"ret_{n}_pct")
    return [F.to_date(F.timestamp_millis(last)).alias("latest_price_day"), F.col(close).alias("latest_close"), *map(pct, [*RETURN_RANKS, "ytd"])]


def with_returns(rows: DataFrame) -> DataFrame:
    """``returns`` beside other columns, from the closes that ``indicators.standing`` found; rows without a positive close fall out."""
    rest = [c for c in rows.columns if not c.startswith("_back_")]
    return rows.where("_back_close IS NOT NULL").select(*rest, *_percents("_back_timestamp", "_back_close", "_back_"))


def features(universe: DataFrame, bars: DataFrame | None = None) -> DataFrame:
    """Returns, grade points, theme and six percentiles over the universe.

    Without ``bars`` the universe brings the closes (``indicators.standing`` with ``RETURN_RANKS``), so bars are made once.
    """
    points = F.create_map(*[F.lit(x) for pair in GRADE_POINTS.items() for x in pair])
    rows = with_returns(universe) if bars is None else universe.join(returns(bars), "ticker")
    rows = rows.withColumns({f"dolt_{g}_score": points[F.upper(F.nullif(f"{g}_grade", F.lit("")))] for g in ("value", "growth", "momentum")})
    rows = rows.withColumn("clean_keyword_theme", ladder([(f"keyword_factor_baskets LIKE '%{t}%'", t) for t in THEMES]))
    orders = {f"ret_{m}_pctile": (f"ret_{m}_pct", False, True) for m in ("1m", "3m", "6m", "ytd")}
    orders |= {"low_vol_pctile": ("volatility_annual_polygon", True, False), "liquidity_pctile": ("dollar_volume_20d_polygon", False, True)}
    return cume_dists(rows, "ticker", orders)


def scores(featured: DataFrame) -> DataFrame:
    """Momentum, trend, RSI regime, volatility and liquidity scores, their blend, its quintile, and four baskets."""
    trend = F.lit(0.0)
    for steps in TREND_POINTS:
        trend = trend + ladder(steps, 0.0)
    rows = featured.withColumns({
        "price_momentum_score": 10.0 * weighted(MOMENTUM, 0.5), "trend_structure_score": F.least(F.lit(10.0), F.greatest(F.lit(0.0), trend)), "rsi_regime_score": ladder(RSI_SCORES),
        "vol_risk_score": 10.0 * F.coalesce("low_vol_pctile", F.lit(0.5)), "liquidity_score": 10.0 * F.coalesce("liquidity_pctile", F.lit(0.5)),
        "has_dolthub_vgm": F.coalesce("dolt_value_score", "dolt_growth_score", "dolt_momentum_score").isNotNull(),
    })
    rows = ntile(rows.withColumn("quant_factor_score", weighted(QUANT)), 5, "quant_factor_score", "quant_factor_quintile", "ticker", descending=True)
    return rows.withColumns({"price_pattern_basket": ladder(PATTERNS), "dolthub_style_basket": ladder(STYLES), "trend_vol_basket": ladder(TREND_VOL), "thematic_basket": F.coalesce("clean_keyword_theme", F.lit("No Clean Keyword Theme"))})


MEMBER_BASKETS = [
    ("price_pattern", "price_pattern_basket", "price_momentum_score"),
    ("dolthub_style", "dolthub_style_basket", "(coalesce(dolt_value_score, 5) + coalesce(dolt_growth_score, 5) + coalesce(dolt_momentum_score, 5)) / 3"),
    ("trend_vol", "trend_vol_basket", "0.5 * trend_structure_score + 0.5 * vol_risk_score"),
    ("theme", "thematic_basket", "coalesce(primary_keyword_factor_score, 0.0)"),
]
PRODUCTION_BASKETS = [
    ("production_factor", "production_factor_basket", "production_factor_score"),
    ("theme", "coalesce(production_theme, 'No Clean Theme')", "clean_theme_score"),
    ("size", "size_bucket", "size_liquidity_momentum_score"),
    ("liquidity", "liquidity_bucket", "liquidity_score"),
    ("dolthub_sparse_overlay", "dolthub_overlay_label", "coalesce(dolthub_overlay_score, 5.0)"),
]


def membership(scored: DataFrame, baskets: list[tuple[str, str, str]] = MEMBER_BASKETS) -> DataFrame:
    """One row per ticker and basket type, from one pass over the scores."""
    each = F.array(*(F.struct(F.lit(kind).alias("basket_type"), F.expr(name).alias("basket_name"), F.expr(score).cast("double").alias("basket_score")) for kind, name, score in baskets))
    return scored.withColumn("_b", F.explode(each)).select("*", "_b.*").drop("_b")


SUMMARY_AVERAGES = ["quant_factor_score", "basket_score", "ret_1m_pct", "ret_3m_pct", "ret_6m_pct", "ret_ytd_pct", "rsi_14", "price_vs_sma50_pct", "price_vs_sma200_pct"]


def by_market_cap() -> Column:
    return F.expr("listagg(ticker, ', ') WITHIN GROUP (ORDER BY market_cap DESC, ticker)")


def basket_summary(members: DataFrame) -> DataFrame:
    return members.groupBy("basket_type", "basket_name").agg(F.count("*").alias("ticker_count"), F.sum("market_cap").alias("aggregate_market_cap"), *(F.avg(m).alias(f"avg_{m}") for m in SUMMARY_AVERAGES), by_market_cap().alias("tickers_by_market_cap"))


def leaders(scored: DataFrame) -> DataFrame:
    """The first quintile, momentum breakouts and oversold tickers, each named by ``list_name``."""
    lists = F.array_compact(F.array(F.when(F.col("quant_factor_quintile") == 1, "leaders"), F.when(F.col("price_pattern_basket") == PATTERNS[0][1], "momentum_breakouts"), F.when(F.col("price_pattern_basket") == PATTERNS[3][1], "oversold")))
    return scored.withColumn("list_name", F.explode(lists))


def production_scores(scored: DataFrame) -> DataFrame:
    """Size, liquidity and return regimes, overlay and composite scores; then the production score, quintile and basket."""
    grade = lambda g: F.coalesce(f"dolt_{g}_score", F.lit(5.0))
    rows = scored.withColumns({
        "size_bucket": ladder(SIZES), "liquidity_bucket": ladder(LIQUIDITY), "return_regime": ladder(REGIMES),
        "production_theme": F.when(~F.col("thematic_basket").isin("No Clean Keyword Theme", "Macro Rates / Inflation"), F.col("thematic_basket")),
        "dolthub_overlay_label": ladder(OVERLAYS), "dolthub_overlay_score": F.when(F.col("has_dolthub_vgm"), (grade("value") + grade("growth") + grade("momentum")) / 3.0),
    })
    top = rows.agg(F.nullif(F.max("universe_market_cap_weight"), F.lit(0.0)).alias("_top"))
    rows = rows.join(F.broadcast(top), F.lit(True))  # one row
    half = lambda **w: weighted({f"{c}_pctile": x for c, x in w.items()}, 0.5)
    rows = rows.withColumns({
        "production_price_momentum_score": 10.0 * half(ret_1m=0.40, ret_3m=0.35, ret_6m=0.15, ret_ytd=0.10),
        "size_liquidity_momentum_score": 10.0 * (half(ret_1m=0.45, ret_3m=0.30, liquidity=0.15) + 0.10 * F.coalesce(F.col("universe_market_cap_weight") / F.col("_top"), F.lit(0.0))),
        "institutional_momentum_score": 10.0 * (half(ret_1m=0.35, ret_3m=0.20, liquidity=0.25) + 0.20 * ladder(SIZE_POINTS)),
        "clean_theme_score": F.least(F.lit(10.0), F.greatest(F.lit(0.0), 0.70 * F.coalesce("primary_keyword_factor_score", F.lit(0.0)) + F.when(F.col("production_theme").isNotNull(), 2.0).otherwise(0.0))),
        "aligned_uptrend_flag": ladder([(f"{_UP} AND sma_20 > sma_50", 1)], 0), "keltner_position_flag": ladder([("close > keltner_upper", 1), ("close < keltner_lower", -1)], 0),
    }).drop("_top")
    adjust = ladder([("dolthub_overlay_score >= 7.5", 0.25), ("dolthub_overlay_score <= 2.5", -0.25)], 0.0)
    rows = rows.withColumn("core_factor_score", weighted(CORE)).withColumn("production_factor_score", F.col("core_factor_score") + adjust)
    rows = ntile(rows, 5, "production_factor_score", "production_factor_quintile", "ticker", descending=True)
    return rows.withColumn("production_factor_basket", ladder(PRODUCTION))


VECTOR_MEASURES = ["ret_1w_pct", "ret_1m_pct", "ret_3m_pct", "ret_6m_pct", "ret_1y_pct", "ret_ytd_pct", "rsi_14"]


def basket_vectors(members: DataFrame) -> DataFrame:
    """Cap- and liquidity-weighted measures of each production basket."""
    keys = ["basket_type", "basket_name"]
    rows = members.withColumn("_cap", share("market_cap", *keys)).withColumn("_liq", share("dollar_volume_20d_polygon", *keys))
    by_cap = lambda c, n: F.sum(F.col("_cap") * F.col(c)).alias(f"cap_weighted_{n}")
    return rows.groupBy(*keys).agg(
        F.count("*").alias("ticker_count"), F.sum("market_cap").alias("aggregate_market_cap"), F.sum("dollar_volume_20d_polygon").alias("aggregate_20d_dollar_volume"), F.avg("production_factor_score").alias("avg_factor_score"),
        by_cap("production_factor_score", "factor_score"), *(by_cap(m, m) for m in VECTOR_MEASURES), by_cap("volatility_annual_polygon", "volatility_annual"),
        *(F.sum(F.col("_liq") * F.col(f"ret_{m}_pct")).alias(f"liquidity_weighted_ret_{m}_pct") for m in ("1m", "3m")), by_market_cap().alias("tickers_by_market_cap"),
    )


SPREADS = {"factor_score_spread": "factor_score", "ret_1m_spread_pct": "ret_1m_pct", "ret_3m_spread_pct": "ret_3m_pct", "ret_ytd_spread_pct": "ret_ytd_pct", "rsi_spread": "rsi_14", "vol_spread": "volatility_annual"}


def basket_spreads(vectors: DataFrame, least: int = 10) -> DataFrame:
    """Differences between every two baskets of one type with ``least`` members each; baskets are few by construction."""
    rows = vectors.where(F.col("basket_type").isin("production_factor", "theme") & (F.col("ticker_count") >= least))
    a, b = rows.alias("a"), rows.alias("b")
    pairs = a.join(b, (F.col("a.basket_type") == F.col("b.basket_type")) & (F.col("a.basket_name") < F.col("b.basket_name")))
    return pairs.select(
        F.col("a.basket_type"), F.col("a.basket_name").alias("basket_a"), F.col("b.basket_name").alias("basket_b"),
        *((F.col(f"a.cap_weighted_{c}") - F.col(f"b.cap_weighted_{c}")).alias(n) for n, c in SPREADS.items()),
        F.col("a.ticker_count").alias("basket_a_count"), F.col("b.ticker_count").alias("basket_b_count"),
    )


def production_lists(produced: DataFrame) -> DataFrame:
    lists = F.array_compact(F.array(F.when(F.col("production_factor_quintile") == 1, "leaders"), F.when(F.col("production_factor_basket").isin(BREAKOUTS), "breakouts"), F.when(F.col("has_dolthub_vgm"), "overlay")))
    return produced.withColumn("list_name", F.explode(lists))


CHANGES = [
    ("_p IS NULL", "NEWLY_QUALIFIED"), ("_c IS NULL", "DISQUALIFIED_OR_REMOVED"), ("old_basket <> new_basket", "BASKET_CHANGED"),
    ("old_size <> new_size OR old_liquidity <> new_liquidity OR coalesce(old_theme, '') <> coalesce(new_theme, '')", "PARAMETER_BUCKET_CHANGED"),
    ("abs(coalesce(new_score, 0) - coalesce(old_score, 0)) >= 1.0", "SCORE_MOVED_GE_1PT"), ("true", "UNCHANGED"),
]


def changes(previous: DataFrame, current: DataFrame) -> DataFrame:
    """How each constituent changed between two snapshots."""
    names = {"production_factor_basket": "basket", "production_factor_score": "score", "size_bucket": "size", "liquidity_bucket": "liquidity", "production_theme": "theme"}
    side = lambda df, x, mark: df.select("ticker", *(F.col(c).alias(f"{x}_{n}") for c, n in names.items()), F.lit(1).alias(mark))
    return side(previous, "old", "_p").join(side(current, "new", "_c"), "ticker", "full_outer").withColumn("change_type", ladder(CHANGES)).drop("_p", "_c")


def previous_date(snapshots: DataFrame, today: str) -> DataFrame:
    return snapshots.where(F.col("snapshot_date") < F.lit(today).cast("date")).agg(F.max("snapshot_date").alias("previous_snapshot_date"))


def distribution(produced: DataFrame) -> DataFrame:
    """Counts and rounded means of each production basket, and counts of each theme."""
    mean = lambda c, n, d: F.round(F.avg(c), d).alias(n)
    baskets = produced.groupBy(F.col("production_factor_basket").alias("name")).agg(F.count("*").alias("n"), mean("production_factor_score", "avg_score", 2), mean("ret_1m_pct", "avg_1m", 2), mean("ret_3m_pct", "avg_3m", 2), mean("rsi_14", "avg_rsi", 1))
    themes = produced.groupBy(F.coalesce("production_theme", F.lit("No Clean Theme")).alias("name")).agg(F.count("*").alias("n"))
    return baskets.withColumn("report", F.lit("basket")).unionByName(themes.withColumn("report", F.lit("theme")), allowMissingColumns=True)


def change_counts(changed: DataFrame) -> DataFrame:
    """How many constituents changed in each way."""
    return changed.where("change_type <> 'UNCHANGED'").groupBy("change_type").agg(F.count("*").alias("n"))
