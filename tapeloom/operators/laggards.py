"""Basket-relative laggards: expected returns from single-factor slopes, residuals, ranks and ideas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .factors import ladder

# Labels, thresholds and weights that the views are defined by.
FLAGS = [("ret_1m_pct - expected_ret_1m_pct <= -20", "Severe negative regression residual"), ("ret_1m_pct - expected_ret_1m_pct <= -10", "Moderate negative regression residual"), ("ret_1m_z_score <= -1", "Basket-relative 1M laggard"), ("true", "Mild laggard / watchlist")]
THESES = [
    ("rsi_14 < 35 AND ret_1m_z_score < -1", "Oversold mean reversion"), ("production_factor_score >= basket_avg_factor_score AND ret_1m_pct < expected_ret_1m_pct", "Factor-quality catch-up"),
    ("size_z_score > 0 AND liquidity_z_score > 0 AND ret_1m_pct < expected_ret_1m_pct", "Liquid large-cap catch-up"), ("ret_3m_z_score < -1 AND ret_1m_z_score > ret_3m_z_score", "Early recovery from 3M lag"), ("true", "Relative-value laggard"),
]
RISKS = [("volatility_annual_polygon >= 0.60", "High volatility / lower sizing"), ("ret_3m_z_score <= -2", "Possible value trap; deep persistent lag"), ("rsi_14 > 70", "Already overbought despite lag score"), ("short_pct_float >= 10", "Short-interest squeeze/fragility risk"), ("true", "Standard basket-relative risk")]
HORIZONS = [("rsi_14 < 35", "1-4 weeks"), ("abs(regression_residual_1m_pct) >= 15", "1-2 months"), ("true", "2-4 months")]
CATALYSTS = [("long_thesis_type = 'Oversold mean reversion'", "RSI and negative basket residual normalize"), ("long_thesis_type = 'Factor-quality catch-up'", "Price catches up to factor score within basket"), ("long_thesis_type = 'Liquid large-cap catch-up'", "Institutional rotation back into liquid laggard"), ("long_thesis_type = 'Early recovery from 3M lag'", "1M improvement after 3M underperformance"), ("true", "Basket dispersion mean reverts")]
STATS = {"ret_1m": "ret_1m_pct", "ret_3m": "ret_3m_pct", "rsi": "rsi_14", "factor_score": "production_factor_score", "log_market_cap": "log_market_cap", "log_dollar_volume": "log_dollar_volume"}
SLOPES = {"ret_3m": "ret_3m_pct", "factor_score": "production_factor_score", "log_market_cap": "log_market_cap", "log_dollar_volume": "log_dollar_volume", "rsi": "rsi_14"}
Z_NAMES = {"ret_1m": "ret_1m_z_score", "ret_3m": "ret_3m_z_score", "rsi": "rsi_z_score", "factor_score": "factor_score_z_score", "log_market_cap": "size_z_score", "log_dollar_volume": "liquidity_z_score"}


def base(produced: DataFrame, least: float = 5e9) -> DataFrame:
    """Rows with what the regression needs, and logarithms of size and traded value."""
    traded = F.coalesce("dollar_volume_20d_polygon", "dollar_volume", F.col("close") * F.col("volume"), F.lit(1.0))
    rows = produced.where((F.col("market_cap") >= least) & (F.coalesce("production_factor_basket", F.lit("")) != "") & F.col("ret_1m_pct").isNotNull() & F.col("ret_3m_pct").isNotNull() & F.col("production_factor_score").isNotNull())
    return rows.withColumn("log_market_cap", F.ln(F.greatest("market_cap", F.lit(1.0)))).withColumn("log_dollar_volume", F.ln(F.greatest(traded, F.lit(1.0))))


def stats(rows: DataFrame) -> DataFrame:
    """Mean, deviation and slope of the 1-month return per basket; a slope over a constant is 0."""
    out = [F.count("*").alias("basket_count"), F.avg("ret_6m_pct").alias("basket_avg_ret_6m"), F.avg("ret_ytd_pct").alias("basket_avg_ret_ytd")]
    out += [f(F.col(c)).alias(f"basket_{n}_{k}") for k, c in STATS.items() for n, f in (("avg", F.avg), ("std", F.stddev_samp))]
    out += [F.coalesce(F.regr_slope("ret_1m_pct", c), F.lit(0.0)).alias(f"beta_{k}") for k, c in SLOPES.items()]
    return rows.groupBy("production_factor_basket").agg(*out)


def _z(key: str) -> Column:
    std = F.col(f"basket_std_{key}")
    return F.when(std > 0, (F.col(STATS[key]) - F.col(f"basket_avg_{key}")) / std).otherwise(0.0)


def expected(rows: DataFrame) -> DataFrame:
    """Deviations from the basket, z-scores, and the return that the five slopes add up to."""
    both = rows.join(stats(rows), "production_factor_basket")
    total = F.col("basket_avg_ret_1m")
    for k, c in SLOPES.items():
        total = total + F.col(f"beta_{k}") * (F.col(c) - F.col(f"basket_avg_{k}"))
    deviations = {f"{k}_deviation": F.col(c) - F.col(f"basket_avg_{k}") for k, c in STATS.items()}
    return both.withColumns(deviations | {n: _z(k) for k, n in Z_NAMES.items()} | {"expected_ret_1m_pct": total, "basket_avg_factor_score": F.col("basket_avg_factor_score")})


def ranked(scored: DataFrame, least: int = 10) -> DataFrame:
    """Residuals, laggard score, flags and the rank within baskets of ``least`` members."""
    positive = lambda c: F.greatest(c, F.lit(0.0))
    residual = F.col("ret_1m_pct") - F.col("expected_ret_1m_pct")
    std = F.col("basket_std_ret_1m")
    rows = scored.where(F.col("basket_count") >= least).withColumn("regression_residual_1m_pct", residual)
    rows = rows.withColumn("regression_residual_z_score", F.when(std > 0, residual / std).otherwise(0.0))
    lag = 0.40 * positive(-F.col("regression_residual_z_score")) + 0.20 * positive(-F.col("ret_1m_z_score")) + 0.15 * positive(-F.col("ret_3m_z_score"))
    lag = lag + 0.10 * positive(F.col("factor_score_z_score")) + 0.075 * positive(F.col("size_z_score")) + 0.075 * positive(F.col("liquidity_z_score"))
    rows = rows.withColumns({"relative_value_laggard_score": lag, "laggard_methodology_flag": ladder(FLAGS), "long_thesis_type": ladder(THESES), "risk_note": ladder(RISKS), "expected_time_horizon": ladder(HORIZONS)})
    order = Window.partitionBy("production_factor_basket").orderBy(F.desc("relative_value_laggard_score"), "regression_residual_1m_pct", "ret_1m_deviation", "ticker")
    return rows.withColumn("laggard_rank_in_basket", F.row_number().over(order))


def ideas(laggards: DataFrame, most: int = 10) -> DataFrame:
    return laggards.where(F.col("laggard_rank_in_basket") <= most).withColumn("expected_catalyst", ladder(CATALYSTS))


def ideas_summary(listed: DataFrame) -> DataFrame:
    mean = lambda c, n, d: F.round(F.avg(c), d).alias(n)
    return listed.groupBy("production_factor_basket").agg(
        F.count("*").alias("idea_count"), mean("relative_value_laggard_score", "avg_laggard_score", 3), mean("regression_residual_1m_pct", "avg_regression_residual_1m_pct", 2), mean("ret_1m_deviation", "avg_ret_1m_deviation_pct", 2),
        mean("ret_3m_deviation", "avg_ret_3m_deviation_pct", 2), mean("production_factor_score", "avg_production_factor_score", 2), F.round(F.avg("market_cap") / 1e9, 1).alias("avg_market_cap_bn"), F.expr("listagg(ticker, ', ') WITHIN GROUP (ORDER BY laggard_rank_in_basket)").alias("top_tickers"),
    )


# The earlier variant: one combined z-score, regimes, divergence. Thresholds and labels of its ladders.
REVERSION = [("rsi_14 < 50 AND ret_1m_deviation_pct < -20 AND ret_3m_deviation_pct < -15", "High Mean Reversion Potential"), ("rsi_14 < 60 AND ret_1m_deviation_pct < -15 AND ret_3m_deviation_pct < -10", "Moderate Mean Reversion Potential"), ("rsi_14 > 70 AND ret_1m_deviation_pct > 20 AND ret_3m_deviation_pct > 15", "Overextended - Short Risk"), ("true", "Neutral")]
ASSESSMENT = [("production_factor_score > basket_avg_factor_score * 0.9 AND ret_1m_deviation_pct < -10", "Strong Fundamentals, Weak Price"), ("production_factor_score < basket_avg_factor_score * 0.8 AND ret_1m_deviation_pct < -15", "Weak Fundamentals & Price - Avoid"), ("production_factor_score > basket_avg_factor_score * 1.1 AND ret_1m_deviation_pct < -5", "High Quality Relative Laggard"), ("true", "Mixed Fundamentals/Price")]
DIVERGENCE = [("ret_1m_deviation_pct < -15 AND ret_3m_deviation_pct < -10 AND basket_avg_ret_1m_pct > 10", "Severe Underperformance vs Strong Basket"), ("ret_1m_deviation_pct < -10 AND ret_3m_deviation_pct < -5 AND basket_avg_ret_3m_pct > 15", "Moderate Underperformance vs Strong Basket"), ("ret_1m_deviation_pct > 15 AND ret_3m_deviation_pct > 10", "Outperforming Basket - Not Laggard"), ("true", "Normal Variation")]
TREND = [("ret_1m_deviation_pct < -10 AND ret_3m_deviation_pct < -5", "Decelerating Underperformance"), ("ret_1m_deviation_pct < -20 AND ret_3m_deviation_pct > -5", "Recent Momentum Collapse"), ("ret_1m_deviation_pct > -5 AND ret_3m_deviation_pct < -15", "Recovery Attempt"), ("true", "Stable Underperformance")]
VALUATION = [("price_vs_sma200_pct < basket_avg_price_vs_sma200_pct - 10 AND rsi_14 < basket_avg_rsi_14", "Deep Value vs Basket"), ("price_vs_sma200_pct > basket_avg_price_vs_sma200_pct + 10 AND rsi_14 > basket_avg_rsi_14", "Overvalued vs Basket"), ("true", "Fair Value vs Basket")]
RATIONALE = [
    ("mean_reversion_regime = 'High Mean Reversion Potential' AND ret_1m_deviation_pct < -20", "Mean Reversion: Severe Oversold with Positive Divergence"), ("mean_reversion_regime = 'Moderate Mean Reversion Potential' AND ret_1m_deviation_pct < -15", "Mean Reversion: Technical Oversold vs Basket"),
    ("relative_value_assessment = 'High Quality Relative Laggard' AND production_factor_score > 6.0", "Quality Value: Strong Fundamentals Lagging Basket Momentum"), ("relative_value_assessment = 'Strong Fundamentals, Weak Price' AND basket_avg_ret_1m_pct > 10", "Relative Momentum: Basket Strength with Individual Weakness"),
    ("momentum_trend = 'Recovery Attempt' AND ret_1m_deviation_pct > -5 AND ret_3m_deviation_pct < -10", "Momentum Inflection: Recent Strength in Persistent Weakness"), ("true", "Relative Value Basket Diversification"),
]
CATALYST = [("rsi_14 < 35 AND ret_1m_deviation_pct < -20", "Catalyst: RSI Oversold Mean Reversion"), ("price_vs_sma200_pct < -20 AND ret_3m_deviation_pct < -15", "Catalyst: Major Support Level Test"), ("ret_1m_deviation_pct < -25 AND basket_avg_ret_1m_pct > 15", "Catalyst: Relative Strength Reversal"), ("production_factor_score > 7.0 AND ret_1m_deviation_pct < -10", "Catalyst: Fundamental Divergence Correction"), ("true", "Catalyst: Basket Momentum Normalization")]
RISK = [("volatility_annual_polygon > 0.50", "High Volatility Risk"), ("market_cap < 1e10", "Market Cap Risk"), ("rsi_14 > 70", "Overbought Risk"), ("ret_3m_deviation_pct < -25", "Deep Underperformance Risk"), ("true", "Moderate Risk")]
KEPT_DIVERGENCE = [x for _, x in DIVERGENCE[:2]]
KEPT_REVERSION = [x for _, x in REVERSION[:2]]
KEPT_ASSESSMENT = [ASSESSMENT[0][1], ASSESSMENT[2][1]]


def combined(produced: DataFrame) -> DataFrame:
    """Deviations from the basket's means, a combined score (least first), regimes, two ranks and a percentile."""
    by = produced.groupBy("production_factor_basket").agg(
        F.count("*").alias("basket_count"), F.avg("production_factor_score").alias("basket_avg_factor_score"), F.avg("ret_1m_pct").alias("basket_avg_ret_1m_pct"), F.avg("ret_3m_pct").alias("basket_avg_ret_3m_pct"), F.avg("ret_ytd_pct").alias("basket_avg_ret_ytd_pct"), F.avg("rsi_14").alias("basket_avg_rsi_14"),
        F.avg("price_vs_sma200_pct").alias("basket_avg_price_vs_sma200_pct"), F.stddev_samp("ret_1m_pct").alias("basket_std_ret_1m_pct"), F.stddev_samp("ret_3m_pct").alias("basket_std_ret_3m_pct"), F.stddev_samp("rsi_14").alias("basket_std_rsi_14"),
    )
    z = lambda d, s: F.when(F.col(s) > 0, F.col(d) / F.col(s)).otherwise(0.0)
    rows = produced.where("production_factor_basket IS NOT NULL").join(by, "production_factor_basket")
    rows = rows.withColumns({"ret_1m_deviation_pct": F.expr("ret_1m_pct - basket_avg_ret_1m_pct"), "ret_3m_deviation_pct": F.expr("ret_3m_pct - basket_avg_ret_3m_pct"), "ret_ytd_deviation_pct": F.expr("ret_ytd_pct - basket_avg_ret_ytd_pct"), "rsi_deviation": F.expr("rsi_14 - basket_avg_rsi_14"), "factor_score_deviation": F.expr("production_factor_score - basket_avg_factor_score")})
    rows = rows.withColumns({"ret_1m_z_score": z("ret_1m_deviation_pct", "basket_std_ret_1m_pct"), "ret_3m_z_score": z("ret_3m_deviation_pct", "basket_std_ret_3m_pct"), "rsi_z_score": z("rsi_deviation", "basket_std_rsi_14")})
    none = lambda c: F.coalesce(c, F.lit(0.0))
    score = -1.0 * (0.30 * none(F.col("ret_1m_z_score")) + 0.25 * none(F.col("ret_3m_z_score")) + 0.20 * none(F.col("factor_score_deviation")) + 0.15 * none(F.col("rsi_z_score")) + 0.10 * none(F.col("ret_ytd_deviation_pct") / F.nullif(F.abs("basket_avg_ret_ytd_pct"), F.lit(0.0))))
    rows = rows.withColumns({"combined_laggard_score": score, "mean_reversion_regime": ladder(REVERSION), "relative_value_assessment": ladder(ASSESSMENT), "momentum_divergence": ladder(DIVERGENCE), "momentum_trend": ladder(TREND), "valuation_vs_basket": ladder(VALUATION)})
    w = Window.partitionBy("production_factor_basket")
    return rows.withColumns({
        "laggard_rank_in_basket": F.row_number().over(w.orderBy("combined_laggard_score", "ret_1m_deviation_pct", "ret_3m_deviation_pct", "ticker")), "worst_return_rank_in_basket": F.row_number().over(w.orderBy("ret_1m_deviation_pct", "ret_3m_deviation_pct", "ticker")),
        "laggard_percentile_in_basket": F.cume_dist().over(w.orderBy("combined_laggard_score")),
    })


def combined_ideas(laggards: DataFrame, most: int = 10) -> DataFrame:
    """The first ranks in baskets that are strong while the ticker is weak, with rationale, catalyst and risk."""
    rows = laggards.where((F.col("laggard_rank_in_basket") <= most) & F.col("momentum_divergence").isin(KEPT_DIVERGENCE) & F.col("mean_reversion_regime").isin(KEPT_REVERSION) & F.col("relative_value_assessment").isin(KEPT_ASSESSMENT))
    return rows.withColumns({"long_idea_rationale": ladder(RATIONALE), "catalyst": ladder(CATALYST), "risk_assessment": ladder(RISK)})


def combined_summary(listed: DataFrame) -> DataFrame:
    """Per basket: counts, means, and the tickers, themes and rationales in rank order."""
    text = lambda c, sep: F.expr(f"listagg({c}, '{sep}') WITHIN GROUP (ORDER BY combined_laggard_score, ticker)")
    return listed.groupBy("production_factor_basket").agg(
        F.count("*").alias("idea_count"), F.sum("market_cap").alias("aggregate_market_cap"), F.avg("production_factor_score").alias("avg_factor_score"), F.avg("ret_1m_deviation_pct").alias("avg_ret_1m_deviation"), F.avg("ret_3m_deviation_pct").alias("avg_ret_3m_deviation"),
        F.avg("rsi_14").alias("avg_rsi_14"), text("ticker", ", ").alias("tickers"), text("production_theme", ", ").alias("themes"), text("long_idea_rationale", ". ").alias("idea_rationales"),
    )
