"""Fixed values of the reference SQL: labels, thresholds, weights and word lists as they must come out.

They are stated here once more, apart from the operators' own, so that a value
changed there turns its queries red.
"""

from __future__ import annotations

# sectors, returns, scores and baskets
BREAKOUTS = ['Mega-Cap Liquid Momentum Leadership', 'Institutional Large-Cap Accumulation', 'Smaller-Cap High-Beta Breakout', 'Thematic Momentum Leadership']
CORE = {'production_price_momentum_score': 0.26,
 'trend_structure_score': 0.2,
 'size_liquidity_momentum_score': 0.16,
 'institutional_momentum_score': 0.12,
 'rsi_regime_score': 0.1,
 'vol_risk_score': 0.08,
 'liquidity_score': 0.05,
 'clean_theme_score': 0.03}
GRADE_POINTS = {'A': 10.0, 'B': 7.5, 'C': 5.0, 'D': 2.5, 'F': 0.0}
LIQUIDITY = [('liquidity_pctile >= 0.90', 'Top Decile Liquidity'), ('liquidity_pctile >= 0.75', 'Top Quartile Liquidity'), ('liquidity_pctile >= 0.50', 'Above-Median Liquidity'),
 ('liquidity_pctile >= 0.25', 'Below-Median Liquidity'), ('true', 'Low Relative Liquidity')]
MEMBER_BASKETS = [('price_pattern', 'price_pattern_basket', 'price_momentum_score'),
 ('dolthub_style', 'dolthub_style_basket', '(coalesce(dolt_value_score, 5) + coalesce(dolt_growth_score, 5) + coalesce(dolt_momentum_score, 5)) / 3'),
 ('trend_vol', 'trend_vol_basket', '0.5 * trend_structure_score + 0.5 * vol_risk_score'), ('theme', 'thematic_basket', 'coalesce(primary_keyword_factor_score, 0.0)')]
MOMENTUM = {'ret_1m_pctile': 0.35, 'ret_3m_pctile': 0.3, 'ret_6m_pctile': 0.2, 'ret_ytd_pctile': 0.15}
OVERLAYS = [('has_dolthub_vgm AND coalesce(dolt_growth_score, 0) >= 7.5 AND coalesce(dolt_momentum_score, 0) >= 7.5', 'Sparse DoltHub: Growth+Momentum Confirmed'),
 ('has_dolthub_vgm AND coalesce(dolt_value_score, 0) >= 7.5 AND price_momentum_score >= 6.0', 'Sparse DoltHub: Value Catch-Up Confirmed'),
 ('has_dolthub_vgm AND coalesce(dolt_value_score, 0) >= 7.5', 'Sparse DoltHub: Value Only'), ('has_dolthub_vgm', 'Sparse DoltHub: Mixed/Weak'), ('true', 'No DoltHub Overlay')]
PATTERNS = [('ret_1m_pctile >= 0.80 AND ret_3m_pctile >= 0.70 AND close > sma_20 AND close > sma_50 AND close > sma_200 AND rsi_14 BETWEEN 55 AND 80', 'Momentum Breakout / Leadership'),
 ('close > sma_20 AND close > sma_50 AND close > sma_200 AND sma_20 > sma_50 AND sma_50 > sma_200 AND rsi_14 BETWEEN 50 AND 75', 'Persistent Uptrend / Compounder'),
 ('rsi_14 > 80 OR (close > keltner_upper AND ret_1m_pctile >= 0.90)', 'Extended Overbought Momentum'), ('rsi_14 < 35 OR close < keltner_lower', 'Oversold / Mean-Reversion Watch'),
 ('close < sma_50 AND close < sma_200 AND ret_3m_pctile <= 0.30', 'Weak Downtrend / Avoid Momentum'), ('true', 'Neutral / Transition')]
PRODUCTION = [('market_cap >= 2.5e11 AND liquidity_pctile >= 0.70 AND production_price_momentum_score >= 7.0 AND trend_structure_score >= 7.0', 'Mega-Cap Liquid Momentum Leadership'),
 ('market_cap >= 5e10 AND liquidity_pctile >= 0.65 AND size_liquidity_momentum_score >= 7.0 AND aligned_uptrend_flag = 1', 'Institutional Large-Cap Accumulation'),
 ('market_cap < 5e10 AND production_price_momentum_score >= 8.0 AND volatility_annual_polygon >= 0.45', 'Smaller-Cap High-Beta Breakout'),
 ('production_theme IS NOT NULL AND production_price_momentum_score >= 7.0 AND trend_structure_score >= 6.0', 'Thematic Momentum Leadership'),
 ('aligned_uptrend_flag = 1 AND vol_risk_score >= 7.0', 'Quality / Low-Vol Uptrend'),
 ('rsi_14 > 80 OR (keltner_position_flag = 1 AND ret_1m_pctile >= 0.90)', 'Extended Momentum Risk'),
 ('rsi_14 < 35 OR keltner_position_flag = -1', 'Oversold / Mean-Reversion Watch'), ('close < sma_50 AND close < sma_200 AND ret_3m_pctile <= 0.30', 'Broken Momentum / Avoid'),
 ('true', 'Neutral / Transition')]
PRODUCTION_BASKETS = [('production_factor', 'production_factor_basket', 'production_factor_score'), ('theme', "coalesce(production_theme, 'No Clean Theme')", 'clean_theme_score'),
 ('size', 'size_bucket', 'size_liquidity_momentum_score'), ('liquidity', 'liquidity_bucket', 'liquidity_score'),
 ('dolthub_sparse_overlay', 'dolthub_overlay_label', 'coalesce(dolthub_overlay_score, 5.0)')]
QUANT = {'price_momentum_score': 0.28,
 'trend_structure_score': 0.22,
 'rsi_regime_score': 0.12,
 'vol_risk_score': 0.1,
 'liquidity_score': 0.08,
 'coalesce(dolt_momentum_score, 5.0)': 0.07,
 'coalesce(dolt_growth_score, 5.0)': 0.07,
 'coalesce(dolt_value_score, 5.0)': 0.06}
REGIMES = [('ret_1m_pct >= 20 AND ret_3m_pct >= 30', 'Explosive 1M+3M Momentum'), ('ret_1m_pct >= 10 AND ret_3m_pct >= 15', 'Strong Positive Momentum'),
 ('ret_1m_pct >= 0 AND ret_3m_pct >= 0', 'Positive / Grinding Higher'), ('ret_1m_pct < -10 AND ret_3m_pct < -15', 'Sharp Negative Momentum'),
 ('ret_1m_pct < 0 AND ret_3m_pct < 0', 'Negative / Drifting Lower'), ('true', 'Mixed Momentum')]
RETURN_RANKS = {'1w': 6, '1m': 22, '3m': 64, '6m': 127, '1y': 253}
RSI_SCORES = [('rsi_14 BETWEEN 55 AND 72', 10.0), ('rsi_14 BETWEEN 50 AND 55', 8.0), ('rsi_14 BETWEEN 72 AND 80', 7.0), ('rsi_14 BETWEEN 40 AND 50', 5.0), ('rsi_14 BETWEEN 30 AND 40', 4.0),
 ('rsi_14 > 80', 3.0), ('rsi_14 < 30', 3.0), ('true', 5.0)]
SECTOR_NAMES = {'Technology': 'Information Technology',
 'Information Technology': 'Information Technology',
 'Healthcare': 'Health Care',
 'Health Care': 'Health Care',
 'Financial Services': 'Financials',
 'Financials': 'Financials',
 'Consumer Cyclical': 'Consumer Discretionary',
 'Consumer Discretionary': 'Consumer Discretionary',
 'Consumer Defensive': 'Consumer Staples',
 'Consumer Staples': 'Consumer Staples',
 'Basic Materials': 'Materials',
 'Materials': 'Materials',
 'Communication Services': 'Communication Services',
 'Industrials': 'Industrials',
 'Energy': 'Energy',
 'Utilities': 'Utilities',
 'Real Estate': 'Real Estate'}
SIZES = [('market_cap >= 1e12', 'Mega Cap >$1T'), ('market_cap >= 2.5e11', 'Mega Cap $250B-$1T'), ('market_cap >= 5e10', 'Large Cap $50B-$250B'),
 ('market_cap >= 1e10', 'Upper Mid / Large $10B-$50B'), ('true', 'Lower Liquid $5B-$10B')]
SIZE_POINTS = [('market_cap >= 2.5e11', 1.0), ('market_cap >= 5e10', 0.8), ('market_cap >= 1e10', 0.6), ('true', 0.4)]
SPREADS = {'factor_score_spread': 'factor_score',
 'ret_1m_spread_pct': 'ret_1m_pct',
 'ret_3m_spread_pct': 'ret_3m_pct',
 'ret_ytd_spread_pct': 'ret_ytd_pct',
 'rsi_spread': 'rsi_14',
 'vol_spread': 'volatility_annual'}
STYLES = [('coalesce(dolt_growth_score, -1) >= 7.5 AND coalesce(dolt_momentum_score, -1) >= 7.5', 'DoltHub Growth + Momentum'),
 ('coalesce(dolt_value_score, -1) >= 7.5 AND ret_1m_pctile >= 0.60', 'DoltHub Value Catch-Up'),
 ('coalesce(dolt_value_score, -1) >= 7.5 AND coalesce(dolt_growth_score, -1) >= 7.5', 'DoltHub Balanced V/G'), ('has_dolthub_vgm', 'DoltHub Mixed/Weak VGM'),
 ('true', 'No DoltHub VGM Coverage')]
SUMMARY_AVERAGES = ['quant_factor_score', 'basket_score', 'ret_1m_pct', 'ret_3m_pct', 'ret_6m_pct', 'ret_ytd_pct', 'rsi_14', 'price_vs_sma50_pct', 'price_vs_sma200_pct']
SUMMARY_MEASURES = ['rsi_14', 'price_vs_sma20_pct', 'price_vs_sma50_pct', 'price_vs_sma200_pct', 'volatility_annual_polygon', 'short_pct_float']
THEMES = ['Semiconductors', 'AI Infrastructure', 'Cybersecurity', 'Cloud Software', 'Crypto / Digital Assets', 'Healthcare / Biotech', 'Defense / Aerospace', 'Industrial Automation',
 'Energy Transition', 'Oil & Gas', 'Financials / Credit', 'Consumer / Retail', 'Housing / Real Estate', 'Commodities / Materials']
TREND_POINTS = [[('close > sma_20', 2.0)], [('close > sma_50', 1.5)], [('close > sma_200', 1.5)], [('sma_20 > sma_50', 1.5)], [('sma_50 > sma_200', 1.5)],
 [('close > keltner_upper', 1.0), ('close < keltner_lower', -1.5)], [('price_vs_sma200_pct > 20', 1.0), ('price_vs_sma200_pct < -10', -1.0)]]
TREND_VOL = [('close > sma_50 AND close > sma_200 AND low_vol_pctile >= 0.70', 'Low-Vol Uptrend'), ('price_momentum_score >= 8.0 AND volatility_annual_polygon >= 0.45', 'High-Vol Momentum'),
 ('price_momentum_score <= 3.0 AND volatility_annual_polygon >= 0.45', 'High-Vol Breakdown'),
 ('abs(coalesce(price_vs_sma50_pct, 0)) <= 5 AND rsi_14 BETWEEN 40 AND 60', 'Base Building / Coiled'), ('true', 'Normal Vol/Trend')]
VECTOR_MEASURES = ['ret_1w_pct', 'ret_1m_pct', 'ret_3m_pct', 'ret_6m_pct', 'ret_1y_pct', 'ret_ytd_pct', 'rsi_14']

# laggards
ASSESSMENT = [('production_factor_score > basket_avg_factor_score * 0.9 AND ret_1m_deviation_pct < -10', 'Strong Fundamentals, Weak Price'),
 ('production_factor_score < basket_avg_factor_score * 0.8 AND ret_1m_deviation_pct < -15', 'Weak Fundamentals & Price - Avoid'),
 ('production_factor_score > basket_avg_factor_score * 1.1 AND ret_1m_deviation_pct < -5', 'High Quality Relative Laggard'), ('true', 'Mixed Fundamentals/Price')]
CATALYST = [('rsi_14 < 35 AND ret_1m_deviation_pct < -20', 'Catalyst: RSI Oversold Mean Reversion'),
 ('price_vs_sma200_pct < -20 AND ret_3m_deviation_pct < -15', 'Catalyst: Major Support Level Test'),
 ('ret_1m_deviation_pct < -25 AND basket_avg_ret_1m_pct > 15', 'Catalyst: Relative Strength Reversal'),
 ('production_factor_score > 7.0 AND ret_1m_deviation_pct < -10', 'Catalyst: Fundamental Divergence Correction'), ('true', 'Catalyst: Basket Momentum Normalization')]
CATALYSTS = [("long_thesis_type = 'Oversold mean reversion'", 'RSI and negative basket residual normalize'),
 ("long_thesis_type = 'Factor-quality catch-up'", 'Price catches up to factor score within basket'),
 ("long_thesis_type = 'Liquid large-cap catch-up'", 'Institutional rotation back into liquid laggard'),
 ("long_thesis_type = 'Early recovery from 3M lag'", '1M improvement after 3M underperformance'), ('true', 'Basket dispersion mean reverts')]
DIVERGENCE = [('ret_1m_deviation_pct < -15 AND ret_3m_deviation_pct < -10 AND basket_avg_ret_1m_pct > 10', 'Severe Underperformance vs Strong Basket'),
 ('ret_1m_deviation_pct < -10 AND ret_3m_deviation_pct < -5 AND basket_avg_ret_3m_pct > 15', 'Moderate Underperformance vs Strong Basket'),
 ('ret_1m_deviation_pct > 15 AND ret_3m_deviation_pct > 10', 'Outperforming Basket - Not Laggard'), ('true', 'Normal Variation')]
FLAGS = [('ret_1m_pct - expected_ret_1m_pct <= -20', 'Severe negative regression residual'), ('ret_1m_pct - expected_ret_1m_pct <= -10', 'Moderate negative regression residual'),
 ('ret_1m_z_score <= -1', 'Basket-relative 1M laggard'), ('true', 'Mild laggard / watchlist')]
HORIZONS = [('rsi_14 < 35', '1-4 weeks'), ('abs(regression_residual_1m_pct) >= 15', '1-2 months'), ('true', '2-4 months')]
KEPT_ASSESSMENT = ['Strong Fundamentals, Weak Price', 'High Quality Relative Laggard']
KEPT_DIVERGENCE = ['Severe Underperformance vs Strong Basket', 'Moderate Underperformance vs Strong Basket']
KEPT_REVERSION = ['High Mean Reversion Potential', 'Moderate Mean Reversion Potential']
RATIONALE = [("mean_reversion_regime = 'High Mean Reversion Potential' AND ret_1m_deviation_pct < -20", 'Mean Reversion: Severe Oversold with Positive Divergence'),
 ("mean_reversion_regime = 'Moderate Mean Reversion Potential' AND ret_1m_deviation_pct < -15", 'Mean Reversion: Technical Oversold vs Basket'),
 ("relative_value_assessment = 'High Quality Relative Laggard' AND production_factor_score > 6.0", 'Quality Value: Strong Fundamentals Lagging Basket Momentum'),
 ("relative_value_assessment = 'Strong Fundamentals, Weak Price' AND basket_avg_ret_1m_pct > 10", 'Relative Momentum: Basket Strength with Individual Weakness'),
 ("momentum_trend = 'Recovery Attempt' AND ret_1m_deviation_pct > -5 AND ret_3m_deviation_pct < -10", 'Momentum Inflection: Recent Strength in Persistent Weakness'),
 ('true', 'Relative Value Basket Diversification')]
REVERSION = [('rsi_14 < 50 AND ret_1m_deviation_pct < -20 AND ret_3m_deviation_pct < -15', 'High Mean Reversion Potential'),
 ('rsi_14 < 60 AND ret_1m_deviation_pct < -15 AND ret_3m_deviation_pct < -10', 'Moderate Mean Reversion Potential'),
 ('rsi_14 > 70 AND ret_1m_deviation_pct > 20 AND ret_3m_deviation_pct > 15', 'Overextended - Short Risk'), ('true', 'Neutral')]
RISK = [('volatility_annual_polygon > 0.50', 'High Volatility Risk'), ('market_cap < 1e10', 'Market Cap Risk'), ('rsi_14 > 70', 'Overbought Risk'),
 ('ret_3m_deviation_pct < -25', 'Deep Underperformance Risk'), ('true', 'Moderate Risk')]
RISKS = [('volatility_annual_polygon >= 0.60', 'High volatility / lower sizing'), ('ret_3m_z_score <= -2', 'Possible value trap; deep persistent lag'),
 ('rsi_14 > 70', 'Already overbought despite lag score'), ('short_pct_float >= 10', 'Short-interest squeeze/fragility risk'), ('true', 'Standard basket-relative risk')]
SLOPES = {'ret_3m': 'ret_3m_pct', 'factor_score': 'production_factor_score', 'log_market_cap': 'log_market_cap', 'log_dollar_volume': 'log_dollar_volume', 'rsi': 'rsi_14'}
STATS = {'ret_1m': 'ret_1m_pct',
 'ret_3m': 'ret_3m_pct',
 'rsi': 'rsi_14',
 'factor_score': 'production_factor_score',
 'log_market_cap': 'log_market_cap',
 'log_dollar_volume': 'log_dollar_volume'}
THESES = [('rsi_14 < 35 AND ret_1m_z_score < -1', 'Oversold mean reversion'),
 ('production_factor_score >= basket_avg_factor_score AND ret_1m_pct < expected_ret_1m_pct', 'Factor-quality catch-up'),
 ('size_z_score > 0 AND liquidity_z_score > 0 AND ret_1m_pct < expected_ret_1m_pct', 'Liquid large-cap catch-up'),
 ('ret_3m_z_score < -1 AND ret_1m_z_score > ret_3m_z_score', 'Early recovery from 3M lag'), ('true', 'Relative-value laggard')]
TREND = [('ret_1m_deviation_pct < -10 AND ret_3m_deviation_pct < -5', 'Decelerating Underperformance'),
 ('ret_1m_deviation_pct < -20 AND ret_3m_deviation_pct > -5', 'Recent Momentum Collapse'), ('ret_1m_deviation_pct > -5 AND ret_3m_deviation_pct < -15', 'Recovery Attempt'),
 ('true', 'Stable Underperformance')]
VALUATION = [('price_vs_sma200_pct < basket_avg_price_vs_sma200_pct - 10 AND rsi_14 < basket_avg_rsi_14', 'Deep Value vs Basket'),
 ('price_vs_sma200_pct > basket_avg_price_vs_sma200_pct + 10 AND rsi_14 > basket_avg_rsi_14', 'Overvalued vs Basket'), ('true', 'Fair Value vs Basket')]
Z_NAMES = {'ret_1m': 'ret_1m_z_score',
 'ret_3m': 'ret_3m_z_score',
 'rsi': 'rsi_z_score',
 'factor_score': 'factor_score_z_score',
 'log_market_cap': 'size_z_score',
 'log_dollar_volume': 'liquidity_z_score'}

# keywords and industry codes
ALIASES = {'data centers': 'data center',
 'datacenters': 'data center',
 'ai chips': 'ai chip',
 'semiconductors': 'semiconductor',
 'cyber security': 'cybersecurity',
 'electric vehicles': 'electric vehicle',
 'interest rates': 'interest rate',
 'treasury yields': 'treasury yield',
 'oil prices': 'oil price',
 'bond yields': 'bond yield'}
BASKETS = {'AI Infrastructure': ('\\bai\\b', 'artificial intelligence', 'machine learning', 'gpu', 'data center', 'datacenter', 'accelerator', 'llm', 'generative ai', 'agentic'),
 'Semiconductors': ('semiconductor', 'chip', 'memory', 'dram', 'nand', 'foundry', 'wafer', 'silicon', 'photomask', 'eda', 'fabless'),
 'Cybersecurity': ('cyber', 'ransomware', 'zero.trust', 'threat', 'security', 'identity', 'firewall', 'endpoint'),
 'Cloud Software': ('cloud', 'saas', 'software', 'observability', 'database', 'crm', 'enterprise software', 'platform'),
 'Crypto / Digital Assets': ('crypto', 'bitcoin', 'ethereum', 'blockchain', 'digital asset', 'stablecoin', 'token'),
 'Energy Transition': ('renewable', 'solar', 'wind', 'battery', 'ev', 'electric vehicle', 'charging', 'hydrogen', 'energy transition'),
 'Oil & Gas': ('oil', 'natural gas', 'lng', 'shale', 'drilling', 'pipeline', 'refining', 'opec'),
 'Healthcare / Biotech': ('clinical', 'fda', 'drug', 'therapy', 'biotech', 'pharma', 'medical', 'oncology', 'diabetes', 'glp'),
 'Consumer / Retail': ('retail', 'consumer', 'restaurant', 'e.commerce', 'grocery', 'same.store', 'apparel', 'travel'),
 'Financials / Credit': ('bank', 'credit', 'loan', 'deposit', 'insurance', 'asset management', 'fintech', 'payments', 'mortgage'),
 'Defense / Aerospace': ('defense', 'aerospace', 'missile', 'space', 'satellite', 'army', 'navy', 'air force', 'geopolitics'),
 'Industrial Automation': ('industrial', 'automation', 'robotics', 'manufacturing', 'supply chain', 'logistics', 'equipment'),
 'Housing / Real Estate': ('housing', 'real estate', 'reit', 'construction', 'homebuilder', 'mortgage rate', 'property'),
 'Commodities / Materials': ('copper', 'gold', 'steel', 'aluminum', 'lithium', 'mining', 'chemical', 'materials', 'commodity'),
 'Macro Rates / Inflation': ('inflation', 'treasury', 'bond yield', 'fed', 'interest rate', 'recession', 'tariff', 'cpi', 'macro')}
BLOCKED = ('securities fraud', 'class action', 'class action lawsuit', 'shareholder lawsuit', 'shareholder investigation', 'shareholder rights', 'shareholder class action',
 'merger investigation', 'merger and acquisition', 'm&a transaction', 'm&a', 'securities investigation', 'securities class action', 'securities lawsuit', 'securities litigation',
 'securities claims', 'securities law', 'securities law firm', 'sec violations', 'sec investigation', 'doj investigation', 'doj complaint', 'lead plaintiff',
 'lead plaintiff deadline', 'investor lawsuit', 'investor rights', 'investor losses', 'investor harm', 'false statements', 'false claims', 'false claims act',
 'misleading statements', 'misleading disclosures', 'financial misstatement', 'financial restatement', 'financial misconduct', 'financial misrepresentation', 'financial reporting',
 'fiduciary duty breach', 'fiduciary duty', 'unreconciled cash balance', 'internal controls', 'internal controls weakness', 'material weaknesses', 'illegal kickbacks', 'kickbacks',
 'stock price decline', 'stock decline', 'stock exit', 'securities', 'lawsuit', 'investigation', 'litigation', 'growth stock', 'top stock', 'best stock', 'undervalued',
 'overvalued', 'top pick', 'buy alert', 'stock market', 'wall street', 'investing', 'trading', 'technical analysis', 'breakout', 'pullback', 'support level', 'resistance',
 'bull market', 'bear market', 'correction', 'rally', 'sell-off', 'earnings', 'news', 'acquisition', 'dividend', 'markets', 'merger', 'movers', 'valuation', 'buyback', 'insider',
 'ratings', 'equity', 'small cap', 'penny stocks', 'trading ideas', 'shareholder returns', 'analyst ratings', 'analyst upgrades', 'analyst downgrades', 'price target',
 'financial results', 'earnings reports', 'earnings release', 'quarterly results', 'quarterly earnings', 'quarterly dividend', 'intraday update', 'pre-market outlook',
 'pre-market', 'after hours', 'conference call', 'market growth', 'long ideas', 'revenue growth', 'dividend yield', 'dividend stocks', 'stock repurchase', 'share repurchase',
 'shareholder meeting', 'annual meeting', 'board of directors', 'institutional ownership', 'insider trading', 'insider buying', 'insider selling', 'analyst report',
 'analyst coverage', 'price targets', 'recommendation', 'earnings releases and operating results', 'manda')
SHORT = ('ai', 'ev', '5g', 'ml', 'ar', 'vr', 'mr', 'pc')
SIC_SECTORS = {'01': 'Consumer Staples',
 '02': 'Consumer Staples',
 '07': 'Consumer Staples',
 '08': 'Materials',
 '09': 'Consumer Staples',
 '10': 'Materials',
 '12': 'Energy',
 '13': 'Energy',
 '14': 'Materials',
 '15': 'Industrials',
 '16': 'Industrials',
 '17': 'Industrials',
 '20': 'Consumer Staples',
 '21': 'Consumer Staples',
 '22': 'Consumer Discretionary',
 '23': 'Consumer Discretionary',
 '24': 'Materials',
 '25': 'Consumer Discretionary',
 '26': 'Materials',
 '27': 'Communication Services',
 '28': 'Healthcare',
 '29': 'Energy',
 '30': 'Materials',
 '31': 'Consumer Discretionary',
 '32': 'Materials',
 '33': 'Materials',
 '34': 'Industrials',
 '35': 'Information Technology',
 '36': 'Information Technology',
 '37': 'Industrials',
 '38': 'Healthcare',
 '39': 'Consumer Discretionary',
 '40': 'Industrials',
 '41': 'Industrials',
 '42': 'Industrials',
 '44': 'Industrials',
 '45': 'Industrials',
 '47': 'Industrials',
 '48': 'Communication Services',
 '49': 'Utilities',
 '50': 'Industrials',
 '51': 'Consumer Staples',
 '52': 'Consumer Discretionary',
 '53': 'Consumer Discretionary',
 '54': 'Consumer Staples',
 '55': 'Consumer Discretionary',
 '56': 'Consumer Discretionary',
 '57': 'Consumer Discretionary',
 '58': 'Consumer Discretionary',
 '59': 'Consumer Discretionary',
 '60': 'Financials',
 '61': 'Financials',
 '62': 'Financials',
 '63': 'Financials',
 '64': 'Financials',
 '65': 'Real Estate',
 '67': 'Financials',
 '70': 'Consumer Discretionary',
 '72': 'Consumer Discretionary',
 '73': 'Information Technology',
 '75': 'Consumer Discretionary',
 '78': 'Communication Services',
 '79': 'Communication Services',
 '80': 'Healthcare',
 '81': 'Industrials',
 '82': 'Consumer Discretionary',
 '83': 'Healthcare',
 '87': 'Industrials'}
