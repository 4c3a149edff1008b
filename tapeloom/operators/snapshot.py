"""The enriched snapshot: one row for each ticker of the universe, whatever is known about it beside it.

The universe is joined from the left with nine relations that have one row a
ticker, so a ticker that is missing anywhere keeps its row with nulls there.
Spark broadcasts those sides by their size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.ranking import rank_from_top
from . import keywords as K
from . import views as V
from .merge import first_per, utc_date

#: Columns of the fundamentals and of the calendar that are numbers, whole numbers, or text.
FUNDAMENTALS = {
    "sector": "text", "industry": "text", "country": "text", "forward_pe": "float", "trailing_pe": "float", "peg_ratio": "float", "beta": "float", "book_value": "float",
    "price_to_book": "float", "dividend_yield": "float", "earnings_growth": "float",
}
CALENDAR = {
    "rank": "text", "value_grade": "text", "growth_grade": "text", "momentum_grade": "text", "vgm_grade": "text", "eps_consensus": "float", "eps_analyst_count": "int", "eps_high": "float", "eps_low": "float",
    "eps_year_ago": "float", "eps_yoy_growth": "float", "revenue_consensus": "float", "rev_analyst_count": "int", "rev_year_ago": "float", "rev_yoy_growth": "float", "eps_beat_count": "int",
    "eps_miss_count": "int", "eps_periods": "int", "eps_beat_rate": "float", "eps_last_surprise": "float",
}
_CAST = {"text": lambda x: x.cast("string"), "float": X.to_float, "int": X.to_int}


def _coerced(rows: DataFrame, kinds: dict[str, str], prefix: str = "") -> list:
    """The columns that ``rows`` has of ``kinds``, in their kinds; the others are null."""
    as_null = {"text": "string", "float": "double", "int": "bigint"}
    return [(_CAST[k](F.col(c)) if c in rows.columns else F.lit(None).cast(as_null[k])).alias(prefix + c) for c, k in kinds.items()]


def universe(holdings: DataFrame) -> DataFrame:
    """The first row of each ticker in the file's order, from ``holdings(ordinal, ticker, cusip, name, valUSD, pctVal)``."""
    rows = holdings.select("ordinal", X.symbol(F.col("ticker")).alias("ticker"), "cusip", F.col("name").alias("holding_name"), X.to_float(F.col("valUSD")).alias("holding_value_usd"), X.to_float(F.col("pctVal")).alias("holding_pct_value"))
    return first_per(rows.where("ticker IS NOT NULL"), ["ticker"], F.col("ordinal")).drop("ordinal")


def fundamentals(rows: DataFrame) -> DataFrame:
    """The first row of each ticker, its columns under ``yf_``."""
    out = rows.select("ordinal", X.symbol(F.col("ticker")).alias("ticker"), *_coerced(rows, FUNDAMENTALS, "yf_")).where("ticker IS NOT NULL")
    return first_per(out, ["ticker"], F.col("ordinal")).drop("ordinal")


def calendar(rows: DataFrame) -> DataFrame:
    """The row with the earliest earnings date of each ticker."""
    out = rows.select(
        "ordinal", X.symbol(F.col("ticker")).alias("ticker"), F.col("earnings_date").alias("next_earnings_date"), F.col("earnings_when"),
        F.coalesce(F.col("is_t1"), F.lit(False)).alias("earnings_is_t1"), *_coerced(rows, CALENDAR),
    )
    return first_per(out.where("ticker IS NOT NULL"), ["ticker"], F.col("next_earnings_date").asc_nulls_last(), F.col("ordinal")).drop("ordinal")


def prices(bars: DataFrame) -> DataFrame:
    """Every ticker's last bar."""
    rows = V.latest(bars.select("ticker", "timestamp", "open", "high", "low", "close", "volume", "vwap", "transactions"))
    return rows.withColumn("price_date", utc_date()).withColumnRenamed("timestamp", "price_timestamp")


def averages(view: DataFrame) -> DataFrame:
    """Every ticker's last row of the daily view."""
    rows = V.latest(view.select("ticker", "timestamp", "sma_20", "sma_50", "sma_200", "avg_vol_20", F.col("volume_spike").alias("sql_volume_spike")))
    return rows.withColumn("sql_indicator_date", utc_date()).drop("timestamp")


def recursive(stored: DataFrame) -> DataFrame:
    """Every ticker's last stored daily indicators."""
    keep = ["ema_20", "rsi_14", "atr_14", "keltner_middle", "keltner_upper", "keltner_lower", "anchored_vwap", "vwap_anchor"]
    rows = V.latest(stored.where("timeframe = 'daily'").select("ticker", "timestamp", *keep, F.col("volume_spike").alias("recursive_volume_spike")))
    return rows.withColumn("recursive_indicator_date", utc_date()).drop("timestamp")


def factors(members: DataFrame, most: int = 5) -> DataFrame:
    """The best baskets of each ticker on the newest date: their names in order, and the first one's score and keywords."""
    ranked = K.top(K.latest_partition(members), most)
    first = F.col("rn") == 1
    return ranked.groupBy("ticker").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rn", "basket_name"))), lambda x: x["basket_name"]), ", ").alias("keyword_factor_baskets"),
        F.max(F.when(first, F.col("basket_name"))).alias("primary_keyword_factor"), F.max(F.when(first, F.col("score"))).alias("primary_keyword_factor_score"),
        F.max(F.when(first, F.col("matched_keywords_json"))).alias("primary_keyword_factor_keywords"),
    )


def enriched(as_of: str, held: DataFrame, others: list[DataFrame]) -> DataFrame:
    """The snapshot: ``held`` from the left with ``others``, each with one row a ticker, and what follows from their columns."""
    rows = held
    for other in others:
        rows = rows.join(other, "ticker", "left")
    over = lambda k: (F.col("close") / F.nullif(f"sma_{k}", F.lit(0.0)) - 1.0) * 100.0
    rows = rows.withColumns({
        "as_of_date": F.lit(as_of).cast("date"), "dollar_volume": F.col("close") * F.col("volume"),
        **{f"price_vs_sma{k}_pct": over(k) for k in (20, 50, 200)}, "volume_vs_20d": F.col("volume") / F.nullif("avg_vol_20", F.lit(0.0)),
        "has_upcoming_earnings": F.col("next_earnings_date").isNotNull(), "has_polygon_keywords": F.coalesce("polygon_keyword_count", F.lit(0)) > 0,
    })
    return rank_from_top(rows, "market_cap", "market_cap_rank")


def statistics(snapshot: DataFrame) -> DataFrame:
    """One row about a run: how many rows have a price, indicators, a calendar row, keywords."""
    has = lambda c: F.count(F.col(c))
    return snapshot.agg(
        F.max("as_of_date").alias("as_of_date"), F.count("*").alias("n_rows"), has("close").alias("with_price"), has("market_cap").alias("with_details"), has("sma_20").alias("with_sma"),
        has("rsi_14").alias("with_rsi"), has("yf_sector").alias("with_fundamentals"), F.count_if("has_upcoming_earnings").alias("with_earnings"), F.count_if("has_polygon_keywords").alias("with_keywords"),
        has("primary_keyword_factor").alias("with_factors"),
    )
