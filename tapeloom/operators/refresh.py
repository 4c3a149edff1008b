"""The refresh from bars to baskets in one call.

Roll-up, official bars, newest indicators, enriched snapshot, factor views and
gates follow each other as a daily job runs them. Each step publishes its table
in the home folder and the next reads it from there, so a job that dies is
started again without harm: merges that are in the table add nothing, and a
published table is complete or not there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks import commits as K
from ..sinks.tables import publish, published
from . import audit as A
from . import bars as B
from . import factors as X
from . import indicators as I
from . import merge as M
from . import snapshot as S
from . import views as V

#: What the factor views read of the snapshot, and the kind of what a snapshot may lack.
RICH = {
    "exchange": "string", "market_cap": "double", "holding_pct_value": "double", "close": "double", "volume": "double", "avg_vol_20": "double", "sma_20": "double", "sma_50": "double", "sma_200": "double",
    "ema_20": "double", "rsi_14": "double", "atr_14": "double", "keltner_upper": "double", "keltner_lower": "double", "dollar_volume": "double", "dollar_volume_20d_polygon": "double",
    "price_vs_sma20_pct": "double", "price_vs_sma50_pct": "double", "price_vs_sma200_pct": "double", "volume_vs_20d": "double", "volatility_annual_polygon": "double", "short_pct_float": "double",
    "value_grade": "string", "growth_grade": "string", "momentum_grade": "string", "keyword_factor_baskets": "string", "primary_keyword_factor_score": "double",
}
LOOKBACK = 260


def rich(snapshot: DataFrame, classes: DataFrame) -> DataFrame:
    """The snapshot as the factor views read it, with the sector and industry of the classification cache."""
    known = classes.select("ticker", F.col("sector").alias("raw_sector"), F.col("industry").alias("_industry"))
    rows = snapshot.join(known, "ticker", "left")
    name = F.coalesce(*(c for c in ("name", "holding_name") if c in snapshot.columns))
    given = [(F.col(c) if c in snapshot.columns else F.lit(None)).cast(kind).alias(c) for c, kind in RICH.items()]
    return rows.select("ticker", "as_of_date", name.alias("company_name"), "raw_sector", F.col("_industry").alias("industry"), *given)


def _indicators(bars: DataFrame) -> DataFrame:
    none = {"anchored_vwap": F.lit(None).cast("double"), "vwap_anchor": F.lit("")}
    return I.latest_daily(bars, LOOKBACK).withColumns(none)


def refresh(spark: SparkSession, home: str, hourly: DataFrame, official: DataFrame, held: DataFrame, sides: list[DataFrame], classes: DataFrame, as_of: str, ideas: Callable[[DataFrame], DataFrame] | None = None) -> dict[str, dict[str, int]]:
    """Bring the tables in ``home`` up to date; the counts of the two merges.

    ``home/daily`` must be a table of daily bars. ``hourly`` bars become
    provisional days where it has none, ``official`` ones replace those. The
    newest indicators come from each ticker's last bars, the snapshot from
    ``held`` with prices, averages, indicators and ``sides`` (one row a ticker
    each), the factor tables from the snapshot and ``classes``. Published:
    indicators, snapshot, universe, scores, membership and gates.
    """
    daily = f"{home}/daily"
    rolled = B.daily_from_hourly(hourly)
    counts = {"provisional": K.merge(daily, rolled.select(*B.BAR), B.materialise)}
    counts["official"] = K.merge(daily, official, M.provisional)
    step = lambda name, rows: (publish(rows, f"{home}/{name}"), published(spark, f"{home}/{name}"))[1]

    recent = step("recent", K.newest(spark, daily, LOOKBACK))  # read once for indicators, averages, prices and returns
    stored = step("indicators", _indicators(recent))
    taken = [S.prices(recent), S.averages(I.standing(recent, V.BAR)), S.recursive(stored)]
    snapshot = step("snapshot", S.enriched(as_of, held, [*taken, *sides]))
    universe = step("universe", X.sector_universe(rich(snapshot, classes)))
    scored = step("scores", X.production_scores(X.scores(X.features(universe, recent))))
    step("membership", X.membership(scored).select("ticker", "basket_type", "basket_name", "quant_factor_quintile", "basket_score", "quant_factor_score"))
    step("gates", A.factor_gates(universe, scored, ideas(scored) if ideas else scored.where("production_factor_quintile = 1")))
    return counts
