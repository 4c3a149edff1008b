"""The cache of sectors and industries: where rows come from, which are due, and what is filled in at last."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.ranking import cut
from . import merge as M

CACHE = {
    "ticker": "string", "sector": "string", "industry": "string", "sub_industry": "string", "gics_sector": "string", "gics_industry_group": "string",
    "gics_industry": "string", "gics_sub_industry": "string", "sic_code": "string", "sic_description": "string", "country": "string", "source": "string",
    "source_priority": "int", "confidence": "double", "raw_json": "string", "enriched_at": "timestamp", "stale_after": "timestamp", "error": "string",
}
FRESH_DAYS, NEVER, NO_DATA = 120, "2099-01-01 00:00:00", "No Data"
# Priority and confidence of the sources of a sector map; others have the last.
MAP_SOURCES = {"sp500": (20, 0.98), "sec-sic": (30, 0.70), None: (40, 0.80)}


def _rows(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Cache rows with ``columns``; all else is null, and the row as it came goes to ``raw_json``."""
    raw = F.to_json(F.struct(*rows.columns))
    given = columns | ({} if "raw_json" in columns else {"raw_json": raw})
    return rows.select(*(given.get(c, F.lit(None)).cast(t).alias(c) for c, t in CACHE.items()))


def from_snapshot(snapshot: DataFrame, now: Column) -> DataFrame:
    """Rows of ``snapshot(ticker, yf_sector, yf_industry, yf_country, sic_code, sic_description)`` that have a sector or an industry."""
    c = lambda x: X.clean(F.col(x))
    rows = snapshot.where(X.symbol(F.col("ticker")).isNotNull() & F.coalesce(c("yf_sector"), c("yf_industry")).isNotNull())
    return _rows(rows, {
        "ticker": X.symbol(F.col("ticker")), "sector": c("yf_sector"), "industry": c("yf_industry"), "gics_sector": c("yf_sector"), "gics_industry": c("yf_industry"), "sic_code": c("sic_code"),
        "sic_description": c("sic_description"), "country": c("yf_country"), "source": F.lit("warehouse_yfinance_snapshot"), "source_priority": F.lit(10), "confidence": F.lit(0.85),
        "enriched_at": now, "stale_after": F.date_add(now, FRESH_DAYS),
    })


def from_sector_map(mapped: DataFrame, now: Column) -> DataFrame:
    """Rows of ``mapped(ticker, sector, industry, source)``; the source decides how far they are believed."""
    source = F.coalesce("source", F.lit("sector_map"))
    pick = lambda k: F.when(source == "sp500", MAP_SOURCES["sp500"][k]).when(source == "sec-sic", MAP_SOURCES["sec-sic"][k]).otherwise(MAP_SOURCES[None][k])
    sector, industry = F.col("sector"), F.col("industry")
    return _rows(mapped, {
        "ticker": F.col("ticker"), "sector": sector, "industry": industry, "gics_sector": sector, "gics_industry": industry, "source": F.concat(F.lit("sector_map:"), source),
        "source_priority": pick(0), "confidence": pick(1), "enriched_at": now, "stale_after": F.date_add(now, FRESH_DAYS),
    })


def from_codes(details: DataFrame, now: Column) -> DataFrame:
    """Rows of ``details(ticker, sic_code, sic_description)`` by industry code; without a known code the description alone counts less."""
    code, words = X.clean(F.col("sic_code")), X.clean(F.col("sic_description"))
    sector = X.sic_sector(code)
    rows = details.where(X.symbol(F.col("ticker")).isNotNull() & F.coalesce(sector, words).isNotNull())
    return _rows(rows, {
        "ticker": X.symbol(F.col("ticker")), "sector": sector, "industry": words, "gics_sector": sector, "sic_code": code, "sic_description": words, "source": F.lit("polygon_sic_fallback"),
        "source_priority": F.lit(90), "confidence": F.when(sector.isNotNull(), 0.45).otherwise(0.35), "enriched_at": now, "stale_after": F.date_add(now, FRESH_DAYS),
    })


def bootstrap(cache: DataFrame, snapshot: DataFrame, mapped: DataFrame, details: DataFrame, now: Column) -> DataFrame:
    """The cache after the three sources have been merged into it, one after the other."""
    for stage in (from_snapshot(snapshot, now), from_sector_map(mapped, now), from_codes(details, now)):
        cache = cut(M.priority(cache, stage))  # each merge reads the cache twice
    return cache


def unresolved() -> Column:
    """Neither sector nor industry."""
    return (F.coalesce("sector", F.lit("")) == "") & (F.coalesce("industry", F.lit("")) == "")


def due(universe: DataFrame, cache: DataFrame, now: Column, stale_days: int) -> DataFrame:
    """Tickers without a row, unresolved, stale, or with an error older than ``stale_days``."""
    rows = universe.select("ticker").where("ticker IS NOT NULL").distinct().join(cache.withColumn("_has", F.lit(True)), "ticker", "left")
    failed = (F.coalesce("error", F.lit("")) != "") & (F.col("enriched_at").isNull() | (F.col("enriched_at") < F.date_sub(now, stale_days)))
    return rows.where(F.col("_has").isNull() | unresolved() | F.coalesce(F.col("stale_after") < now, F.lit(False)) | failed).select("ticker")


def coverage(cache: DataFrame) -> DataFrame:
    filled = lambda c: F.count_if(F.coalesce(F.col(c), F.lit("")) != "")
    return cache.agg(
        F.count("*").alias("n_rows"), filled("sector").alias("with_sector"), filled("industry").alias("with_industry"), filled("error").alias("with_error"),
        F.count_distinct("source").alias("sources"), F.count_if(unresolved()).alias("unresolved"),
    )


def by_source(cache: DataFrame) -> DataFrame:
    filled = lambda c: F.count_if(F.coalesce(F.col(c), F.lit("")) != "")
    return cache.groupBy("source").agg(F.count("*").alias("n_rows"), filled("sector").alias("with_sector"), filled("industry").alias("with_industry"))


def registry_fallback(snapshot: DataFrame, cache: DataFrame, registry: DataFrame, now: Column) -> DataFrame:
    """The cache with every unresolved ticker of ``snapshot(ticker, holding_name)`` settled for good.

    ``registry(no, ticker, title, sic_code, sic_description)`` is matched by
    ticker, else by the letters and digits of the title (of equal ones the last
    counts). What has no match or no code there is marked as without data.
    """
    left = snapshot.join(cache.select("ticker", "sector", "industry"), "ticker", "left").where(unresolved()).select("ticker", "holding_name")
    company = F.struct("no", "sic_code", "sic_description")
    by_ticker = registry.groupBy(F.upper("ticker").alias("_t")).agg(F.max_by(company, "no").alias("_a"))
    by_title = registry.groupBy(X.title(F.col("title")).alias("_n")).agg(F.max_by(company, "no").alias("_b"))
    rows = left.join(by_ticker, F.upper("ticker") == F.col("_t"), "left").join(by_title, X.title(F.col("holding_name")) == F.col("_n"), "left")
    method = F.when(F.col("_a").isNotNull(), "ticker_exact").when(F.col("_b").isNotNull(), "title_exact")
    rows = rows.select("ticker", "holding_name", method.alias("match_method"), F.coalesce("_a", "_b").alias("match"))
    code, words = X.clean(F.col("match.sic_code")), X.clean(F.col("match.sic_description"))
    sector = X.sic_sector(code)
    found = F.coalesce(sector, words).isNotNull()
    error = F.when(F.col("match_method").isNull(), "FINAL_NO_SEC_MATCH_OR_YFINANCE_DATA").otherwise("FINAL_NO_RELIABLE_SEC_OR_YFINANCE_DATA")
    pick = lambda a, b: F.when(found, a).otherwise(b)
    none = F.lit(None).cast("string")
    stage = _rows(rows, {
        "ticker": F.col("ticker"), "sector": pick(sector, F.lit(NO_DATA)), "industry": pick(words, F.lit(NO_DATA)), "gics_sector": pick(sector, none), "sic_code": pick(code, none), "sic_description": pick(words, none),
        "source": pick(F.lit("sec_submissions_sic_fallback"), F.lit("sec_no_reliable_data_final")), "source_priority": pick(F.lit(60), F.lit(1000)), "confidence": pick(F.lit(0.55), F.lit(0.0)),
        "enriched_at": now, "stale_after": F.lit(NEVER), "error": pick(none, error),
    })
    return M.fill_only(cache, stage)
