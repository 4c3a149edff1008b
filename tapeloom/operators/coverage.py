"""Work lists: what is missing, behind, or stale."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import HOUR


def _year(column: str = "timestamp"):
    return F.year(F.timestamp_millis(column))


def incomplete_years(daily: DataFrame, hourly: DataFrame, year: int, month: int = 11, first_year: int = 2021) -> DataFrame:
    """Past years with daily bars in which hourly bars do not reach ``month``; tickers without any hourly bar have year null."""
    past = daily.select("ticker", _year().alias("yr")).where(F.col("yr").between(first_year, year - 1)).distinct()
    reached = hourly.groupBy("ticker", _year().alias("yr")).agg(F.month(F.timestamp_millis(F.max("timestamp"))).alias("last_month"))
    short = past.join(reached, ["ticker", "yr"], "left").select("ticker", "yr", F.coalesce("last_month", F.lit(0)).alias("last_month")).where(F.col("last_month") < month)
    none = daily.select("ticker").distinct().join(hourly.select("ticker"), "ticker", "left_anti")
    return short.unionByName(none.select("ticker", F.lit(None).cast("int").alias("yr"), F.lit(0).alias("last_month")))


def gaps(daily: DataFrame, hourly: DataFrame, now_ms: int, gap_hours: int = 1, stale_hours: int = 24) -> DataFrame:
    """Tickers whose daily bars run ahead of their hourly ones, or whose hourly bars are old, with the date to start from."""
    d = daily.groupBy("ticker").agg(F.max("timestamp").alias("max_daily"))
    h = hourly.groupBy("ticker").agg(F.max("timestamp").alias("max_hourly"))
    both = h.join(d, "ticker", "left").select("ticker", F.coalesce("max_daily", F.lit(0)).alias("max_daily"), "max_hourly")
    ahead = F.col("max_daily") > F.col("max_hourly") + gap_hours * HOUR
    old = F.col("max_hourly") < now_ms - stale_hours * HOUR
    reason = F.when(ahead, "gap").when(old, "stale")
    return both.withColumn("reason", reason).where("reason IS NOT NULL").withColumn("start_date", F.to_date(F.timestamp_millis("max_hourly")))


def backfill_ranges(tickers: DataFrame, gap_rows: DataFrame, today: str, first: str = "2021-06-01") -> DataFrame:
    """One range per ticker and calendar year up to today; tickers with a gap get the gap alone."""
    day = F.lit(today).cast("date")
    start = F.lit(first).cast("date")
    rows = tickers.join(gap_rows.select("ticker", "start_date"), "ticker", "left")
    recent = rows.where("start_date IS NOT NULL").where(F.col("start_date") < day).select("ticker", F.col("start_date").alias("range_start"), day.alias("range_end"))
    years = rows.where("start_date IS NULL").withColumn("y", F.explode(F.sequence(F.year(start), F.year(day))))
    full = years.select("ticker", F.greatest(start, F.make_date("y", F.lit(1), F.lit(1))).alias("range_start"), F.least(day, F.make_date("y", F.lit(12), F.lit(31))).alias("range_end"))
    return recent.unionByName(full.where("range_start < range_end"))


def reference_stale(universe: DataFrame, details: DataFrame, now_ms: int, days: int = 30) -> DataFrame:
    """Tickers without a reference row, or with one older than ``days``."""
    rows = universe.join(details.select("ticker", "last_updated"), "ticker", "left")
    state = F.when(F.col("last_updated").isNull(), "missing").when(F.col("last_updated") < now_ms - days * 24 * HOUR, "stale")
    return rows.withColumn("state", state).where("state IS NOT NULL").select("ticker", "state")


def completeness(daily: DataFrame, hourly: DataFrame, per_day: int = 7) -> DataFrame:
    """Hourly bars relative to ``per_day`` for each daily bar."""
    d = daily.groupBy("ticker").agg(F.count("*").alias("daily_bars"))
    h = hourly.groupBy("ticker").agg(F.count("*").alias("hourly_bars"))
    out = d.join(h, "ticker", "left").select("ticker", "daily_bars", F.coalesce("hourly_bars", F.lit(0)).alias("hourly_bars"))
    return out.withColumn("ratio", F.col("hourly_bars") / (F.col("daily_bars") * per_day))
