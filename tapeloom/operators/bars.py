"""Roll-ups between bar grains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import DAY, HOUR
from .merge import utc_date

KEYS = ["ticker", "timestamp"]
#: What a roll-up gives a bar; counts and bounds of its source stay out of the table.
BAR = (*KEYS, "open", "high", "low", "close", "volume", "vwap")


def rollup(bars: DataFrame, bucket: Column, least: int = 0) -> DataFrame:
    """OHLCV of each (ticker, bucket): first open, last close and a volume-weighted vwap; buckets with fewer bars than ``least`` go.

    First and last are by time and keep nulls. A bar without vwap counts with
    its close; without any volume the vwap is the last close.
    """
    volume = F.sum("volume")
    last = F.max_by("close", "timestamp")
    out = bars.groupBy("ticker", bucket.alias("_bucket")).agg(
        F.min_by("open", "timestamp").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), last.alias("close"), volume.alias("volume"),
        F.when(volume > 0, F.sum(F.col("volume") * F.coalesce("vwap", "close")) / volume).otherwise(last).alias("vwap"),
        F.count("*").alias("bar_count"), F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"),
    )
    out = out.withColumnRenamed("_bucket", "timestamp")
    return out.where(F.col("bar_count") >= least) if least else out


def daily_from_hourly(hourly: DataFrame, least: int = 6) -> DataFrame:
    """Bars of UTC days with ``least`` hours or more."""
    return rollup(hourly, F.expr(f"timestamp div {DAY} * {DAY}"), least)


def weekly_from_daily(daily: DataFrame, least: int = 3) -> DataFrame:
    """Bars of Monday to Friday, keyed by the bar time moved to the following Sunday; the time of day stays in the key."""
    dow = F.dayofweek(F.timestamp_millis("timestamp")) - 1
    days = daily.withColumn("_dow", dow).where("_dow BETWEEN 1 AND 5")
    return rollup(days, F.col("timestamp") - (F.col("_dow") - 1) * F.lit(DAY).cast("long") + 6 * DAY, least)


def four_hours(hourly: DataFrame) -> DataFrame:
    """Floored 4-hour bars; first and last skip nulls, no vwap."""
    first = F.expr("min_by(open, timestamp) FILTER (WHERE open IS NOT NULL)")
    last = F.expr("max_by(close, timestamp) FILTER (WHERE close IS NOT NULL)")
    bucket = F.expr(f"timestamp div {4 * HOUR} * {4 * HOUR}")
    out = hourly.groupBy("ticker", bucket.alias("_bucket")).agg(first.alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), last.alias("close"), F.sum("volume").alias("volume"))
    return out.withColumnRenamed("_bucket", "timestamp").select("ticker", "timestamp", "open", "high", "low", "close", "volume")


def gap_report(source: DataFrame, derived: DataFrame, days: int | None = 30) -> DataFrame:
    """Tickers of ``source``, however old their bars, without a derived bar in the last ``days`` before the newest derived one (None: without any)."""
    if days is not None:
        newest = derived.agg(F.max("timestamp").alias("_newest"))
        derived = derived.crossJoin(F.broadcast(newest)).where(F.col("timestamp") > F.col("_newest") - days * DAY)
    have = derived.select("ticker").distinct()
    return source.groupBy("ticker").agg(F.count("*").alias("bars"), F.max("timestamp").alias("last_ts")).join(have, "ticker", "left_anti")


def absent(target: DataFrame, rolled: DataFrame) -> DataFrame:
    """Rolled-up bars of a ticker and UTC date that the target has no bar of, whatever its time of day."""
    have = target.select("ticker", utc_date().alias("_d"))
    return rolled.withColumn("_d", utc_date()).join(have, ["ticker", "_d"], "left_anti").select(*rolled.columns)


def materialise(target: DataFrame, rolled: DataFrame) -> DataFrame:
    """The target with provisional bars for the dates it lacks: without a transaction count, like every column that a roll-up does not give; its own bars stay as they are."""
    new = absent(target, rolled)
    given = [F.col(c) if c in BAR and c in rolled.columns else F.lit(None).cast(target.schema[c].dataType).alias(c) for c in target.columns]
    return target.unionByName(new.select(*given))


def dry_run(target: DataFrame, rolled: DataFrame, sample: int = 5) -> DataFrame:
    """The newest ``sample`` bars that ``materialise`` would insert, and beside each how many there are."""
    new = absent(target, rolled)
    total = new.agg(F.count("*").alias("would_insert"))
    return new.orderBy(F.desc("timestamp"), "ticker").limit(sample).join(F.broadcast(total), F.lit(True))  # one row
