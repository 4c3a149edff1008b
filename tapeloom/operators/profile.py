"""Intraday volume profiles and best prices."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranking import order_statistics

MILESTONES = [570, 630, 720, 780, 840, 900, 930]  # fixed values: minutes of the day of the reported times
ET_OFFSET = 4 * 60


def label(minute):
    """HH:MM of a minute of the day."""
    return F.format_string("%02d:%02d", F.floor(minute / 60).cast("int"), (minute % 60).cast("int"))


def cumulative(bars: DataFrame) -> DataFrame:
    """Running volume of each (ticker, date) by minute of the day, over ``bars(ticker, minute_ts, volume)``."""
    ts = F.timestamp_millis("minute_ts")
    rows = bars.select("ticker", F.to_date(ts).alias("date"), (F.hour(ts) * 60 + F.minute(ts)).alias("minute"), "volume")
    w = Window.partitionBy("ticker", "date").orderBy("minute").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("cum_vol", F.sum("volume").over(w))


def profile(bars: DataFrame, bin_minutes: int = 5) -> DataFrame:
    """Distribution of the running volume in each bin over all days; bins with fewer than 3 values, or before midnight ET, drop.

    Volumes are whole shares, so the deviation is taken from sums that are exact in any order.
    """
    bin_ = F.expr(f"minute div {bin_minutes} * {bin_minutes}").cast("int")
    running = cumulative(bars).select("ticker", bin_.alias("bin"), "cum_vol").where(F.col("bin") >= ET_OFFSET)
    grouped = running.groupBy("ticker", "bin").agg(
        F.count("*").alias("count"), F.avg("cum_vol").alias("_avg"), (F.sqrt(F.greatest(F.count("*") * F.sum(F.col("cum_vol") * F.col("cum_vol")) - F.sum("cum_vol") * F.sum("cum_vol"), F.lit(0.0))) / F.count("*")).alias("_std")
    )
    quarter = lambda k: F.expr(f"{k} * _n div 4 + 1")
    grouped = grouped.join(order_statistics(running, ["ticker", "bin"], "cum_vol", {"_p25": quarter(1), "_p75": quarter(3)}), ["ticker", "bin"])
    avg, std = F.col("_avg"), F.col("_std")
    out = grouped.where(F.col("count") >= 3)
    whole = lambda x: F.bround(x).cast("long")
    return out.select(
        "ticker", (F.col("bin") - ET_OFFSET).alias("et_minute"), whole(avg).alias("avg"), whole(std).alias("std"),
        F.bround(F.round(F.when(avg > 0, std / avg * 100).otherwise(0.0), 9), 1).alias("cv_pct"), whole(F.col("_p25")).alias("p25"), whole(F.col("_p75")).alias("p75"), "count",
        whole(avg * 1.5).alias("above_15x"), whole(avg * 0.5).alias("below_05x"),
    )


def milestones(profiled: DataFrame) -> DataFrame:
    return profiled.where(F.col("et_minute").isin(MILESTONES)).withColumn("time", label(F.col("et_minute")))


def signal(profiled: DataFrame, today: DataFrame) -> DataFrame:
    """Today's running volume at the milestones against the profile; a minute without a bar counts as 0."""
    now = cumulative(today).groupBy("ticker", (F.col("minute") - ET_OFFSET).alias("et_minute")).agg(F.max("cum_vol").alias("_now"))
    rows = milestones(profiled).join(now, ["ticker", "et_minute"], "left").withColumn("_now", F.coalesce("_now", F.lit(0.0)))
    ratio = F.when(F.col("avg") > 0, F.col("_now") / F.col("avg")).otherwise(0.0)
    state = F.when(ratio > 1.5, "above").when(ratio < 0.5, "below").otherwise("normal")
    return rows.select("ticker", "time", F.bround("_now").cast("long").alias("today_cum_vol"), F.col("avg").alias("avg_cum_vol"), F.bround(ratio, 2).alias("ratio"), state.alias("signal"))


def best_price(snapshots: DataFrame) -> DataFrame:
    """The first positive price of: last trade, minute close, day close, previous close; with where and when it is from."""
    t = F.col("ticker")
    tried = [("snapshot.lastTrade.p", t["lastTrade"]["p"], t["lastTrade"]["t"]), ("snapshot.min.c", t["min"]["c"], t["min"]["t"]), ("snapshot.day.c", t["day"]["c"], None), ("snapshot.prevDay.c", t["prevDay"]["c"], None)]
    price = source = at = None
    for name, value, when in tried:
        ok, ts = value > 0, t["updated"] if when is None else F.coalesce(F.nullif(when, F.lit(0)), t["updated"])
        price = F.when(ok, value) if price is None else price.when(ok, value)
        source = F.when(ok, name) if source is None else source.when(ok, name)
        at = F.when(ok, ts) if at is None else at.when(ok, ts)
    usable = F.coalesce(F.col("status") != "ERROR", F.lit(True))
    return snapshots.select(F.upper(t["ticker"]).alias("symbol"), F.when(usable, price).alias("price"), F.when(usable, source).alias("source"), F.when(usable, at.otherwise(t["updated"])).alias("timestamp"), F.when(usable & price.isNotNull(), "OK").otherwise("ERROR").alias("status"))
