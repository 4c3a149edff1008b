"""Always-current indicator views over bars: built-in windows with partial frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import HOUR

BAR = ["ticker", "timestamp", "open", "high", "low", "close", "volume"]


def by_time(low: int | None = None, high: int = 0):
    w = Window.partitionBy("ticker").orderBy("timestamp")
    return w if low is None else w.rowsBetween(low, high)


def moving(column: str, rows: int, full: bool = False) -> Column:
    """Mean of the last ``rows`` bars; with ``full`` null until there are that many values."""
    w = by_time(1 - rows)
    mean = F.avg(column).over(w)
    return F.when(F.count(column).over(w) == rows, mean) if full else mean


def spread(column: str, rows: int, full: bool = False) -> Column:
    """Sample standard deviation of the last ``rows`` bars."""
    w = by_time(1 - rows)
    std = F.stddev_samp(column).over(w)
    return F.when(F.count(column).over(w) == rows, std) if full else std


def with_averages(bars: DataFrame, full: bool = False) -> DataFrame:
    return bars.withColumns({f"sma_{k}": moving("close", k, full) for k in (20, 50, 200)})


def daily(bars: DataFrame) -> DataFrame:
    """Moving averages, average volume, and a spike flag: over three times the mean of up to 20 bars before."""
    before = F.avg("volume").over(by_time(-20, -1))
    spike = F.coalesce((before > 0) & (F.col("volume") > before * 3.0), F.lit(False))
    return with_averages(bars.select(*BAR)).withColumn("avg_vol_20", moving("volume", 20)).withColumn("volume_spike", spike)


def hourly(bars: DataFrame) -> DataFrame:
    return with_averages(bars.select(*BAR))


def four_hours_rounded(hourly: DataFrame) -> DataFrame:
    """4-hour bars around 4-hour marks: the bucket rounds half to even, so buckets hold 5 and 3 hours in turn."""
    bucket = F.bround(F.col("timestamp") / (4 * HOUR)).cast("long") * (4 * HOUR)
    bars = hourly.groupBy("ticker", bucket.alias("_bucket")).agg(
        F.min_by("open", "timestamp").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "timestamp").alias("close"), F.sum("volume").alias("volume")
    )
    return with_averages(bars.withColumnRenamed("_bucket", "timestamp").select(*BAR))


def pivots(bars: DataFrame) -> DataFrame:
    """Floor-trader pivots of the bar before; the first bar has none."""
    w = by_time()
    prev = bars.select("ticker", "timestamp", *(F.lag(c).over(w).alias(f"prev_{c}") for c in ("high", "low", "close"))).where("prev_high IS NOT NULL")
    h, lo, c = (F.col(f"prev_{x}") for x in ("high", "low", "close"))
    pp = (h + lo + c) / 3.0
    return prev.select("ticker", "timestamp", pp.alias("pp"), (2 * pp - lo).alias("r1"), (2 * pp - h).alias("s1"), (pp + (h - lo)).alias("r2"), (pp - (h - lo)).alias("s2"))


def bollinger(bars: DataFrame) -> DataFrame:
    """Two standard deviations around the mean of up to 20 bars, from the second bar on."""
    out = bars.select(*BAR).withColumn("sma_20", moving("close", 20)).withColumn("_std", spread("close", 20)).where("_std IS NOT NULL")
    mid, std = F.col("sma_20"), F.col("_std")
    return out.select(*BAR, "sma_20", (mid + 2.0 * std).alias("bb_upper"), (mid - 2.0 * std).alias("bb_lower"), (4.0 * std / F.nullif(mid, F.lit(0.0))).alias("bb_width"))


def vwap_bands(bars: DataFrame) -> DataFrame:
    """Bands of one and two standard deviations of the close around the vwap, over bars with a positive vwap."""
    rows = bars.where("vwap > 0").select(*BAR, "vwap").withColumn("_std", spread("close", 20)).where("_std IS NOT NULL")
    v, std = F.col("vwap"), F.col("_std")
    bands = {f"vwap_{side}{k}": v + sign * k * std for k in (1, 2) for side, sign in (("r", 1.0), ("s", -1.0))}
    return rows.select(*BAR, "vwap", (F.abs(F.col("close") - v) / v * 100.0).alias("vwp_pct"), *(x.alias(n) for n, x in bands.items()))


def latest(bars: DataFrame, rows: int = 1) -> DataFrame:
    """The last ``rows`` bars of each ticker."""
    w = Window.partitionBy("ticker").orderBy(F.desc("timestamp"))
    return bars.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= rows).drop("_rn")


def newest_first(rows: DataFrame, key: str, most: int, *order: Column) -> DataFrame:
    """The first ``most`` rows of each key in ``order``; rows beyond them are dropped before the shuffle where Spark can."""
    return rows.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("_rn") <= most).drop("_rn")
