"""The recurrences of long series as a parallel scan, on the JVM.

An EMA and a Wilder average are affine steps, y[t] = w * y[t-1] + u[t]. Over a
segment of a ticker's bars a value is therefore what the segment gives by itself
(a running sum of u[j] / w**j, times w**i) plus w**i times the value carried in.
Segments are ranges of time, so a ticker of any length is spread over many
tasks, and no position has to be known beforehand. The values at the segments'
ends are put together on one row for each segment: what a segment carries in is
the sum of the ends before it, each weakened by the bars in between, as far back
as it still counts in double precision (``REACH`` bars).

Seeds are steps too: a Wilder average begins with the mean of its first values,
which is what they add up to when each is weighted up by what it will have lost
by then.

Bars need prices (``indicators.with_recurrences`` also takes series with gaps)
and must be at least ``grain`` apart: a segment then holds ``LENGTH`` bars at
most, for which the powers stay far from overflow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .indicators import RECURRENT

LENGTH, REACH = 2000, 1000
_KEY = ["ticker", "_seg"]


def _power(w: float, n: Column) -> Column:
    return F.pow(F.lit(w), n.cast("double"))


def _beside(rows: DataFrame, segments: DataFrame) -> DataFrame:
    """``rows`` with the columns of their segment; hashing the few segments leaves the rows in their order."""
    return rows.join(segments.hint("shuffle_hash"), _KEY)


def _linear(rows: DataFrame, steps: dict[str, tuple[float, Column]]) -> DataFrame:
    """``rows`` with y[t] = w * y[t-1] + u[t] for each ``name: (w, u)``, over each ticker in the order of ``_t``."""
    inside = Window.partitionBy(*_KEY).orderBy("timestamp").rowsBetween(Window.unboundedPreceding, 0)
    own = {f"_own_{n}": _power(w, F.col("_i")) * F.sum(u * _power(w, -F.col("_i"))).over(inside) for n, (w, u) in steps.items()}
    rows = rows.withColumns(own)
    ends = rows.groupBy(*_KEY).agg(F.max("_t").alias("_end"), *(F.max_by(f"_own_{n}", "_i").alias(n) for n in steps))
    near = Window.partitionBy("ticker").orderBy("_end").rangeBetween(-REACH, -1)
    before = F.collect_list(F.struct("_end", *steps)).over(near)  # a row a segment: REACH of them at most
    first = F.lag("_end").over(Window.partitionBy("ticker").orderBy("_end"))
    ends = ends.withColumns({"_before": before, "_at": first})
    weak = lambda n, w: F.aggregate("_before", F.lit(0.0), lambda s, e: s + e[n] * _power(w, F.col("_at") - e["_end"]))
    carried = ends.select(*_KEY, *(weak(n, w).alias(f"_in_{n}") for n, (w, _) in steps.items()))
    rows = _beside(rows, carried)
    out = {n: F.col(f"_own_{n}") + _power(w, F.col("_i")) * F.col(f"_in_{n}") for n, (w, _) in steps.items()}
    return rows.withColumns(out).drop(*(f"{p}_{n}" for n in steps for p in ("_own", "_in")))


def _ema(x: str, span: int, first: int = 0) -> tuple[float, Column]:
    a = 2.0 / (span + 1)
    return 1 - a, F.when(F.col("_t") < first, 0.0).when(F.col("_t") == first, F.col(x)).otherwise(a * F.col(x))


def _wilder(x: str, period: int, seeds: int) -> tuple[float, Column]:
    """``seeds``: how many of the first ``period`` values there are."""
    w, t = (period - 1) / period, F.col("_t")
    return w, F.coalesce(F.when(t < period, F.col(x) / seeds * _power(w, t - (period - 1))).otherwise(F.col(x) / period), F.lit(0.0))


def with_recurrences(bars: DataFrame, grain: int, length: int = LENGTH) -> DataFrame:
    """``bars`` with the columns of RECURRENT; ``grain`` in milliseconds, ``length`` grains make a segment.

    Bars that are dealt by segment (``_seg``, as from ``tables.daily_bars`` with a ``span``) are neither shuffled nor sorted again.
    """
    rows = bars if "_seg" in bars.columns else bars.withColumn("_seg", F.floor(F.col("timestamp") / (grain * length)))
    rows = rows.where("ticker IS NOT NULL AND _seg IS NOT NULL")  # what the joins keep, said once: all branches then read the same shuffle
    parts = rows.groupBy(*_KEY).agg(F.count("*").alias("_n"), F.max_by("close", "timestamp").alias("_last"))
    order = Window.partitionBy("ticker").orderBy("_seg")
    parts = parts.select(*_KEY, (F.sum("_n").over(order) - F.col("_n")).alias("_base"), F.lag("_last").over(order).alias("_close_in"))
    inside = Window.partitionBy(*_KEY).orderBy("timestamp")
    rows = _beside(rows, parts).withColumn("_i", F.row_number().over(inside)).withColumn("_t", F.col("_base") + F.col("_i") - 1)
    before = F.coalesce(F.lag("close").over(inside), F.col("_close_in"))
    rows = rows.withColumn("_before", before)
    change, high, low = F.col("close") - F.col("_before"), F.col("high"), F.col("low")
    rows = rows.withColumns({"_up": F.greatest(change, change * 0), "_down": F.greatest(-change, change * 0), "_range": F.greatest(high - low, F.abs(high - F.col("_before")), F.abs(low - F.col("_before")))}).drop("_before", "_close_in", "_base")
    rows = _linear(rows, {
        "_e12": _ema("close", 12), "_e20": _ema("close", 20), "_e26": _ema("close", 26), "_gain": _wilder("_up", 14, 13), "_loss": _wilder("_down", 14, 13),
        "_a10": _wilder("_range", 10, 10), "_a14": _wilder("_range", 14, 14),
    })
    rows = _linear(rows.withColumn("_line", F.col("_e12") - F.col("_e26")), {"_signal": _ema("_line", 9, first=25)})
    since = lambda t, x: F.when(F.col("_t") >= t, x)
    mid, a10 = since(19, F.col("_e20")), since(9, F.col("_a10"))
    values = {
        "ema_20": mid, "rsi_14": since(14, F.when(F.col("_loss") == 0, 100.0).otherwise(100 - 100 / (1 + F.col("_gain") / F.nullif("_loss", F.lit(0.0))))), "atr_14": since(13, F.col("_a14")), "keltner_middle": mid,
        "macd_line": since(25, F.col("_line")), "macd_signal": since(33, F.col("_signal")), "macd_histogram": since(33, F.col("_line") - F.col("_signal")),
    }
    for name, m in (("", 2.0), ("_1_5", 1.5), ("_3_0", 3.0)):
        values |= {f"keltner_upper{name}": mid + m * a10, f"keltner_lower{name}": mid - m * a10}
    return rows.withColumns(values).select(*bars.columns, *RECURRENT)
