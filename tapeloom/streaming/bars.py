"""Structured Streaming over bar messages and bars.

Every function takes a streaming frame and returns one, or starts a query into
a folder; watermarks bound the state of each. ``drain`` runs a query over what
has arrived and stops, so the same code serves a schedule and a running stream.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators import merge as M
from ..operators.profile import ET_OFFSET
from ..sinks import commits
from ..sinks.tables import published
from ..sources.tables import DAY

MESSAGE = "ev string, sym string, v double, av bigint, op double, vw double, o double, c double, h double, l double, a double, s bigint, e bigint"


def parse(lines: DataFrame, channels: list[str], symbols: list[str] | None = None) -> DataFrame:
    """Bars of ``lines(value)``, each a JSON array of messages, on the wanted channels and of the wanted symbols; ``at`` is the bar's start."""
    each = lines.select(F.explode(F.from_json("value", f"array<struct<{', '.join(f'{c}:{t}' for c, t in (x.split() for x in MESSAGE.split(', ')))}>>")).alias("m")).select("m.*")
    each = each.where(F.col("ev").isin(*channels) & F.col("sym").isNotNull() & F.col("s").isNotNull())
    if symbols is not None:
        each = each.where(F.col("sym").isin(*symbols))
    return each.withColumn("at", F.timestamp_millis("s"))


def _hours(messages: DataFrame, width: str, late: str) -> DataFrame:
    first = F.struct("s", "av")
    return messages.withWatermark("at", late).groupBy(F.window("at", width).alias("window"), F.col("sym").alias("ticker")).agg(
        F.min_by("o", first).alias("open"), F.max("h").alias("high"), F.min("l").alias("low"), F.max_by("c", first).alias("close"), F.sum("v").alias("volume"),
        (F.sum(F.col("v") * F.coalesce("vw", "c")) / F.nullif(F.sum("v"), F.lit(0.0))).alias("vwap"), F.count("*").alias("bar_count"),
    )


def rollup(messages: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """OHLCV of each symbol and window; a window comes out once, when no bar up to ``late`` behind the newest can change it."""
    return _hours(messages, width, late).select("ticker", F.unix_millis("window.start").alias("timestamp"), "open", "high", "low", "close", "volume", "vwap", "bar_count")


def daily(messages: DataFrame, late: str = "10 minutes", least: int = 6) -> DataFrame:
    """Messages to hours to UTC days of ``least`` hours or more, in one stream: the hours that the watermark closes go on into the days, which it closes in turn.

    The bars are those of the roll-up of stored hours. Both levels have state of
    their own; the second takes the event time of the first's windows.
    """
    hours = _hours(messages, "1 hour", late).withColumn("ended", F.window_time("window")).withColumn("timestamp", F.unix_millis("window.start"))
    volume, last = F.sum("volume"), F.max_by("close", "timestamp")
    days = hours.groupBy(F.window("ended", "1 day").alias("day"), "ticker").agg(
        F.min_by("open", "timestamp").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), last.alias("close"), volume.alias("volume"),
        F.when(volume > 0, F.sum(F.col("volume") * F.coalesce("vwap", "close")) / volume).otherwise(last).alias("vwap"),
        F.count("*").alias("bar_count"), F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"),
    )
    return days.where(F.col("bar_count") >= least).select("ticker", F.unix_millis("day.start").alias("timestamp"), "open", "high", "low", "close", "volume", "vwap", "bar_count", "first_ts", "last_ts")


def distinct(messages: DataFrame, late: str = "10 minutes") -> DataFrame:
    """The first message of each symbol and start; keys are forgotten ``late`` after the watermark passes."""
    return messages.withWatermark("at", late).dropDuplicatesWithinWatermark(["sym", "s"])


def drain(frame: DataFrame, path: str, mode: str = "append") -> None:
    """Write what the stream holds now to a folder of Parquet, and stop."""
    query = frame.writeStream.format("parquet").option("path", path).option("checkpointLocation", f"{path}-progress").outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()


def drain_batches(frame: DataFrame, progress: str, each: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Hand every micro-batch of what the stream holds now to ``each``, and stop."""
    query = frame.writeStream.foreachBatch(each).option("checkpointLocation", progress).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()


def versions(path: str) -> Callable[[DataFrame, int], None]:
    """A sink that keeps every micro-batch under its number: a batch that is run again replaces itself."""

    def write(batch: DataFrame, no: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={no}")

    return write


def provisional(stage: DataFrame, path: str, stream: str = "stage") -> None:
    """Merge what the streamed stage holds now into the table in ``path``, batch by batch: late official bars replace provisional ones.

    A batch rewrites the periods that it touches and no others, and commits them
    with its number: a batch that runs again finds itself in the table.
    """
    drain_batches(stage, f"{path}-{stream}-progress", lambda batch, no: commits.merge(path, batch, M.provisional, (stream, no)))


# carried indicators: the last values of each recurrence, and sums until their seeds are full
STATE = "last bigint, n int, close double, ema double, gains double, losses double, ranges double, gain double, loss double, atr double"
SHOWN = "ticker string, timestamp bigint, close double, ema_20 double, rsi_14 double, atr_14 double, carried struct<" + ", ".join(c.replace(" ", ": ") for c in STATE.split(", ")) + ">"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SPAN, PERIOD = 20, 14


def _step(state: tuple, ts: int, high: float, low: float, close: float) -> tuple:
    """The state after one more bar."""
    last, n, before, ema, gains, losses, ranges, gain, loss, atr = state
    reach = high - low if before is None else max(high - low, abs(high - before), abs(low - before))
    alpha = 2.0 / (SPAN + 1)
    ema = close if ema is None else (1 - alpha) * ema + alpha * close
    up, down = (0.0, 0.0) if before is None else (max(close - before, 0.0), max(before - close, 0.0))
    n += 1
    if n <= PERIOD:
        gains, losses, ranges = gains + up, losses + down, ranges + reach
        if n == PERIOD:  # the first bar has no change, so changes are one fewer than ranges
            gain, loss, atr = gains / (PERIOD - 1), losses / (PERIOD - 1), ranges / PERIOD
    else:
        keep = (PERIOD - 1) / PERIOD
        gain, loss, atr = keep * gain + up / PERIOD, keep * loss + down / PERIOD, keep * atr + reach / PERIOD
    return ts, n, close, ema, gains, losses, ranges, gain, loss, atr


def _shown(ticker: str, state: tuple) -> dict:
    ts, n, close, ema, *_, gain, loss, atr = state
    rsi = None if n <= PERIOD else 100.0 if loss == 0 else 100 - 100 / (1 + gain / loss)
    carried = dict(zip((c.split()[0] for c in STATE.split(", ")), state))
    return {"ticker": ticker, "timestamp": ts, "close": close, "ema_20": ema if n >= SPAN else None, "rsi_14": rsi, "atr_14": atr, "carried": carried}


class Carry(StatefulProcessor):
    """A ticker's recurrences: one value of state, and a timer that ends it ``keep`` milliseconds after the last bar."""

    def __init__(self, keep: int):
        self.keep = keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("carried", STATE)

    def _hold(self, now: tuple) -> None:
        self.state.update(now)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(now[0] + self.keep)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        now = tuple(self.state.get()) if self.state.exists() else (-(2**63), 0, None, None, 0.0, 0.0, 0.0, None, None, None)
        bars = pd.concat(list(rows)).dropna(subset=["high", "low", "close"]).sort_values("timestamp")
        for ts, high, low, close in zip(*(bars[c].tolist() for c in ("timestamp", "high", "low", "close"))):
            if ts > now[0]:
                now = _step(now, ts, high, low, close)
        if now[1]:
            self._hold(now)
            yield pd.DataFrame([_shown(key[0], now)])

    def handleInitialState(self, key: tuple, initialState: pd.DataFrame, timerValues: object) -> None:
        row = initialState.iloc[0]
        kinds = [c.split() for c in STATE.split(", ")]
        self._hold(tuple(None if pd.isna(row[c]) else int(row[c]) if kind in ("bigint", "int") else float(row[c]) for c, kind in kinds))

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:
        self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


def carried(bars: DataFrame, stored: DataFrame | None = None, keep_days: int = 30, late: str = "7 days") -> DataFrame:
    """The newest EMA, RSI and ATR of each ticker that had bars in a micro-batch, from what was carried over and the new bars alone.

    Bars with a missing price, bars not newer than the ticker's last one, and
    bars more than ``late`` behind the newest of all (or not after 1970 began,
    where a stream's watermark starts) change nothing. A ticker
    without bars for ``keep_days`` is forgotten and begins anew if it returns.
    ``stored`` rows of an earlier stream's output (one for each ticker) are
    where a new one begins. State is kept in RocksDB: start the query under
    ``state_on_disk``.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the process that prepares the state knows the worker's path only
    rows = bars.select("ticker", "timestamp", "high", "low", "close", F.timestamp_millis("timestamp").alias("at")).withWatermark("at", late)
    initial = None if stored is None else stored.select("ticker", "carried.*").groupBy("ticker")
    return rows.groupBy("ticker").transformWithStateInPandas(Carry(keep_days * DAY), SHOWN, "update", "EventTime", initial)


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB; the session's own setting is put back."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def day_volume(minutes: DataFrame, late: str = "1 day") -> DataFrame:
    """``(ticker, date, last_minute, cum_vol)``: each day's volume so far, over ``minutes(ticker, minute_ts, volume)``."""
    at = F.timestamp_millis("minute_ts")
    rows = minutes.withColumn("at", at).withWatermark("at", late)
    days = rows.groupBy(F.window("at", "1 day"), "ticker").agg(F.sum("volume").alias("cum_vol"), F.max("minute_ts").alias("last"))
    return days.select("ticker", F.to_date("window.start").alias("date"), F.expr("int(last div 60000 % 1440)").alias("last_minute"), "cum_vol")


def against_profile(days: DataFrame, profiled: DataFrame, bin_minutes: int = 5) -> DataFrame:
    """The volume so far against the profile's bin of the last minute."""
    minute = (F.expr(f"last_minute div {bin_minutes} * {bin_minutes}") - ET_OFFSET).cast("int")
    rows = days.withColumn("et_minute", minute).join(profiled.select("ticker", "et_minute", "avg"), ["ticker", "et_minute"])
    ratio = F.when(F.col("avg") > 0, F.col("cum_vol") / F.col("avg")).otherwise(0.0)
    state = F.when(ratio > 1.5, "above").when(ratio < 0.5, "below").otherwise("normal")
    return rows.select("ticker", "date", "et_minute", "cum_vol", F.col("avg").alias("avg_cum_vol"), F.bround(ratio, 2).alias("ratio"), state.alias("signal"))


def volume_signals(minutes: DataFrame, profile: str, out: str, late: str = "1 day") -> None:
    """The signal of every day whose volume a micro-batch changed, written to ``out`` batch by batch.

    The profile is joined inside the running stream: each batch reads the newest
    one published in ``profile``, so a new profile counts from the next batch on.
    """

    def write(batch: DataFrame, no: int) -> None:
        versions(out)(against_profile(batch, published(batch.sparkSession, profile)), no)

    drain_batches(day_volume(minutes, late), f"{out}-progress", write, "update")
