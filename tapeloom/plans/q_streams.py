"""Queries over streams: the given tables are written as files, streamed to their end, and the sink is read."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import merge as M
from ..operators import profile as P
from ..registry import query
from ..sinks import commits
from ..sinks import tables as S
from ..sources.folders import fresh
from ..sources.tables import DAY, HOUR, daily_bars, table
from ..streaming import bars as T
from .q_merge import _ABSENT_DATE, _CUM, _KEPT, _MIN, _PAIR, _PROFILE, _both, _minutes
from .sql import DAILY, recurrences, with_

# Every event is a message of one share; each fifth is on another channel, and one type is not wanted. A line holds an hour's messages.
_WANTED = ["click", "view", "purchase", "signup"]
MESSAGES = """messages AS (SELECT event_type AS sym, epoch_us(ts) // 1000 AS s, event_id AS av, round(value * 100) AS p FROM events WHERE event_id % 5 <> 0 AND event_type IN ('click', 'view', 'purchase', 'signup'))"""


def _lines(spark, sf_dir, copies=1):
    """A stream of lines, each the JSON array of one hour's messages."""
    path = fresh(spark, "messages")
    p = F.round(F.col("value") * 100)
    s = F.unix_millis(F.col("ts").cast("timestamp"))
    message = F.struct(
        F.when(F.col("event_id") % 5 == 0, "T").otherwise("A").alias("ev"), F.col("event_type").alias("sym"), F.lit(1.0).alias("v"), F.col("event_id").alias("av"), p.alias("vw"), p.alias("o"), p.alias("c"),
        p.alias("h"), p.alias("l"), s.alias("s"), (s + 1000).alias("e"),
    )
    rows = table(spark, sf_dir, "events").select(F.expr(f"unix_millis(cast(ts as timestamp)) div {HOUR}").alias("hour"), message.alias("m"))
    lines = rows.groupBy("hour").agg(F.to_json(F.collect_list("m")).alias("value")).select("value")
    for _ in range(copies):
        lines.write.mode("append").text(path)
    return spark.readStream.text(path)


@query(with_(MESSAGES) + "SELECT sym, s, av, p AS c FROM messages")
def stream_parse(spark, sf_dir):
    out = fresh(spark, "stream-parsed")
    T.drain(T.parse(_lines(spark, sf_dir), ["A"], _WANTED).select("sym", "s", "av", "c"), out)
    return spark.read.parquet(out)


@query(with_(MESSAGES) + f""", h AS (SELECT sym AS ticker, s // {HOUR} * {HOUR} AS timestamp, arg_min(p, row(s, av)) AS open, max(p) AS high, min(p) AS low, arg_max(p, row(s, av)) AS close, count(*)::DOUBLE AS volume, sum(p) / count(*) AS vwap, count(*) AS bar_count FROM messages GROUP BY ALL)
SELECT * FROM h WHERE timestamp + {HOUR} <= (SELECT max(s) FROM messages) - 600000""")
def stream_rollup(spark, sf_dir):
    """Hours that the watermark has closed."""
    out = fresh(spark, "stream-rolled")
    T.drain(T.rollup(T.parse(_lines(spark, sf_dir), ["A"], _WANTED)), out)
    return spark.read.parquet(out)


@query(with_(MESSAGES) + f""", h AS (SELECT sym AS ticker, s // {HOUR} * {HOUR} AS timestamp, arg_min(p, row(s, av)) AS open, max(p) AS high, min(p) AS low, arg_max(p, row(s, av)) AS close, count(*)::DOUBLE AS volume, sum(p) / count(*) AS vwap FROM messages GROUP BY ALL)
SELECT ticker, timestamp // {DAY} * {DAY} AS timestamp, arg_min(open, h.timestamp) AS open, max(high) AS high, min(low) AS low, arg_max(close, h.timestamp) AS close, sum(volume) AS volume, sum(volume * vwap) / sum(volume) AS vwap, count(*) AS bar_count, min(h.timestamp) AS first_ts, max(h.timestamp) AS last_ts
FROM h WHERE timestamp // {DAY} * {DAY} + {DAY} <= (SELECT max(s) FROM messages) - 600000 GROUP BY ticker, timestamp // {DAY} HAVING count(*) >= 6""")
def stream_daily(spark, sf_dir):
    """Messages to hours to days: the days that the watermark has closed."""
    out = fresh(spark, "stream-days")
    T.drain(T.daily(T.parse(_lines(spark, sf_dir), ["A"], _WANTED)), out)
    return spark.read.parquet(out)


@query(with_(MESSAGES) + "SELECT sym, s, count(DISTINCT 1) AS n FROM messages GROUP BY ALL")
def stream_dedup(spark, sf_dir):
    """Every line arrives twice."""
    out = fresh(spark, "stream-distinct")
    T.drain(T.distinct(T.parse(_lines(spark, sf_dir, copies=2), ["A"], _WANTED), "60 days").select("sym", "s"), out)
    return spark.read.parquet(out).groupBy("sym", "s").agg(F.count("*").alias("n"))


@query(_PAIR + _KEPT + _ABSENT_DATE.format(t="kept", o="s.transactions IS NULL, s.timestamp"))
def stream_provisional(spark, sf_dir):
    """The staged bars arrive as a stream, every fourth year of them in a micro-batch, and are merged into a table of files."""
    target, stage = _both(spark, sf_dir)
    arrived, held, path = fresh(spark, "stage"), fresh(spark, "held"), fresh(spark, "bars")
    commits.create(target, path)
    stage.write.parquet(held)  # as many files as tasks: no task has a year to itself
    for rest in range(4):
        part = spark.read.schema(stage.schema).parquet(held).where(F.expr(f"coalesce(year(timestamp_millis(timestamp)), 0) % 4 = {rest}"))
        part.write.mode("append").parquet(arrived)
        T.provisional(spark.readStream.schema(stage.schema).parquet(arrived), path)
    return commits.read(spark, path)


@query(with_(DAILY, *recurrences("daily"), recursive=True) + "SELECT ticker, timestamp, close, ema_20, rsi_14, atr_14 FROM rec WHERE rn = bars")
def stream_indicators(spark, sf_dir):
    """The bars arrive in three parts; the third goes to a new stream that begins with the rows the first one stored."""
    bars = daily_bars(spark, sf_dir)
    arrived, later, out = fresh(spark, "bars"), fresh(spark, "bars"), fresh(spark, "stream-indicators")
    day = F.expr(f"timestamp div {DAY}")
    newest = lambda rows: M.first_per(rows, ["ticker"], F.desc("timestamp"), F.desc("batch"))
    source = lambda path: spark.readStream.schema(bars.schema).parquet(path)
    with T.state_on_disk(spark):
        for part in (bars.where(day < 9000), bars.where(day.between(9000, 9700))):
            part.write.mode("append").parquet(arrived)
            T.drain_batches(T.carried(source(arrived), keep_days=4000), f"{out}-first", T.versions(f"{out}/first"), "update")
        bars.where(day > 9700).write.parquet(later)
        stored = newest(spark.read.parquet(f"{out}/first"))
        T.drain_batches(T.carried(source(later), stored, keep_days=4000), f"{out}-second", T.versions(f"{out}/second"), "update")
    rows = spark.read.parquet(f"{out}/first").unionByName(spark.read.parquet(f"{out}/second"))
    return newest(rows).select("ticker", "timestamp", "close", "ema_20", "rsi_14", "atr_14")


@query(with_(_MIN, _CUM.format("minutes"), _PROFILE) + """, days AS (SELECT ticker, d AS date, max(minute) // 5 * 5 - 240 AS et_minute, sum(volume) AS cum_vol FROM cum GROUP BY ALL),
j AS (SELECT y.*, avg AS avg_cum_vol, CASE WHEN avg > 0 THEN cum_vol / avg ELSE 0 END AS r FROM days y JOIN prof p ON y.ticker = p.ticker AND y.et_minute = p.et_minute)
SELECT ticker, date, et_minute::INTEGER AS et_minute, cum_vol, avg_cum_vol, round_even(r, 2) AS ratio, CASE WHEN r > 1.5 THEN 'above' WHEN r < 0.5 THEN 'below' ELSE 'normal' END AS signal FROM j""")
def stream_volume(spark, sf_dir):
    """Each day's volume so far against the profile of all days, which the stream joins batch by batch."""
    minutes = _minutes(spark, sf_dir)
    arrived, out, profile = fresh(spark, "minutes"), fresh(spark, "stream-volume"), fresh(spark, "profile")
    S.publish(P.profile(minutes), profile)
    minutes.write.parquet(arrived)
    T.volume_signals(spark.readStream.schema(minutes.schema).option("maxFilesPerTrigger", 3).parquet(arrived), profile, out, "60 days")
    newest = M.first_per(spark.read.parquet(out), ["ticker", "date"], F.desc("batch"))
    return newest.drop("batch")
