"""Queries over merges, work lists, gates and volume profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audit as A
from ..operators import bars as B
from ..operators import coverage as C
from ..operators import indicators as I
from ..operators import merge as M
from ..operators import profile as P
from ..operators import views as V
from ..registry import query
from ..sinks import commits as K
from ..sources.folders import fresh
from ..sources.tables import DAY, HOUR, companies, daily_bars, hourly_bars, table
from .q_bars import VIEW_DAILY
from .sql import COMPANIES, DAILY, FOUR_HOURS, HOURLY, with_

COLS = ["ticker", "timestamp", "open", "high", "low", "close", "volume", "vwap", "transactions"]
_C = ", ".join(COLS)

# The target holds two days of three, every fifth day without a transaction count; the stage holds the rest and
# every second day again, four hours later and one cent dearer, and each of its own bars a second time without a count.
TARGET = f"target AS (SELECT ticker, timestamp, open, high, low, close, volume, vwap, CASE WHEN timestamp // {DAY} % 5 <> 0 THEN transactions END AS transactions FROM daily WHERE timestamp // {DAY} % 3 <> 0)"
STAGE = f"""moved AS (SELECT * REPLACE (timestamp + {4 * HOUR} * k AS timestamp, close + k AS close, CASE WHEN k = 1 THEN transactions END AS transactions) FROM daily, (VALUES (1), (2)) v(k) WHERE timestamp // {DAY} % 3 = 0 OR timestamp // {DAY} % 2 = 0),
stage AS (SELECT {_C} FROM moved)"""


def _target(daily):
    day = F.expr(f"timestamp div {DAY}")
    return daily.where(day % 3 != 0).withColumn("transactions", F.when(day % 5 != 0, F.col("transactions"))).select(*COLS)


def _stage(daily):
    day = F.expr(f"timestamp div {DAY}")
    rows = daily.where((day % 3 == 0) | (day % 2 == 0)).withColumn("k", F.explode(F.array(F.lit(1), F.lit(2))))
    rows = rows.withColumn("timestamp", F.col("timestamp") + 4 * HOUR * F.col("k")).withColumn("close", F.col("close") + F.col("k")).withColumn("transactions", F.when(F.col("k") == 1, F.col("transactions")))
    return rows.select(*COLS)


def _both(spark, sf_dir):
    daily = daily_bars(spark, sf_dir)
    return _target(daily), _stage(daily)


_PAIR = with_(DAILY, TARGET, STAGE)
_D = "make_timestamp({} * 1000)::DATE"
_ABSENT_DATE = f"""SELECT {_C} FROM {{t}} UNION ALL SELECT {_C} FROM (SELECT s.* FROM stage s WHERE NOT EXISTS (SELECT 1 FROM {{t}} t WHERE t.ticker = s.ticker AND t.timestamp // {DAY} = s.timestamp // {DAY})
 QUALIFY row_number() OVER (PARTITION BY s.ticker, s.timestamp // {DAY} ORDER BY {{o}}) = 1)"""


@query(_PAIR + f"SELECT {_C} FROM target UNION ALL SELECT {_C} FROM (SELECT * REPLACE (timestamp - 14400000 AS timestamp) FROM stage) s WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.ticker = s.ticker AND t.timestamp = s.timestamp)")
def merge_absent_key(spark, sf_dir):
    target, stage = _both(spark, sf_dir)
    stage = stage.withColumn("timestamp", F.col("timestamp") - 4 * HOUR)
    return M.absent_key(target, stage.unionByName(stage), ["ticker", "timestamp"], F.col("close"))


@query(_PAIR + _ABSENT_DATE.format(t="target", o="s.timestamp"))
def merge_absent_date(spark, sf_dir):
    return M.absent_date(*_both(spark, sf_dir), F.col("timestamp"))


_KEPT = f", kept AS (SELECT * FROM target t WHERE NOT (transactions IS NULL AND EXISTS (SELECT 1 FROM stage s WHERE s.ticker = t.ticker AND s.timestamp // {DAY} = t.timestamp // {DAY} AND s.transactions IS NOT NULL))) "


@query(_PAIR + _KEPT + _ABSENT_DATE.format(t="kept", o="s.transactions IS NULL, s.timestamp"))
def merge_provisional(spark, sf_dir):
    return M.provisional(*_both(spark, sf_dir))


@query(_PAIR + f", n AS (SELECT * REPLACE (timestamp // {DAY} * {DAY} AS timestamp) FROM stage QUALIFY row_number() OVER (PARTITION BY ticker, timestamp // {DAY} ORDER BY close DESC) = 1) SELECT {_C} FROM n UNION ALL SELECT {_C} FROM target t WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.ticker = t.ticker AND n.timestamp = t.timestamp)")
def merge_replace(spark, sf_dir):
    target, stage = _both(spark, sf_dir)
    return M.replace(target, stage.withColumn("timestamp", F.expr(f"timestamp div {DAY} * {DAY}")), ["ticker", "timestamp"], F.desc("close"))


@query(_PAIR + f"SELECT {_C} FROM target UNION ALL SELECT {_C} FROM stage WHERE ticker NOT IN (SELECT ticker FROM target)")
def merge_overlay(spark, sf_dir):
    return M.overlay(*_both(spark, sf_dir))


@query(_PAIR + f"SELECT {_C} FROM stage QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY timestamp DESC) = 1")
def stage_newest(spark, sf_dir):
    return M.newest(_stage(daily_bars(spark, sf_dir)), ["ticker"], "timestamp")


@query(_PAIR + f"SELECT {_C} FROM stage QUALIFY row_number() OVER (PARTITION BY ticker, timestamp // {DAY} ORDER BY transactions IS NULL, timestamp) = 1")
def stage_prefer_official(spark, sf_dir):
    return M.prefer_official(_stage(daily_bars(spark, sf_dir)))


@query(_PAIR + f"SELECT DISTINCT {_C} FROM (SELECT * FROM stage UNION ALL SELECT * FROM stage)")
def stage_distinct(spark, sf_dir):
    stage = _stage(daily_bars(spark, sf_dir))
    return stage.unionByName(stage).distinct()


@query(_PAIR + ", merged AS (" + _ABSENT_DATE.format(t="target", o="s.timestamp") + ") SELECT (SELECT count(*) FROM stage) AS staged, (SELECT count(*) FROM target) AS before, (SELECT count(*) FROM merged) AS after, (SELECT count(*) FROM merged) - (SELECT count(*) FROM target) AS inserted")
def merge_metrics(spark, sf_dir):
    target, stage = _both(spark, sf_dir)
    return M.metrics(target, stage, M.absent_date(target, stage, F.col("timestamp")))


@query(_PAIR + _KEPT + _ABSENT_DATE.format(t="kept", o="s.transactions IS NULL, s.timestamp"))
def merge_commit(spark, sf_dir):
    """Two commits to a table of files: the bars of odd days, then those of even days."""
    target, stage = _both(spark, sf_dir)
    path = fresh(spark, "bars")
    K.create(target, path)
    for rest in (1, 0):
        K.merge(path, stage.where(F.expr(f"timestamp div {DAY} % 2 = {rest}")), M.provisional)
    return K.read(spark, path)


@query(
    _PAIR
    + """, old AS (SELECT * FROM target WHERE timestamp < 820454400000), s96 AS (SELECT * FROM stage WHERE timestamp >= 820454400000 - 7776000000),
new AS (SELECT DISTINCT ticker, timestamp // 86400000 AS d FROM s96 s WHERE NOT EXISTS (SELECT 1 FROM old t WHERE t.ticker = s.ticker AND t.timestamp // 86400000 = s.timestamp // 86400000))
SELECT 1 AS version, (SELECT count(*) FROM s96) AS staged, (SELECT count(*) FROM old) AS before, (SELECT count(*) FROM old) + (SELECT count(*) FROM new) AS after, (SELECT count(*) FROM new) AS inserted,
 (SELECT count(DISTINCT date_trunc('month', make_timestamp(timestamp * 1000))) FROM old WHERE timestamp < 820454400000 - 7776000000 AND date_trunc('month', make_timestamp(timestamp * 1000)) < date_trunc('month', make_timestamp(812678400000000))) AS untouched"""
)
def merge_commit_counts(spark, sf_dir):
    """The counts that a commit observed, and how many periods it left as they were: the target ends with 1995, the stage begins 90 days before that."""
    target, stage = _both(spark, sf_dir)
    path, new_year = fresh(spark, "bars"), 820_454_400_000
    first = K.create(target.where(F.col("timestamp") < new_year), path)
    counts = K.merge(path, stage.where(F.col("timestamp") >= new_year - 90 * DAY), lambda old, new: M.absent_date(old, new, F.col("timestamp")))
    second = K.manifest(spark, path)
    untouched = sum(second.parts.get(p) == part for p, part in first.parts.items())
    return spark.createDataFrame([(*counts.values(), untouched)], "version int, staged long, before long, after long, inserted long, untouched long")


_CACHE = "cache AS (SELECT ticker, CASE WHEN sector_no % 3 > 0 THEN 'S' || sector_no END AS sector, CASE WHEN sector_no % 3 > 1 THEN industry ELSE '' END AS industry, 'old' AS source, CASE WHEN sector_no % 4 > 0 THEN sector_no * 10 END AS source_priority, 0.5::DOUBLE AS confidence FROM companies WHERE sector_no <> 7)"
_CLS_STAGE = "cs AS (SELECT ticker, 'N' || k AS sector, industry, 'src' || k AS source, 20 * k AS source_priority, (1.0::DOUBLE / k) AS confidence FROM companies, (VALUES (1), (2), (3)) v(k) WHERE sector_no % 3 >= k - 1)"
_CLS = with_(COMPANIES, _CACHE, _CLS_STAGE)
_CLS_COLS = "ticker, sector, industry, source, source_priority, confidence"


def _classified(spark, sf_dir):
    c = companies(spark, sf_dir)
    n = F.col("sector_no")
    cache = c.where(n != 7).select("ticker", F.when(n % 3 > 0, F.concat(F.lit("S"), n)).alias("sector"), F.when(n % 3 > 1, F.col("industry")).otherwise("").alias("industry"), F.lit("old").alias("source"), F.when(n % 4 > 0, n * 10).alias("source_priority"), F.lit(0.5).alias("confidence"))
    k = F.col("k")
    stage = c.withColumn("k", F.explode(F.array(*map(F.lit, (1, 2, 3))))).where(n % 3 >= k - 1)
    stage = stage.select("ticker", F.concat(F.lit("N"), k).alias("sector"), "industry", F.concat(F.lit("src"), k).alias("source"), (20 * k).alias("source_priority"), (F.lit(1.0) / k).alias("confidence"))
    return cache, stage


@query(_CLS + f", b AS (SELECT * FROM cs QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY source_priority, confidence DESC) = 1), k AS (SELECT * FROM cache c WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.ticker = c.ticker AND (c.source_priority IS NULL OR b.source_priority <= c.source_priority OR (coalesce(c.sector, '') = '' AND coalesce(c.industry, '') = '')))) SELECT {_CLS_COLS} FROM k UNION ALL SELECT {_CLS_COLS} FROM b WHERE ticker NOT IN (SELECT ticker FROM k)")
def merge_priority(spark, sf_dir):
    return M.priority(*_classified(spark, sf_dir))


@query(_CLS + f", b AS (SELECT * FROM cs WHERE source = 'src1'), k AS (SELECT * FROM cache c WHERE NOT (coalesce(sector, '') = '' AND coalesce(industry, '') = '' AND ticker IN (SELECT ticker FROM b))) SELECT {_CLS_COLS} FROM k UNION ALL SELECT {_CLS_COLS} FROM b WHERE ticker NOT IN (SELECT ticker FROM k)")
def merge_fill_only(spark, sf_dir):
    cache, stage = _classified(spark, sf_dir)
    return M.fill_only(cache, stage.where("source = 'src1'"))


# work lists: days of the hourly tickers, without those of one, whose hourly bars are the gap

_EV = with_(HOURLY, f"ed AS (SELECT ticker, timestamp // {DAY} * {DAY} AS timestamp, sum(volume) AS volume FROM hourly GROUP BY ALL)", f"eh AS (SELECT * FROM hourly WHERE ticker <> 'view' AND NOT (ticker = 'click' AND timestamp >= (SELECT max(timestamp) FROM hourly) - 5 * {DAY}))")


def _days_and_hours(spark, sf_dir):
    hourly = hourly_bars(spark, sf_dir)
    days = hourly.groupBy("ticker", F.expr(f"timestamp div {DAY} * {DAY}").alias("timestamp")).agg(F.sum("volume").alias("volume"))
    last = hourly.agg(F.max("timestamp").alias("_m"))
    cut = hourly.join(F.broadcast(last), F.lit(True)).where(f"ticker <> 'view' AND NOT (ticker = 'click' AND timestamp >= _m - {5 * DAY})").drop("_m")
    return days, cut


@query(_EV + "SELECT y.ticker, y.yr::INTEGER AS yr, coalesce(m, 0)::INTEGER AS last_month FROM (SELECT DISTINCT ticker, year(make_timestamp(timestamp * 1000)) AS yr FROM ed) y LEFT JOIN (SELECT ticker, year(make_timestamp(timestamp * 1000)) AS yr, month(make_timestamp(max(timestamp) * 1000)) AS m FROM eh GROUP BY ALL) h ON y.ticker = h.ticker AND y.yr = h.yr WHERE y.yr BETWEEN 2021 AND 2024 AND coalesce(m, 0) < 11 UNION ALL SELECT DISTINCT ticker, NULL, 0 FROM ed WHERE ticker NOT IN (SELECT ticker FROM eh)")
def coverage_years(spark, sf_dir):
    return C.incomplete_years(*_days_and_hours(spark, sf_dir), year=2025)


_NOW = 1706661000000
_GAPS = f"gaps AS (SELECT h.ticker, coalesce(d.m, 0) AS max_daily, h.m AS max_hourly, CASE WHEN coalesce(d.m, 0) > h.m + {HOUR} THEN 'gap' WHEN h.m < {_NOW} - 24 * {HOUR} THEN 'stale' END AS reason, make_timestamp(h.m * 1000)::DATE AS start_date FROM (SELECT ticker, max(timestamp) AS m FROM eh GROUP BY ticker) h LEFT JOIN (SELECT ticker, max(timestamp) AS m FROM ed GROUP BY ticker) d ON h.ticker = d.ticker)"


@query(_EV + f", {_GAPS} SELECT * FROM gaps WHERE reason IS NOT NULL")
def coverage_gap(spark, sf_dir):
    return C.gaps(*_days_and_hours(spark, sf_dir), now_ms=_NOW)


@query(_EV + f", {_GAPS}, u AS (SELECT DISTINCT ticker FROM ed), y AS (SELECT ticker, unnest(range(2021, 2025)) AS y FROM u WHERE ticker NOT IN (SELECT ticker FROM gaps WHERE reason IS NOT NULL)) SELECT ticker, start_date AS range_start, DATE '2024-02-10' AS range_end FROM gaps WHERE reason IS NOT NULL AND start_date < DATE '2024-02-10' UNION ALL SELECT ticker, greatest(DATE '2021-06-01', make_date(y, 1, 1)), least(DATE '2024-02-10', make_date(y, 12, 31)) FROM y")
def backfill_ranges(spark, sf_dir):
    days, hours = _days_and_hours(spark, sf_dir)
    return C.backfill_ranges(days.select("ticker").distinct(), C.gaps(days, hours, now_ms=_NOW), "2024-02-10")


@query(with_(DAILY, COMPANIES, f"d AS (SELECT ticker, {_NOW} - sector_no::BIGINT * 5 * {DAY} AS last_updated FROM companies WHERE sector_no <> 3)") + f"SELECT u.ticker, CASE WHEN last_updated IS NULL THEN 'missing' ELSE 'stale' END AS state FROM (SELECT DISTINCT ticker FROM daily) u LEFT JOIN d ON u.ticker = d.ticker WHERE last_updated IS NULL OR last_updated < {_NOW} - 30 * {DAY}::BIGINT")
def reference_stale(spark, sf_dir):
    details = companies(spark, sf_dir).where("sector_no <> 3").select("ticker", (F.lit(_NOW) - F.col("sector_no") * 5 * F.lit(DAY).cast("long")).alias("last_updated"))
    return C.reference_stale(daily_bars(spark, sf_dir).select("ticker").distinct(), details, _NOW)


@query(_EV + "SELECT d.ticker, d.n AS daily_bars, coalesce(h.n, 0) AS hourly_bars, coalesce(h.n, 0) / (d.n * 7) AS ratio FROM (SELECT ticker, count(*) AS n FROM ed GROUP BY ticker) d LEFT JOIN (SELECT ticker, count(*) AS n FROM eh GROUP BY ticker) h ON d.ticker = h.ticker")
def completeness_ratio(spark, sf_dir):
    return C.completeness(*_days_and_hours(spark, sf_dir))


# gates

_TABLES = with_(DAILY, TARGET, COMPANIES, "small AS (SELECT * FROM companies WHERE sector_no < 9)", "gone AS (SELECT * FROM companies WHERE sector_no > 99)")
_COVER = " UNION ALL ".join(f"SELECT '{n}' AS table_name, (SELECT count(*) FROM {n}) AS n_rows, count(*) FILTER (ticker IN (SELECT ticker FROM {n})) AS covered, count(*) FILTER (ticker NOT IN (SELECT ticker FROM {n})) AS missing, 100.0 * count(*) FILTER (ticker IN (SELECT ticker FROM {n})) / count(*) AS pct FROM companies" for n in ("daily", "small", "gone"))


def _audited(spark, sf_dir):
    c = companies(spark, sf_dir)
    return c, {"daily": daily_bars(spark, sf_dir), "small": c.where("sector_no < 9"), "gone": c.where("sector_no > 99")}


@query(_TABLES + _COVER)
def audit_coverage(spark, sf_dir):
    return A.coverage(*_audited(spark, sf_dir))


@query(with_(DAILY, HOURLY) + "SELECT 'daily_bars' AS table_name, max(make_timestamp(timestamp * 1000)::DATE) AS latest_date FROM daily UNION ALL SELECT 'hourly_bars', max(make_timestamp(timestamp * 1000)::DATE) FROM hourly")
def audit_latest(spark, sf_dir):
    return A.latest_dates({"daily_bars": daily_bars(spark, sf_dir), "hourly_bars": hourly_bars(spark, sf_dir)})


_DAY = "2001-06-01"


@query(_PAIR + f", b AS (SELECT * FROM target UNION ALL SELECT * FROM stage), g AS (SELECT ticker, make_timestamp(timestamp * 1000)::DATE AS d, count(*) AS n, count(*) FILTER (transactions IS NULL) AS p FROM b GROUP BY ALL) SELECT count(*) FILTER (n > 1) AS duplicate_dates, coalesce(sum(p) FILTER (d = DATE '{_DAY}'), 0)::BIGINT AS provisional_today, coalesce(sum(p) FILTER (d > DATE '{_DAY}'), 0)::BIGINT AS provisional_future FROM g")
def audit_provisional(spark, sf_dir):
    target, stage = _both(spark, sf_dir)
    return A.provisional(target.unionByName(stage), _DAY)


@query(_PAIR + f"SELECT 'daily_bars' AS table_name, count(*) AS duplicate_keys FROM (SELECT 1 FROM target GROUP BY ticker, timestamp HAVING count(*) > 1) UNION ALL SELECT 'stage', count(*) FROM (SELECT 1 FROM stage GROUP BY ticker, timestamp // {DAY} HAVING count(*) > 1)")
def audit_duplicates(spark, sf_dir):
    target, stage = _both(spark, sf_dir)
    return A.duplicates({"daily_bars": (target, ["ticker", "timestamp"]), "stage": (stage.withColumn("d", M.utc_date()), ["ticker", "d"])})


@query(_TABLES + f""", c AS ({_COVER}), l AS (SELECT max(make_timestamp(timestamp * 1000)::DATE) AS d FROM daily)
SELECT 'empty table' AS issue, table_name, 0.0::DOUBLE AS value, 1.0::DOUBLE AS threshold FROM c WHERE n_rows = 0
UNION ALL SELECT 'coverage', table_name, pct, 95.0 FROM c WHERE pct < 95 UNION ALL SELECT 'stale', 'daily', date_diff('day', d, DATE '2026-01-01'), 7 FROM l WHERE date_diff('day', d, DATE '2026-01-01') > 7""")
def audit_issues(spark, sf_dir):
    universe, tables = _audited(spark, sf_dir)
    covered = A.coverage(universe, tables)
    daily = tables["daily"]
    return A.issues(covered, dict.fromkeys(tables, 95.0), A.latest_dates({"daily": daily}), "2026-01-01", {"daily": 7}, A.duplicates({"daily": (daily, ["ticker", "timestamp"])}))


@query(with_(HOURLY, DAILY) + "SELECT 'hourly' AS probe, (1706461200000 - max(timestamp)) / 3600000.0 AS age_hours, 80 AS threshold, (1706461200000 - max(timestamp)) / 3600000.0 <= 80 AS fresh FROM hourly UNION ALL SELECT 'daily', (1706461200000 - max(timestamp)) / 3600000.0, 80, (1706461200000 - max(timestamp)) / 3600000.0 <= 80 FROM daily")
def audit_freshness(spark, sf_dir):
    return A.freshness({"hourly": hourly_bars(spark, sf_dir), "daily": daily_bars(spark, sf_dir)}, "2024-01-28 17:00:00")


@query(with_(DAILY, VIEW_DAILY) + "SELECT * FROM view_daily WHERE ticker = '7' ORDER BY timestamp DESC LIMIT 1")
def audit_probe(spark, sf_dir):
    return A.probe(V.daily(daily_bars(spark, sf_dir)), "7")


@query(with_(DAILY, HOURLY, FOUR_HOURS) + """, u AS (SELECT 'daily' AS timeframe, ticker, timestamp FROM daily UNION ALL SELECT '1h', ticker, timestamp FROM hourly UNION ALL SELECT '4h', ticker, timestamp FROM four),
n AS (SELECT *, row_number() OVER (PARTITION BY timeframe, ticker ORDER BY timestamp) AS rn FROM u)
SELECT timeframe, count(*) AS n_rows, count(DISTINCT ticker) AS tickers, min(timestamp) AS first_ts, max(timestamp) AS last_ts FROM n WHERE rn >= 200 GROUP BY timeframe""")
def audit_indicator_stats(spark, sf_dir):
    d, h = I.backfill(daily_bars(spark, sf_dir, dealt=True), "daily"), I.backfill(hourly_bars(spark, sf_dir), "1h")
    four = I.backfill(B.four_hours(hourly_bars(spark, sf_dir)), "4h")
    return A.statistics(d.select("ticker", "timestamp", "timeframe").unionByName(h.select("ticker", "timestamp", "timeframe")).unionByName(four.select("ticker", "timestamp", "timeframe")))


# volume profiles: minutes of the events

_MIN = "minutes AS (SELECT event_type AS ticker, epoch_us(ts) // 60000000 * 60000 AS minute_ts, count(*)::DOUBLE AS volume FROM events GROUP BY ALL)"
_CUM = "cum AS (SELECT *, sum(volume) OVER (PARTITION BY ticker, d ORDER BY minute ROWS UNBOUNDED PRECEDING) AS cum_vol FROM (SELECT ticker, make_timestamp(minute_ts * 1000)::DATE AS d, minute_ts // 60000 % 1440 AS minute, volume FROM {0}))"
_PROFILE = """prof AS (SELECT ticker, (bin - 240)::INTEGER AS et_minute, round_even(a, 0)::BIGINT AS avg, round_even(s, 0)::BIGINT AS std, CASE WHEN a > 0 THEN round_even(round(s / a * 100, 9), 1) ELSE 0.0 END AS cv_pct,
 round_even(v[n // 4 + 1], 0)::BIGINT AS p25, round_even(v[3 * n // 4 + 1], 0)::BIGINT AS p75, n AS count, round_even(a * 1.5, 0)::BIGINT AS above_15x, round_even(a * 0.5, 0)::BIGINT AS below_05x
 FROM (SELECT ticker, minute // 5 * 5 AS bin, count(*) AS n, avg(cum_vol) AS a, sqrt(greatest(count(*) * sum(cum_vol * cum_vol) - sum(cum_vol) * sum(cum_vol), 0)) / count(*) AS s, list_sort(list(cum_vol)) AS v FROM cum GROUP BY ALL) WHERE n >= 3 AND bin >= 240)"""
_PROF = with_(_MIN, _CUM.format("minutes"), _PROFILE)


def _minutes(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.col("event_type").alias("ticker"), F.expr("unix_millis(cast(ts as timestamp)) div 60000 * 60000").alias("minute_ts")).agg(F.count("*").cast("double").alias("volume"))


@query(_PROF + "SELECT * FROM prof")
def volume_profile(spark, sf_dir):
    return P.profile(_minutes(spark, sf_dir))


_TIME = "printf('%02d:%02d', et_minute // 60, et_minute % 60) AS time"


@query(_PROF + f"SELECT *, {_TIME} FROM prof WHERE et_minute IN (570, 630, 720, 780, 840, 900, 930)")
def volume_milestones(spark, sf_dir):
    return P.milestones(P.profile(_minutes(spark, sf_dir)))


@query(with_(_MIN, _CUM.format("minutes"), _PROFILE) + f""", today AS (SELECT ticker, minute - 240 AS et_minute, max(cum_vol) AS now FROM cum WHERE d = (SELECT max(d) FROM cum) GROUP BY ALL),
j AS (SELECT p.ticker, {_TIME.replace('et_minute', 'p.et_minute')}, coalesce(now, 0.0) AS now, avg, CASE WHEN avg > 0 THEN coalesce(now, 0.0) / avg ELSE 0 END AS ratio FROM prof p LEFT JOIN today t ON p.ticker = t.ticker AND p.et_minute = t.et_minute WHERE p.et_minute IN (570, 630, 720, 780, 840, 900, 930))
SELECT ticker, time, round_even(now, 0)::BIGINT AS today_cum_vol, avg AS avg_cum_vol, round_even(ratio, 2) AS ratio, CASE WHEN ratio > 1.5 THEN 'above' WHEN ratio < 0.5 THEN 'below' ELSE 'normal' END AS signal FROM j""")
def volume_signal(spark, sf_dir):
    minutes = _minutes(spark, sf_dir)
    last = minutes.agg(F.max(F.expr(f"minute_ts div {DAY}")).alias("_d"))
    today = minutes.join(F.broadcast(last), F.expr(f"minute_ts div {DAY} = _d")).drop("_d")
    return P.signal(P.profile(minutes), today)


@query(with_(HOURLY) + """SELECT upper(ticker || '-' || timestamp) AS symbol, CASE WHEN timestamp // 3600000 % 9 = 0 THEN NULL ELSE coalesce(CASE WHEN timestamp // 3600000 % 2 = 0 THEN close END, CASE WHEN timestamp // 3600000 % 3 = 0 THEN open END, high) END AS price,
 CASE WHEN timestamp // 3600000 % 9 = 0 THEN NULL WHEN timestamp // 3600000 % 2 = 0 THEN 'snapshot.lastTrade.p' WHEN timestamp // 3600000 % 3 = 0 THEN 'snapshot.min.c' ELSE 'snapshot.day.c' END AS source,
 CASE WHEN timestamp // 3600000 % 9 = 0 THEN NULL WHEN timestamp // 3600000 % 2 = 0 THEN timestamp + 1 ELSE timestamp END AS timestamp, CASE WHEN timestamp // 3600000 % 9 = 0 THEN 'ERROR' ELSE 'OK' END AS status FROM hourly""")
def best_price(spark, sf_dir):
    h = F.expr(f"timestamp div {HOUR}")
    none = F.lit(None).cast("double")
    rows = hourly_bars(spark, sf_dir).select(
        F.when(h % 9 == 0, "ERROR").otherwise("OK").alias("status"),
        F.struct(
            F.concat_ws("-", "ticker", "timestamp").alias("ticker"), F.col("timestamp").alias("updated"),
            F.struct(F.when(h % 2 == 0, F.col("close")).otherwise(0.0).alias("p"), (F.col("timestamp") + 1).alias("t")).alias("lastTrade"),
            F.struct(F.when(h % 3 == 0, F.col("open")).otherwise(none).alias("c"), F.lit(0).cast("long").alias("t")).alias("min"),
            F.struct(F.col("high").alias("c")).alias("day"), F.struct(F.col("low").alias("c")).alias("prevDay"),
        ).alias("ticker"),
    )
    return P.best_price(rows)
