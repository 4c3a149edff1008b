"""Quality gates as DataFrames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .merge import utc_date


def _stack(rows: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, rows)


def coverage(universe: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """For each table: rows, universe tickers covered and missing, percent covered."""
    total = universe.select("ticker").distinct()

    def one(name: str, df: DataFrame) -> DataFrame:
        per = df.groupBy("ticker").agg(F.count("*").alias("n"))
        both = total.withColumn("_u", F.lit(1)).join(per, "ticker", "full_outer")
        return both.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count_if(F.col("_u").isNotNull() & F.col("n").isNotNull()).alias("covered"), F.count_if(F.col("_u").isNotNull() & F.col("n").isNull()).alias("missing")).select(
            F.lit(name).alias("table_name"), "n_rows", "covered", "missing", (100.0 * F.col("covered") / F.nullif(F.col("covered") + F.col("missing"), F.lit(0))).alias("pct")
        )

    return _stack([one(n, d) for n, d in tables.items()])


def latest_dates(tables: dict[str, DataFrame]) -> DataFrame:
    return _stack([df.agg(F.max(utc_date()).alias("latest_date")).select(F.lit(n).alias("table_name"), "latest_date") for n, df in tables.items()])


def provisional(bars: DataFrame, today: str) -> DataFrame:
    """Duplicate (ticker, UTC date) groups, and rows without a transaction count dated today or later."""
    day = F.lit(today).cast("date")
    dated = bars.withColumn("_d", utc_date())
    groups = dated.groupBy("ticker", "_d").agg(F.count("*").alias("n"), F.count_if(F.col("transactions").isNull()).alias("p"))
    return groups.agg(
        F.count_if(F.col("n") > 1).alias("duplicate_dates"),
        F.coalesce(F.sum(F.when(F.col("_d") == day, F.col("p"))), F.lit(0)).alias("provisional_today"),
        F.coalesce(F.sum(F.when(F.col("_d") > day, F.col("p"))), F.lit(0)).alias("provisional_future"),
    )


def duplicates(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """How many keys of each table occur more than once."""
    return _stack([df.groupBy(*keys).count().where("count > 1").agg(F.count("*").alias("duplicate_keys")).select(F.lit(n).alias("table_name"), "duplicate_keys") for n, (df, keys) in tables.items()])


def issues(covered: DataFrame, least: dict[str, float], latest: DataFrame, today: str, most_days: dict[str, int], dups: DataFrame) -> DataFrame:
    """``(issue, table_name, value, threshold)``: empty tables, coverage below its threshold, stale tables, duplicate keys."""
    pairs = lambda d: F.create_map(*[F.lit(x) for k, v in d.items() for x in (k, float(v))])
    row = lambda df, issue, value, threshold: df.select(F.lit(issue).alias("issue"), "table_name", value.cast("double").alias("value"), threshold.cast("double").alias("threshold"))
    empty = row(covered.where("n_rows = 0"), "empty table", F.col("n_rows"), F.lit(1))
    bound = pairs(least)[F.col("table_name")]
    thin = row(covered.where(F.col("pct") < bound), "coverage", F.col("pct"), bound)
    age, limit = F.date_diff(F.lit(today).cast("date"), F.col("latest_date")), pairs(most_days)[F.col("table_name")]
    old = row(latest.where(age > limit), "stale", age, limit)
    twice = row(dups.where("duplicate_keys > 0"), "duplicate keys", F.col("duplicate_keys"), F.lit(0))
    return _stack([empty, thin, old, twice])


def allowed_hours(as_of: Column, weekend: int = 80, weekday: int = 30) -> Column:
    """Hours that data may be old: more on a weekend in New York."""
    return F.when(F.dayofweek(F.from_utc_timestamp(as_of, "America/New_York")).isin(1, 7), weekend).otherwise(weekday)


def freshness(probes: dict[str, DataFrame], as_of: str) -> DataFrame:
    """Age in hours of each probe's newest bar against the threshold for the time of ``as_of``."""
    now = F.lit(as_of).cast("timestamp")
    rows = _stack([df.agg(F.max("timestamp").alias("t")).select(F.lit(n).alias("probe"), "t") for n, df in probes.items()])
    age = (F.unix_millis(now) - F.col("t")) / 3_600_000.0
    return rows.select("probe", age.alias("age_hours"), allowed_hours(now).alias("threshold"), F.coalesce(age <= allowed_hours(now), F.lit(False)).alias("fresh"))  # no data is not fresh


def probe(view: DataFrame, ticker: str) -> DataFrame:
    """The newest row of one ticker."""
    return view.where(F.col("ticker") == ticker).orderBy(F.desc("timestamp")).limit(1)


def statistics(indicators: DataFrame) -> DataFrame:
    """Rows, tickers, and first and last bar of each timeframe."""
    return indicators.groupBy("timeframe").agg(F.count("*").alias("n_rows"), F.countDistinct("ticker").alias("tickers"), F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"))


def factor_gates(universe: DataFrame, scores: DataFrame, ideas: DataFrame, least_cap: float = 5e9) -> DataFrame:
    """Named checks of the factor views: ``(name, value, ok)``."""
    theme = F.col("production_theme")
    leak = theme.ilike("%macro%") | theme.ilike("%inflation%") | theme.ilike("%labor%")
    n = [df.agg(F.count("*").alias("value")).select(F.lit(k).alias("name"), "value") for k, df in (("sector_universe_rows", universe), ("production_score_rows", scores), ("relative_long_idea_rows", ideas))]
    n.append(scores.agg(F.count_if(F.coalesce(F.col("market_cap") <= least_cap, F.lit(True))).alias("value")).select(F.lit("market_cap_filter_violations").alias("name"), "value"))
    n.append(scores.agg(F.count_if(leak).alias("value")).select(F.lit("macro_theme_violations").alias("name"), "value"))
    ok = F.when(F.col("name").endswith("violations"), F.col("value") == 0).otherwise(F.col("value") > 0)
    return _stack(n).withColumn("ok", ok)


def latest_runs(runs: DataFrame, most: int = 3) -> DataFrame:
    """The last runs by date."""
    return runs.orderBy(F.desc("as_of_date")).limit(most)


ISSUE = "issue string, table_name string, value double, threshold double"


def missing_tables(spark: SparkSession, required: list[str], present: list[str]) -> DataFrame:
    """An issue for each required table that is not there."""
    return spark.createDataFrame([("missing table", t, 0.0, 1.0) for t in required if t not in present], ISSUE)


def _issue(rows: DataFrame, issue: str, table: Column, value: Column, threshold: Column) -> DataFrame:
    return rows.select(F.lit(issue).alias("issue"), table.alias("table_name"), value.cast("double").alias("value"), threshold.cast("double").alias("threshold"))


def behind(latest: DataFrame, table: str, source: str) -> DataFrame:
    """An issue if a table ends before the one that it is made from: by how many days."""
    ends = latest.agg(F.max(F.when(F.col("table_name") == table, F.col("latest_date"))).alias("a"), F.max(F.when(F.col("table_name") == source, F.col("latest_date"))).alias("b"))
    return _issue(ends.where("a < b"), "behind its source", F.lit(table), F.date_diff("b", "a"), F.lit(0))


def future_provisional(counted: DataFrame, table: str) -> DataFrame:
    """An issue if bars without a transaction count are dated in the future, from ``provisional``'s row."""
    return _issue(counted.where("provisional_future > 0"), "future provisional rows", F.lit(table), F.col("provisional_future"), F.lit(0))


def short_runs(runs: DataFrame, universe: DataFrame, counts: list[str], share: float = 0.95) -> DataFrame:
    """Issues of the last run: counts below ``share`` of the universe, and indicators that end before the prices."""
    last = latest_runs(runs, 1)
    total = universe.agg(F.floor(F.count_distinct("ticker") * share).alias("least"))
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("n")) for c in counts))).alias("x")
    low = last.select(each).join(F.broadcast(total), F.lit(True)).where("x.n < least")  # one row
    late = last.where("max_calc_indicator_date < max_price_date")
    return _issue(low, "run below the universe", F.col("x.name"), F.col("x.n"), F.col("least")).unionByName(_issue(late, "run behind its prices", F.lit("max_calc_indicator_date"), F.date_diff("max_price_date", "max_calc_indicator_date"), F.lit(0)))


def strict(*parts: DataFrame) -> DataFrame:
    """All issues; a job that must not go on with any fails if there is a row."""
    return _stack(list(parts))


def view_probes(indicator_views: dict[str, tuple[DataFrame, str]], summary_views: dict[str, DataFrame]) -> DataFrame:
    """A bounded look at each view: the newest row of one ticker, or whether there is any row."""
    newest = [probe(view, t).select(F.lit(n).alias("view_name"), "ticker", "close", "sma_20", "sma_50", "sma_200", F.lit(True).alias("has_row")) for n, (view, t) in indicator_views.items()]
    any_ = [view.limit(1).agg((F.count("*") > 0).alias("has_row")).select(F.lit(n).alias("view_name"), "has_row") for n, view in summary_views.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), newest + any_)


def spike_count(view: DataFrame, ticker: str) -> DataFrame:
    return view.where((F.col("ticker") == ticker) & F.col("volume_spike")).agg(F.count("*").alias("spikes")).select(F.lit(ticker).alias("ticker"), "spikes")
