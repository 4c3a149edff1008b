"""Queries over file sources and sinks: the given tables are written in the format in question and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import bars as B
from ..operators import views as V
from ..registry import query
from ..sinks import tables as S
from ..sources import files as R
from ..sources.folders import fresh
from ..sources.tables import DAY, companies, daily_bars, hourly_bars, table
from .q_bars import VIEW_DAILY
from .sql import COMPANIES, DAILY, HOURLY, with_

_BAR = "ticker, timestamp, open, high, low, close, volume, vwap, transactions"


@query(with_(DAILY) + f"SELECT {_BAR} FROM daily")
def src_ndjson_bars(spark, sf_dir):
    path = fresh(spark, "bars-ndjson")
    raw = daily_bars(spark, sf_dir).select(*(F.col(b).alias(a) for a, b in R.BAR_FIELDS.items()))
    odd = F.expr(f"t div {DAY} % 2 = 1")
    S.append_ndjson(raw.where(odd), path)
    S.append_ndjson(raw.where(~odd), path)
    return R.ndjson_bars(spark, path)


def _dividends(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 11 != 0, F.col("o_custkey").cast("string")).alias("ticker"), F.col("o_orderkey").alias("no"),
        F.col("o_orderdate").cast("date").cast("string").alias("ex_dividend_date"), F.col("o_totalprice").alias("cash_amount"),
        (F.col("o_orderkey") % 4).cast("int").alias("frequency"), F.col("o_orderstatus").alias("dividend_type"),
    )


_TODAY = "DATE '1997-06-01'"


@query(f"""SELECT o_custkey::VARCHAR AS ticker, o_orderkey AS no, o_orderdate::DATE AS ex_dividend_date, o_totalprice AS cash_amount, (o_orderkey % 4)::INTEGER AS frequency
FROM orders WHERE o_orderkey % 11 <> 0 AND o_orderkey % 7 <> 0 AND o_orderdate::DATE BETWEEN {_TODAY} - 45 AND {_TODAY} + 370""")
def src_ndjson_faulty(spark, sf_dir):
    """Every seventh line is cut off, every eleventh row has no key; rows within the window of dates stay."""
    path = fresh(spark, "dividends-faulty")
    line = F.to_json(F.struct("ticker", "no", "ex_dividend_date", "cash_amount", "frequency"))
    lines = _dividends(spark, sf_dir).select(F.when(F.col("no") % 7 == 0, F.left(line, F.length(line) - 3)).otherwise(line).alias("value"))
    lines.write.text(path)
    rows, _ = R.tolerant(spark, path, {"ticker": "string", "no": "bigint", "ex_dividend_date": "date", "cash_amount": "double", "frequency": "int"}, ["ticker"])
    return R.near(rows, "ex_dividend_date", F.lit("1997-06-01").cast("date"))


@query("""SELECT coalesce(o_custkey % 5 = 0, false) AS bad_date, count(*) AS n, count(frequency) AS with_frequency, count(d) AS with_date, count(dividend_type) AS with_type
FROM (SELECT *, CASE WHEN o_orderkey % 2 = 0 THEN 1 END AS frequency, CASE WHEN o_custkey % 5 <> 0 THEN o_orderdate END AS d, CASE WHEN o_orderkey % 2 = 1 THEN o_orderstatus END AS dividend_type FROM orders WHERE o_orderkey % 11 <> 0) GROUP BY ALL""")
def src_ndjson_evolving(spark, sf_dir):
    """Files with other fields than each other, and dates that are none."""
    path = fresh(spark, "dividends-evolving")
    rows = _dividends(spark, sf_dir).withColumn("ex_dividend_date", F.when(F.col("ticker").cast("long") % 5 == 0, "n/a").otherwise(F.col("ex_dividend_date")))
    S.append_ndjson(rows.where("no % 2 = 0").drop("dividend_type"), path)
    S.append_ndjson(rows.where("no % 2 = 1").drop("frequency"), path)
    read, _ = R.tolerant(spark, path, {"ticker": "string", "no": "bigint", "ex_dividend_date": "date", "frequency": "int", "dividend_type": "string"}, ["ticker"])
    bad = F.coalesce(F.col("ticker").cast("long") % 5 == 0, F.lit(False)).alias("bad_date")
    return read.groupBy(bad).agg(F.count("*").alias("n"), F.count("frequency").alias("with_frequency"), F.count("ex_dividend_date").alias("with_date"), F.count("dividend_type").alias("with_type"))


@query("SELECT s_suppkey AS no, s_suppkey::VARCHAR AS ticker, s_name AS name, s_acctbal AS \"valUSD\" FROM supplier")
def src_json_rows(spark, sf_dir):
    """Rows in a list inside one document."""
    path = fresh(spark, "holdings-json")
    rows = companies(spark, sf_dir).select("ticker", "name", (F.col("market_cap") / 1e8).alias("valUSD"), "no")
    listed = F.array_sort(F.collect_list(F.struct(F.col("no"), "ticker", "name", "valUSD")))
    rows.agg(listed.alias("tickers")).select(F.to_json(F.struct("tickers")).alias("value")).write.text(path)
    return R.records(spark, path, "tickers", "no bigint, ticker string, name string, valUSD double").select("no", "ticker", "name", F.round("valUSD", 2).alias("valUSD"))


@query("SELECT DISTINCT upper(n_name) AS ticker FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 7 <> 0")
def src_csv_universe(spark, sf_dir):
    """Tickers in any case, with blanks around them or nothing but blanks."""
    path = fresh(spark, "universe-csv")
    rows = companies(spark, sf_dir)
    spelled = F.when(F.col("no") % 7 == 0, "  ").when(F.col("no") % 2 == 0, F.concat(F.lit("  "), F.lower("industry"))).otherwise(F.concat("industry", F.lit(" ")))
    rows.select(spelled.alias("Symbol"), "name").write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return R.csv_universe(spark, path)


@query("""SELECT s_suppkey::VARCHAR AS ticker, CASE WHEN s_suppkey % 3 <> 0 THEN r_name END AS sector, n_name AS industry, CASE s_suppkey % 3 WHEN 0 THEN 'sp500' WHEN 1 THEN 'sec-sic' END AS source
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE s_suppkey % 10 <> 9""")
def src_csv_sector_map(spark, sf_dir):
    path = fresh(spark, "sectors-csv")
    no = F.col("no")
    rows = companies(spark, sf_dir).select(
        F.when(no % 10 != 9, F.concat(F.lit(" "), "ticker")).alias("ticker"), F.when(no % 3 != 0, F.col("exchange")).otherwise(" ").alias("sector"), "industry",
        F.when(no % 3 == 0, "sp500").when(no % 3 == 1, "sec-sic").alias("source"),
    )
    rows.write.option("header", True).csv(path)
    return R.csv_sector_map(spark, path)


@query(with_(COMPANIES) + """SELECT ticker, name, round(market_cap)::BIGINT AS market_cap, exchange, sic_code, industry AS sic_description, CASE WHEN no % 4 <> 0 THEN (no * 3)::INTEGER END AS employees, shares_outstanding,
 CASE WHEN no % 5 <> 0 THEN DATE '2000-01-01' + (no % 1000)::INTEGER END AS list_date, 'usd' AS currency FROM companies WHERE no % 13 <> 0""")
def src_api_details(spark, sf_dir):
    """Raw API results with their vendor's field names; some without a ticker, a date or a count."""
    path = fresh(spark, "details-api")
    no = F.col("no")
    raw = companies(spark, sf_dir).select(
        F.when(no % 13 != 0, F.col("ticker")).alias("_ticker"), "name", F.round("market_cap").cast("bigint").alias("market_cap"), F.col("exchange").alias("primary_exchange"), "sic_code",
        F.col("industry").alias("sic_description"), F.when(no % 4 != 0, no * 3).alias("total_employees"), F.col("shares_outstanding").alias("weighted_shares_outstanding"),
        F.when(no % 5 != 0, F.date_add(F.lit("2000-01-01").cast("date"), (no % 1000).cast("int")).cast("string")).otherwise("soon").alias("list_date"), F.lit("usd").alias("currency_name"),
    )
    S.append_ndjson(raw, path)
    return R.api_rows(spark, path, "details").withColumn("market_cap", F.round("market_cap").cast("bigint"))


@query(with_(COMPANIES) + "SELECT ticker, name, sic_code, shares_outstanding, DATE '2000-01-01' + (no % 1000)::INTEGER AS list_date, no * 1000 AS last_updated FROM companies")
def src_ticker_details(spark, sf_dir):
    path = fresh(spark, "details-ndjson")
    day = F.date_add(F.lit("2000-01-01").cast("date"), (F.col("no") % 1000).cast("int")).cast("string")
    S.append_ndjson(companies(spark, sf_dir).select("ticker", "name", "sic_code", "shares_outstanding", day.alias("list_date"), (F.col("no") * 1000).alias("last_updated")), path)
    return R.ticker_details(spark, path).select("ticker", "name", "sic_code", "shares_outstanding", "list_date", "last_updated")


@query("""SELECT ticker, (row_number() OVER (ORDER BY first))::INTEGER - 1 AS place FROM (SELECT upper(n_name) AS ticker, min(s_suppkey) AS first FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL)""")
def src_ticker_text(spark, sf_dir):
    """One text of lines and commas in which names come again in other cases."""
    path = fresh(spark, "tickers-text")
    names = companies(spark, sf_dir).select("no", F.when(F.col("no") % 2 == 0, F.lower("industry")).otherwise(F.col("industry")).alias("x"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("no", "x"))), lambda r: F.concat(r["x"], F.when(r["no"] % 3 == 0, " ,").otherwise("\n "))), "")
    names.agg(text.alias("value")).write.text(path)
    return R.ticker_list(spark, path)


@query("""SELECT "table", count(*) AS n, min(x) AS least FROM (SELECT 'cast' AS "table", s_suppkey AS x FROM supplier UNION ALL SELECT 'history', o_orderkey FROM orders UNION ALL SELECT 'history', o_orderkey FROM orders WHERE o_orderkey % 2 = 0) GROUP BY ALL""")
def snk_replace_and_append(spark, sf_dir):
    """A table that is written twice holds the second rows alone; a history holds all."""
    once, history = fresh(spark, "replaced"), fresh(spark, "history")
    rows, orders = companies(spark, sf_dir), table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("x"))
    for part in (rows.where("no % 2 = 0"), rows):
        S.replace_table(part.select(F.col("ticker").alias("x"), "name"), once, {"x": "bigint", "name": "string"})
    S.append_history(orders, history)
    S.append_history(orders.where("x % 2 = 0"), history)
    both = spark.read.parquet(once).select(F.lit("cast").alias("table"), "x").unionByName(spark.read.parquet(history).select(F.lit("history").alias("table"), "x"))
    return both.groupBy("table").agg(F.count("*").alias("n"), F.min("x").alias("least"))


@query("""SELECT event_type AS ticker, ts::DATE AS as_of_date, CASE WHEN epoch_us(ts) // 86400000000 % 3 = 0 THEN 'second' ELSE 'first' END AS run, count(*) AS n
FROM events WHERE NOT (epoch_us(ts) // 86400000000 % 3 = 0 AND event_id % 2 = 1) GROUP BY ALL""")
def snk_partition_replace(spark, sf_dir):
    """Every third date is written again with half of its rows."""
    path = fresh(spark, "partitions")
    rows = table(spark, sf_dir, "events").select(F.col("event_type").alias("ticker"), "event_id", F.to_date("ts").alias("as_of_date"), F.expr(f"unix_millis(cast(ts as timestamp)) div {DAY}").alias("day"))
    S.replace_partitions(rows.withColumn("run", F.lit("first")).drop("day"), path)
    S.replace_partitions(rows.where("day % 3 = 0 AND event_id % 2 = 0").withColumn("run", F.lit("second")).drop("day"), path)
    return spark.read.parquet(path).groupBy("ticker", "as_of_date", "run").agg(F.count("*").alias("n"))


@query("""SELECT o_orderkey AS no, o_totalprice AS price, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS status, CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS priority FROM orders""")
def snk_schema_evolve(spark, sf_dir):
    """The second append has a column more, one fewer, and a narrower type."""
    path = fresh(spark, "evolved")
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("no"), F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    S.evolve(spark, rows.where("no % 2 = 0").drop("priority"), path)
    return S.evolve(spark, rows.where("no % 2 = 1").drop("status").withColumn("no", F.col("no").cast("int")), path).select("no", "price", "status", "priority")


@query(with_(DAILY, VIEW_DAILY) + "SELECT d.ticker, d.timestamp, d.sma_20, b.close FROM view_daily d JOIN daily b ON d.ticker = b.ticker AND d.timestamp = b.timestamp WHERE d.volume_spike")
def snk_views(spark, sf_dir):
    """A family of views, queried by name and dropped again."""
    daily = daily_bars(spark, sf_dir)
    S.create_views(spark, {"tl_daily_bars": lambda: daily, "tl_view_daily": lambda: V.daily(daily)})
    S.require(spark, ["tl_daily_bars", "tl_view_daily"])
    out = spark.sql("SELECT d.ticker, d.timestamp, d.sma_20, b.close FROM tl_view_daily d JOIN tl_daily_bars b ON d.ticker = b.ticker AND d.timestamp = b.timestamp WHERE d.volume_spike")
    S.drop_views(spark, ["tl_daily_bars", "tl_view_daily"])
    return out


@query("SELECT o_custkey AS ticker, o_orderdate::DATE AS calendar_date, o_totalprice AS revenue, o_orderkey AS no FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate::DATE DESC, o_orderkey) <= 4")
def financials_newest(spark, sf_dir):
    """The four newest reports of each company."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("ticker"), F.col("o_orderdate").cast("date").alias("calendar_date"), F.col("o_totalprice").alias("revenue"), F.col("o_orderkey").alias("no"))
    return V.newest_first(rows, "ticker", 4, F.desc("calendar_date"), F.col("no"))
