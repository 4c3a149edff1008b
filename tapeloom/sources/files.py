"""Bars, reference rows and lists from JSON, CSV and text files.

Fields are read with a schema, so files are scanned once, a field that a file
lacks is null, and only the fields asked for are parsed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import clean, symbol
from .folders import exists

RAW_BAR = "_ticker string, t bigint, o double, h double, l double, c double, v double, vw double, n int"
BAR_FIELDS = {"_ticker": "ticker", "t": "timestamp", "o": "open", "h": "high", "l": "low", "c": "close", "v": "volume", "vw": "vwap", "n": "transactions"}
DETAILS = "ticker string, name string, market_cap double, exchange string, sic_code string, sic_description string, employees int, shares_outstanding double, list_date string, currency string, last_updated bigint"
#: Raw fields of each kind of API result, and the columns they become.
API_FIELDS = {
    "weekly": {"_ticker": "ticker string", "t": "timestamp bigint", "o": "open double", "h": "high double", "l": "low double", "c": "close double", "v": "volume double", "vw": "vwap double", "n": "transactions int"},
    "dividends": {"_ticker": "ticker string", "ex_dividend_date": "ex_dividend_date date", "cash_amount": "cash_amount double", "declaration_date": "declaration_date date", "pay_date": "pay_date date", "record_date": "record_date date", "frequency": "frequency int", "dividend_type": "dividend_type string", "currency": "currency string"},
    "splits": {"_ticker": "ticker string", "execution_date": "execution_date date", "split_from": "split_from int", "split_to": "split_to int"},
    "details": {"_ticker": "ticker string", "name": "name string", "market_cap": "market_cap double", "primary_exchange": "exchange string", "sic_code": "sic_code string", "sic_description": "sic_description string", "total_employees": "employees int", "weighted_shares_outstanding": "shares_outstanding double", "list_date": "list_date date", "currency_name": "currency string"},
}


def ndjson_bars(spark: SparkSession, path: str) -> DataFrame:
    """Bars of newline-delimited JSON under their short field names."""
    return spark.read.schema(RAW_BAR).json(path).select(*(F.col(a).alias(b) for a, b in BAR_FIELDS.items()))


def tolerant(spark: SparkSession, path: str, columns: dict[str, str], keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of newline-delimited JSON, and the lines that are none.

    Every column of ``columns`` (name: type) is read as text and cast; what does
    not cast, or is missing in a file, is null. Rows that lack a key are dropped.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns] + [T.StructField("_corrupt_record", T.StringType())])
    raw = spark.read.text(path).where(F.btrim("value") != "")
    lines = raw.select(F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}).alias("r")).select("r.*")
    ok = lines.where("_corrupt_record IS NULL").select(*(F.col(c).try_cast(t).alias(c) for c, t in columns.items()))
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return ok.where(whole), lines.where("_corrupt_record IS NOT NULL").select("_corrupt_record")


def records(spark: SparkSession, path: str, key: str, schema: str) -> DataFrame:
    """The rows that a JSON document holds in a list under ``key``, with their place ``ordinal``.

    A document that is missing, or has something else under the key, has no rows.
    """
    row = T._parse_datatype_string(schema)
    if not exists(spark, path):
        return spark.createDataFrame([], T.StructType([T.StructField("ordinal", T.IntegerType()), *row.fields]))
    whole = T.StructType([T.StructField(key, T.ArrayType(row))])
    return spark.read.schema(whole).option("multiLine", True).json(path).select(F.posexplode(key).alias("ordinal", "row")).select("ordinal", "row.*")


def csv_universe(spark: SparkSession, path: str) -> DataFrame:
    """Distinct tickers of a CSV file's first column."""
    lines = spark.read.option("header", True).csv(path)
    return lines.select(symbol(F.col(f"`{lines.columns[0]}`")).alias("ticker")).where("ticker IS NOT NULL").distinct()


def csv_sector_map(spark: SparkSession, path: str) -> DataFrame:
    """``(ticker, sector, industry, source)``, cleaned; rows without a ticker, or with neither sector nor industry, are dropped."""
    rows = spark.read.schema("ticker string, sector string, industry string, source string").option("header", True).csv(path)
    rows = rows.select(symbol(F.col("ticker")).alias("ticker"), *(clean(F.col(c)).alias(c) for c in ("sector", "industry", "source")))
    return rows.where("ticker IS NOT NULL AND coalesce(sector, industry) IS NOT NULL")


def api_rows(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """API results of one kind (a key of API_FIELDS) as table rows."""
    fields = API_FIELDS[kind]
    raw = spark.read.schema(", ".join(f"{f} string" for f in fields)).json(path)

    def column(field: str, to: str) -> Column:
        name, kind_ = to.split()
        return F.col(field).try_cast(kind_).alias(name)

    return raw.select(*(column(f, to) for f, to in fields.items())).where("ticker IS NOT NULL")


def ticker_details(spark: SparkSession, path: str) -> DataFrame:
    """Details of newline-delimited JSON; the list date is text in the file."""
    return spark.read.schema(DETAILS).json(path).withColumn("list_date", F.col("list_date").try_cast("date"))


def ticker_list(spark: SparkSession, path: str) -> DataFrame:
    """``(ticker, place)``: distinct tickers of a text of lines and commas, numbered as first seen."""
    whole = spark.read.text(path, wholetext=True)
    seen = whole.select(F.posexplode(F.split("value", "[,\\r\\n]")).alias("at", "x")).select("at", symbol(F.col("x")).alias("ticker"))
    first = seen.where("ticker IS NOT NULL").groupBy("ticker").agg(F.min("at").alias("at"))
    places = first.agg(F.array_sort(F.collect_list(F.struct("at", "ticker"))).alias("all"))  # a list that is typed by hand
    return places.select(F.posexplode("all").alias("place", "x")).select("x.ticker", "place")


def near(rows: DataFrame, column: str, today: Column, before: int = 45, after: int = 370) -> DataFrame:
    """Rows dated from ``before`` days before ``today`` to ``after`` days after it."""
    return rows.where(F.col(column).between(F.date_sub(today, before), F.date_add(today, after)))
