"""Queries over news, keywords, classification and the enriched snapshot."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.ranking import cut
from ..operators import audit as A
from ..operators import classify as C
from ..operators import indicators as I
from ..operators import keywords as K
from ..operators import snapshot as S
from ..registry import query
from ..sources.tables import companies, daily_bars, table
from . import fixed as W
from .q_bars import VIEW_DAILY
from .sql import COMPANIES, DAILY, recurrences, with_

# Articles are documents: the source is the ticker, the first words of the text and three of these are the keywords.
TAGS = [
    "Data Centers", "AI", "Cyber Security", "semiconductors", "securities fraud", "Oil Prices", "M&A", " Electric  Vehicles ", "Interest Rates", "xx", "Earnings", "Treasury yields",
    "cloud - ", "Bitcoin!", "5G", "class action lawsuit news", "Copper", "Retail & Travel",
]
_TAG = "[" + ", ".join(f"'{t}'" for t in TAGS) + "]"
_AT = "1704067200000 + doc_id % 97 * 3600000"

ARTICLES = f"""articles AS (SELECT d.doc_id AS id, make_timestamp(({_AT}) * 1000) AS published_utc, 'article ' || d.doc_id AS title, d.lang AS publisher, d.source AS name,
  string_split(coalesce(d.text, ''), ' ')[1:6] || [{_TAG}[doc_id % 18 + 1], {_TAG}[doc_id // 3 % 18 + 1], {_TAG}[doc_id // 7 % 18 + 1]] AS keywords,
  CASE WHEN l.toxic = 1 THEN 'negative' WHEN l.quality = 1 THEN 'Positive' WHEN l.quality = 0 THEN 'mixed' END AS sentiment, l.doc_id IS NOT NULL AS judged
  FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id) l USING (doc_id) WHERE d.source IS NOT NULL)"""


def _articles(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"), F.lit(True).alias("judged"))
    docs = table(spark, sf_dir, "documents").where("source IS NOT NULL").join(labels, "doc_id", "left")
    tag = lambda n: F.get(F.array(*map(F.lit, TAGS)), F.expr(f"int({n} % 18)"))
    sentiment = F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "Positive").when(F.col("quality") == 0, "mixed")
    insight = lambda t, s, r: F.struct(t.alias("ticker"), s.alias("sentiment"), r.alias("reasoning"))
    both = F.array(insight(F.lower("source"), sentiment, F.concat(F.lit("because "), F.col("doc_id").cast("string"))), insight(F.lit("another"), F.lit("positive"), F.lit("none")))
    return docs.select(
        F.col("doc_id").alias("id"), F.expr(f"timestamp_millis({_AT})").alias("published_utc"), F.concat(F.lit("article "), F.col("doc_id").cast("string")).alias("title"), F.col("lang").alias("publisher"),
        F.array("source").alias("tickers"), F.concat(F.slice(F.split(F.coalesce("text", F.lit("")), " "), 1, 6), F.array(tag("doc_id"), tag("(doc_id div 3)"), tag("(doc_id div 7)"))).alias("keywords"),
        F.when(F.col("judged"), both).otherwise(F.array().cast(both_type())).alias("insights"),
    )


def both_type() -> str:
    return "array<struct<ticker:string,sentiment:string,reasoning:string>>"


def _quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


_ALIAS = "CASE " + " ".join(f"WHEN s = '{a}' THEN '{b}'" for a, b in W.ALIASES.items()) + " ELSE s END"
_PHRASES = " OR ".join(f"contains(keyword, '{p}')" for p in W.BLOCKED if " " in p)
NORMAL = r"trim(regexp_replace(regexp_replace(replace(regexp_replace(lower(trim({0}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))), '\s+', ' ', 'g'), '&', 'and'), '[^a-z0-9+./ -]', '', 'g'), '\s+', ' ', 'g'), ' -')"
WORDS = f"""words AS (SELECT upper(name) AS ticker, id, published_utc, pos, {_ALIAS} AS keyword FROM (SELECT *, {NORMAL.format('k')} AS s FROM (SELECT *, unnest(keywords) AS k, unnest(range(len(keywords))) AS pos FROM articles))),
good AS (SELECT * FROM words WHERE (length(keyword) >= 3 OR keyword IN ({_quoted(W.SHORT)})) AND keyword NOT IN ({_quoted(W.BLOCKED)}) AND NOT ({_PHRASES})),
firsts AS (SELECT * FROM (SELECT ticker, keyword, min(row(-epoch_ms(published_utc), id, pos)) AS f FROM good GROUP BY ticker, keyword) QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY f) <= 25),
listed AS (SELECT ticker, list(keyword ORDER BY f) AS l FROM firsts GROUP BY ticker),
felt AS (SELECT upper(name) AS ticker, count(*) AS n, count(*) FILTER (judged AND sentiment = 'Positive') AS p, count(*) FILTER (judged AND sentiment = 'negative') AS m, count(*) FILTER (judged AND (sentiment IS NULL OR sentiment = 'mixed')) AS o FROM articles GROUP BY ALL),
enriched AS (SELECT f.ticker, p::INTEGER AS sentiment_positive, m::INTEGER AS sentiment_negative, o::INTEGER AS sentiment_neutral, n::INTEGER AS sentiment_articles, round_even((p - m) / nullif(p + m + o, 0), 4) AS sentiment_score,
  to_json(coalesce(l, []))::VARCHAR AS keywords_json, len(coalesce(l, []))::INTEGER AS keyword_count FROM felt f LEFT JOIN listed USING (ticker))"""


@query(with_(ARTICLES, WORDS) + "SELECT * FROM enriched")
def news_keywords(spark, sf_dir):
    return K.enrich(_articles(spark, sf_dir))


@query(with_(ARTICLES) + """, i AS (SELECT upper(name) AS ticker, id, published_utc AS date, title, coalesce(sentiment, 'neutral') AS sentiment, 'because ' || id AS reasoning, publisher FROM articles WHERE judged)
SELECT *, count(*) OVER (PARTITION BY ticker, sentiment) AS n_sentiment FROM i""")
def news_sentiment(spark, sf_dir):
    return K.sentiment_signals(_articles(spark, sf_dir))


def _reports(spark, sf_dir):
    return table(spark, sf_dir, "orders").select((F.col("o_custkey") % 120).cast("string").alias("ticker"), F.col("o_orderdate").cast("date").alias("settlement_date"), F.col("o_totalprice").alias("short_interest"), F.col("o_orderkey").alias("days_to_cover"))


SHORT = """shorts AS (SELECT (o_custkey % 120)::VARCHAR AS ticker, o_orderdate::DATE AS settlement_date, o_totalprice AS short_interest, o_orderkey AS days_to_cover FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey % 120 ORDER BY o_orderdate::DATE DESC, o_totalprice, o_orderkey) = 1)"""


@query(with_(COMPANIES, SHORT) + "SELECT s.*, short_interest / nullif(shares_outstanding, 0) * 100.0 AS short_pct_float FROM shorts s LEFT JOIN companies c ON s.ticker = c.ticker")
def short_interest_latest(spark, sf_dir):
    return K.short_interest(_reports(spark, sf_dir), companies(spark, sf_dir))


# The stored lists, and for every third ticker one that is no JSON.
MAP = "map AS (SELECT DISTINCT ticker, keyword FROM firsts WHERE length(ticker) % 7 <> 6)"


def _map(spark, sf_dir):
    rows = K.enrich(_articles(spark, sf_dir))
    return K.keyword_map(rows.withColumn("keywords_json", F.when(F.length("ticker") % 7 == 6, "[\"broken").otherwise(F.col("keywords_json"))))


@query(with_(ARTICLES, WORDS, MAP) + "SELECT ticker, keyword FROM map")
def keyword_map(spark, sf_dir):
    return _map(spark, sf_dir)


def _case() -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches(keyword, '{'|'.join(p)}') THEN '{name}'" for name, p in W.BASKETS.items()) + " END"


FORMED = f"""freq AS (SELECT keyword, count(*) AS ticker_count, (SELECT greatest(count(DISTINCT ticker), 1) FROM map) AS n FROM map GROUP BY keyword),
weighed AS (SELECT keyword, ticker_count, ln((1 + n) / (1 + ticker_count)) + 1.0 AS keyword_weight, {_case()} AS basket_name FROM freq WHERE ticker_count >= 3 AND ticker_count <= floor(n * 0.25)),
formed AS (SELECT basket_name, keyword, ticker_count, keyword_weight FROM weighed WHERE basket_name IS NOT NULL UNION ALL SELECT * FROM (SELECT 'Keyword: ' || keyword, keyword, ticker_count, keyword_weight FROM weighed WHERE basket_name IS NULL ORDER BY ticker_count DESC, keyword LIMIT 5)),
member AS (SELECT ticker, basket_name, sum(keyword_weight ORDER BY keyword) AS score, to_json(list(keyword ORDER BY keyword))::VARCHAR AS matched_keywords_json, count(*)::INTEGER AS matched_keyword_count FROM map JOIN formed USING (keyword) GROUP BY ALL)"""
_FORMED = with_(ARTICLES, WORDS, MAP, FORMED)


def _members(spark, sf_dir):
    mapped = _map(spark, sf_dir)
    return K.membership(mapped, K.baskets(mapped, emergent=5))


@query(_FORMED + "SELECT basket_name, keyword, ticker_count, keyword_weight FROM formed")
def keyword_baskets(spark, sf_dir):
    return K.baskets(_map(spark, sf_dir), emergent=5)


@query(_FORMED + "SELECT * FROM member")
def keyword_membership(spark, sf_dir):
    return _members(spark, sf_dir)


_RANKED = "SELECT *, (row_number() OVER (PARTITION BY ticker ORDER BY score DESC, matched_keyword_count DESC, basket_name))::INTEGER AS rn FROM member"


@query(_FORMED + f"SELECT * FROM ({_RANKED}) WHERE rn <= 5")
def keyword_top5(spark, sf_dir):
    return K.top(_members(spark, sf_dir))


@query(_FORMED + "SELECT basket_name, count(DISTINCT ticker) AS ticker_count, avg(score) AS avg_score, max(score) AS max_score, string_agg(ticker, ', ' ORDER BY score DESC, ticker) AS tickers FROM member GROUP BY basket_name")
def keyword_summary(spark, sf_dir):
    return K.summary(_members(spark, sf_dir))


@query(with_(ARTICLES, WORDS, SHORT) + "SELECT count(*) AS n_rows, count(*) FILTER (keyword_count > 0) AS with_keywords, count(*) FILTER (sentiment_articles > 0) AS with_news, count(short_interest) AS with_short FROM enriched e FULL JOIN shorts s ON e.ticker = s.ticker")
def keyword_coverage(spark, sf_dir):
    shorts = K.short_interest(_reports(spark, sf_dir), companies(spark, sf_dir))
    return K.coverage(K.enrich(_articles(spark, sf_dir)).join(shorts, "ticker", "full_outer"))


# classification

_NOW = "2024-06-01 00:00:00"
_SIC = "CASE left({0}, 2) " + " ".join(f"WHEN '{code}' THEN '{name}'" for code, name in W.SIC_SECTORS.items()) + " END"
SEED = f"""base AS (SELECT ticker, no, name, industry, exchange, sic_code, CASE WHEN no % 3 = 0 THEN ' ' || exchange WHEN no % 3 = 1 THEN '' END AS yf_sector, CASE WHEN no % 6 = 0 THEN industry END AS yf_industry FROM companies),
cache AS (SELECT ticker, CASE WHEN no % 8 = 0 THEN 'Old' END AS sector, NULL::VARCHAR AS industry, 'old' AS source, CASE WHEN no % 16 = 0 THEN 5 ELSE 50 END AS source_priority, 0.5::DOUBLE AS confidence, TIMESTAMP '2024-01-01' AS enriched_at, TIMESTAMP '2024-05-01' AS stale_after, CASE WHEN no % 5 = 0 THEN 'timeout' END AS error FROM base WHERE no % 4 = 0),
stage1 AS (SELECT ticker, nullif(trim(yf_sector), '') AS sector, yf_industry AS industry, 'warehouse_yfinance_snapshot' AS source, 10 AS source_priority, 0.85::DOUBLE AS confidence, TIMESTAMP '{_NOW}' AS enriched_at, TIMESTAMP '{_NOW}' + INTERVAL 120 DAY AS stale_after, NULL::VARCHAR AS error FROM base WHERE no % 7 < 3 AND (nullif(trim(yf_sector), '') IS NOT NULL OR yf_industry IS NOT NULL)),
stage2 AS (SELECT ticker, exchange AS sector, CASE WHEN no % 2 = 0 THEN industry END AS industry, 'sector_map:' || CASE no % 3 WHEN 0 THEN 'sp500' WHEN 1 THEN 'sec-sic' ELSE 'sector_map' END AS source, CASE no % 3 WHEN 0 THEN 20 WHEN 1 THEN 30 ELSE 40 END AS source_priority, CASE no % 3 WHEN 0 THEN 0.98::DOUBLE WHEN 1 THEN 0.7 ELSE 0.8 END AS confidence, TIMESTAMP '{_NOW}' AS enriched_at, TIMESTAMP '{_NOW}' + INTERVAL 120 DAY AS stale_after, NULL::VARCHAR AS error FROM base WHERE no % 5 < 2),
coded AS (SELECT ticker, {_SIC.format('sic_code')} AS sector, CASE WHEN no % 9 <> 0 THEN industry END AS industry FROM base WHERE no % 11 <> 0),
stage3 AS (SELECT ticker, sector, industry, 'polygon_sic_fallback' AS source, 90 AS source_priority, CASE WHEN sector IS NOT NULL THEN 0.45::DOUBLE ELSE 0.35 END AS confidence, TIMESTAMP '{_NOW}' AS enriched_at, TIMESTAMP '{_NOW}' + INTERVAL 120 DAY AS stale_after, NULL::VARCHAR AS error FROM coded WHERE sector IS NOT NULL OR industry IS NOT NULL)"""


def _merged(target: str, stage: str) -> str:
    loses = "s.ticker IS NOT NULL AND (t.source_priority IS NULL OR s.source_priority <= t.source_priority OR (coalesce(t.sector, '') = '' AND coalesce(t.industry, '') = ''))"
    kept = f"SELECT t.* FROM {target} t LEFT JOIN {stage} s ON t.ticker = s.ticker WHERE NOT coalesce({loses}, false)"
    return f"({kept} UNION ALL SELECT s.* FROM {stage} s WHERE s.ticker NOT IN (SELECT ticker FROM ({kept})))"


CACHED = SEED + f",\nc1 AS {_merged('cache', 'stage1')},\nc2 AS {_merged('c1', 'stage2')},\nc3 AS {_merged('c2', 'stage3')}"
_SHOWN = ["ticker", "sector", "industry", "source", "source_priority", "confidence", "enriched_at", "stale_after", "error"]


def _classified(spark, sf_dir):
    """The companies as four sources, and the cache after the first three."""
    no, now = F.col("no"), F.lit(_NOW).cast("timestamp")
    base = companies(spark, sf_dir)
    cache = base.where("no % 4 = 0").select(
        *(F.lit(None).cast(t).alias(c) for c, t in C.CACHE.items() if c not in ("ticker", "sector", "source", "source_priority", "confidence", "enriched_at", "stale_after", "error")),
        "ticker", F.when(no % 8 == 0, "Old").alias("sector"), F.lit("old").alias("source"), F.when(no % 16 == 0, 5).otherwise(50).alias("source_priority"), F.lit(0.5).alias("confidence"),
        F.lit("2024-01-01").cast("timestamp").alias("enriched_at"), F.lit("2024-05-01").cast("timestamp").alias("stale_after"), F.when(no % 5 == 0, "timeout").alias("error"),
    ).select(*C.CACHE)
    snapshot = base.where("no % 7 < 3").select("ticker", F.when(no % 3 == 0, F.concat(F.lit(" "), "exchange")).when(no % 3 == 1, "").alias("yf_sector"), F.when(no % 6 == 0, F.col("industry")).alias("yf_industry"), F.lit("US").alias("yf_country"), "sic_code", F.col("industry").alias("sic_description"))
    mapped = base.where("no % 5 < 2").select("ticker", F.col("exchange").alias("sector"), F.when(no % 2 == 0, F.col("industry")).alias("industry"), F.when(no % 3 == 0, "sp500").when(no % 3 == 1, "sec-sic").alias("source"))
    details = base.where("no % 11 <> 0").select("ticker", "sic_code", F.when(no % 9 != 0, F.col("industry")).alias("sic_description"))
    return base, C.bootstrap(cache, snapshot, mapped, details, now), now


_CACHED = with_(COMPANIES, CACHED)


@query(_CACHED + f"SELECT {', '.join(_SHOWN)} FROM c3")
def classify_bootstrap(spark, sf_dir):
    return _classified(spark, sf_dir)[1].select(*_SHOWN)


@query(_CACHED + f"""SELECT b.ticker FROM base b LEFT JOIN c3 c ON b.ticker = c.ticker WHERE c.ticker IS NULL OR (coalesce(sector, '') = '' AND coalesce(c.industry, '') = '') OR stale_after < TIMESTAMP '{_NOW}' OR (coalesce(error, '') <> '' AND (enriched_at IS NULL OR enriched_at < TIMESTAMP '{_NOW}' - INTERVAL 30 DAY))""")
def classify_worklist(spark, sf_dir):
    base, cache, now = _classified(spark, sf_dir)
    return C.due(base, cache, now, 30)


@query(_CACHED + """, x AS (SELECT 'all' AS source, * EXCLUDE (source) FROM c3 UNION ALL SELECT source, * EXCLUDE (source) FROM c3)
SELECT source, count(*) AS n_rows, count(*) FILTER (coalesce(sector, '') <> '') AS with_sector, count(*) FILTER (coalesce(industry, '') <> '') AS with_industry FROM x GROUP BY source""")
def classify_coverage(spark, sf_dir):
    cache = _classified(spark, sf_dir)[1]
    whole = C.coverage(cache).select(F.lit("all").alias("source"), "n_rows", "with_sector", "with_industry")
    return whole.unionByName(C.by_source(cache))


REGISTRY = f"""registry AS (SELECT no, CASE WHEN no % 2 = 0 THEN lower(ticker) ELSE 'x' || no END AS ticker, lower(name) || ' !' AS title, CASE WHEN no % 3 = 0 THEN sic_code END AS sic_code, CASE WHEN no % 5 = 0 THEN industry END AS sic_description FROM base WHERE no % 6 <> 5),
open AS (SELECT b.ticker, b.name FROM base b LEFT JOIN c3 c ON b.ticker = c.ticker WHERE b.no % 3 <> 1 AND coalesce(sector, '') = '' AND coalesce(c.industry, '') = ''),
matched AS (SELECT o.ticker, CASE WHEN t.no IS NOT NULL THEN 'ticker_exact' WHEN n.no IS NOT NULL THEN 'title_exact' END AS method, CASE WHEN t.no IS NOT NULL THEN t.sic_code ELSE n.sic_code END AS code, CASE WHEN t.no IS NOT NULL THEN t.sic_description ELSE n.sic_description END AS words
  FROM open o LEFT JOIN registry t ON upper(o.ticker) = upper(t.ticker) LEFT JOIN (SELECT regexp_replace(upper(title), '[^A-Z0-9]+', '', 'g') AS title, max(no) AS no, arg_max(coalesce(sic_code, ''), no) AS sic_code, arg_max(coalesce(sic_description, ''), no) AS sic_description FROM registry GROUP BY 1) n ON regexp_replace(upper(o.name), '[^A-Z0-9]+', '', 'g') = n.title),
settled AS (SELECT ticker, CASE WHEN ok THEN s ELSE 'No Data' END AS sector, CASE WHEN ok THEN words ELSE 'No Data' END AS industry, CASE WHEN ok THEN 'sec_submissions_sic_fallback' ELSE 'sec_no_reliable_data_final' END AS source, CASE WHEN ok THEN 60 ELSE 1000 END AS source_priority, CASE WHEN ok THEN 0.55::DOUBLE ELSE 0.0 END AS confidence,
  TIMESTAMP '{_NOW}' AS enriched_at, TIMESTAMP '2099-01-01' AS stale_after, CASE WHEN ok THEN NULL WHEN method IS NULL THEN 'FINAL_NO_SEC_MATCH_OR_YFINANCE_DATA' ELSE 'FINAL_NO_RELIABLE_SEC_OR_YFINANCE_DATA' END AS error
  FROM (SELECT ticker, method, {_SIC.format('code')} AS s, nullif(words, '') AS words, ({_SIC.format('code')}) IS NOT NULL OR nullif(words, '') IS NOT NULL AS ok FROM matched))"""


@query(_CACHED + f""", {REGISTRY} SELECT {', '.join('c.' + c for c in _SHOWN)} FROM c3 c WHERE NOT (coalesce(sector, '') = '' AND coalesce(industry, '') = '' AND ticker IN (SELECT ticker FROM settled)) UNION ALL SELECT {', '.join(_SHOWN)} FROM settled""")
def classify_registry_fallback(spark, sf_dir):
    base, cache, now = _classified(spark, sf_dir)
    no = F.col("no")
    registry = base.where("no % 6 <> 5").select("no", F.when(no % 2 == 0, F.lower("ticker")).otherwise(F.concat(F.lit("x"), no.cast("string"))).alias("ticker"), F.concat(F.lower("name"), F.lit(" !")).alias("title"), F.when(no % 3 == 0, F.col("sic_code")).alias("sic_code"), F.when(no % 5 == 0, F.col("industry")).alias("sic_description"))
    snapshot = base.where("no % 3 <> 1").select("ticker", F.col("name").alias("holding_name"))
    return C.registry_fallback(snapshot, cache, registry, now).select(*_SHOWN)


# the enriched snapshot

HELD = f"""held AS (SELECT ticker, name AS holding_name, market_cap / 10 AS holding_value_usd FROM companies WHERE no % 10 <> 9 UNION ALL SELECT 'GONE', 'Gone Inc', NULL),
priced AS (SELECT * FROM daily QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY timestamp DESC) = 1), averaged AS (SELECT * FROM view_daily QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY timestamp DESC) = 1),
recl AS (SELECT ticker, ema_20, rsi_14, atr_14 FROM rec WHERE rn = bars),
basic AS (SELECT ticker, CASE WHEN no % 3 <> 0 THEN exchange END AS yf_sector, CASE WHEN no % 4 <> 0 THEN (no % 50) / 2.0 END AS yf_beta FROM companies WHERE no % 6 <> 0),
cal AS (SELECT o_custkey::VARCHAR AS ticker, o_orderdate::DATE::VARCHAR AS next_earnings_date, (o_orderkey % 9)::BIGINT AS eps_analyst_count FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate::DATE, o_orderkey) = 1),
words2 AS (SELECT ticker, (no % 4)::BIGINT AS polygon_keyword_count FROM companies WHERE no % 5 <> 0),
fac AS (SELECT ticker, CASE WHEN no % 2 = 0 THEN 'Alpha, Beta' ELSE 'Beta' END AS keyword_factor_baskets, CASE WHEN no % 2 = 0 THEN 'Alpha' ELSE 'Beta' END AS primary_keyword_factor, CASE WHEN no % 2 = 0 THEN 2.0 ELSE 1.0 END AS primary_keyword_factor_score FROM companies WHERE no % 7 <> 0),
snap AS (SELECT h.ticker, DATE '2024-06-01' AS as_of_date, h.holding_name, h.holding_value_usd, make_timestamp(p.timestamp * 1000)::DATE AS price_date, p.close, p.volume, c.market_cap, a.sma_20, a.sma_200, a.avg_vol_20, ema_20, rsi_14, atr_14, yf_sector, yf_beta, next_earnings_date, eps_analyst_count, polygon_keyword_count,
  keyword_factor_baskets, primary_keyword_factor, primary_keyword_factor_score, p.close * p.volume AS dollar_volume, (p.close / sma_20 - 1.0) * 100.0 AS price_vs_sma20_pct, (p.close / sma_200 - 1.0) * 100.0 AS price_vs_sma200_pct, p.volume / a.avg_vol_20 AS volume_vs_20d,
  next_earnings_date IS NOT NULL AS has_upcoming_earnings, coalesce(polygon_keyword_count, 0) > 0 AS has_polygon_keywords, CASE WHEN c.market_cap IS NOT NULL THEN rank() OVER (ORDER BY c.market_cap DESC NULLS LAST) END AS market_cap_rank
  FROM held h LEFT JOIN priced p ON h.ticker = p.ticker LEFT JOIN (SELECT * FROM companies WHERE no % 8 <> 0) c ON h.ticker = c.ticker LEFT JOIN averaged a ON h.ticker = a.ticker LEFT JOIN recl r ON h.ticker = r.ticker LEFT JOIN basic b ON h.ticker = b.ticker
  LEFT JOIN cal ON h.ticker = cal.ticker LEFT JOIN words2 w ON h.ticker = w.ticker LEFT JOIN fac f ON h.ticker = f.ticker)"""
_SNAP = with_(DAILY, COMPANIES, VIEW_DAILY, *recurrences("daily", 200), HELD, recursive=True)
_SNAPPED = ["ticker", "as_of_date", "holding_name", "holding_value_usd", "price_date", "close", "volume", "market_cap", "sma_20", "sma_200", "avg_vol_20", "ema_20", "rsi_14", "atr_14", "yf_sector", "yf_beta", "next_earnings_date", "eps_analyst_count", "polygon_keyword_count", "keyword_factor_baskets", "primary_keyword_factor", "primary_keyword_factor_score", "dollar_volume", "price_vs_sma20_pct", "price_vs_sma200_pct", "volume_vs_20d", "has_upcoming_earnings", "has_polygon_keywords", "market_cap_rank"]


def _snapshot(spark, sf_dir):
    no = F.col("no")
    base, bars = companies(spark, sf_dir), daily_bars(spark, sf_dir, dealt=True)
    listed = base.where("no % 10 <> 9").select((no * 2).alias("ordinal"), F.lower("ticker").alias("ticker"), F.lit(None).cast("string").alias("cusip"), "name", (F.col("market_cap") / 10).cast("string").alias("valUSD"), F.lit("").alias("pctVal"))
    again = listed.select((F.col("ordinal") + 1).alias("ordinal"), F.concat(F.lit(" "), "ticker").alias("ticker"), "cusip", F.lit("second").alias("name"), F.lit("0").alias("valUSD"), "pctVal")
    gone = spark.createDataFrame([(-1, "gone", None, "Gone Inc", "n/a", None)], "ordinal bigint, ticker string, cusip string, name string, valUSD string, pctVal string")
    basic = base.where("no % 6 <> 0").select(no.alias("ordinal"), "ticker", F.when(no % 3 != 0, F.col("exchange")).alias("sector"), F.when(no % 4 != 0, ((no % 50) / 2.0).cast("string")).otherwise("None").alias("beta"))
    cal = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ordinal"), F.col("o_custkey").cast("string").alias("ticker"), F.col("o_orderdate").cast("date").cast("string").alias("earnings_date"), F.lit("bmo").alias("earnings_when"), F.lit(None).cast("boolean").alias("is_t1"), (F.col("o_orderkey") % 9 + 0.5).cast("string").alias("eps_analyst_count"))
    words = base.where("no % 5 <> 0").select("ticker", (no % 4).cast("bigint").alias("polygon_keyword_count"))
    old, new = F.lit("2024-05-01").cast("date"), F.lit("2024-06-01").cast("date")
    member = lambda rows, day, name, score: rows.select(day.alias("as_of_date"), "ticker", F.lit(name).alias("basket_name"), F.lit(score).alias("score"), F.lit("[]").alias("matched_keywords_json"), F.lit(1).alias("matched_keyword_count"))
    some = base.where("no % 7 <> 0")
    members = member(some, new, "Beta", 1.0).unionByName(member(some.where("no % 2 = 0"), new, "Alpha", 2.0)).unionByName(member(base, old, "Gamma", 9.0))
    stored, newest = I.backfill(bars, "daily", newest=True), cut(I.standing(bars))
    details = base.where("no % 8 <> 0").select("ticker", "name", "market_cap", "sic_code", "shares_outstanding")
    others = [S.prices(newest), details, S.averages(newest), S.recursive(stored), I.snapshot_indicators(bars).drop("timestamp"), S.fundamentals(basic), S.calendar(cal), words, S.factors(members)]
    return S.enriched("2024-06-01", S.universe(listed.unionByName(again).unionByName(gone)), others)


@query(_SNAP + f"SELECT {', '.join(_SNAPPED)} FROM snap")
def snapshot_enriched(spark, sf_dir):
    return _snapshot(spark, sf_dir).select(*_SNAPPED)


@query(_SNAP + """SELECT max(as_of_date) AS as_of_date, count(*) AS n_rows, count(close) AS with_price, count(market_cap) AS with_details, count(sma_20) AS with_sma, count(rsi_14) AS with_rsi, count(yf_sector) AS with_fundamentals,
 count(*) FILTER (has_upcoming_earnings) AS with_earnings, count(*) FILTER (has_polygon_keywords) AS with_keywords, count(primary_keyword_factor) AS with_factors FROM snap""")
def snapshot_run_stats(spark, sf_dir):
    return S.statistics(_snapshot(spark, sf_dir))


@query("""WITH r AS (SELECT o_orderdate::DATE AS as_of_date, count(*) AS row_count, sum(o_totalprice > 1000)::BIGINT AS with_price FROM orders GROUP BY 1) SELECT * FROM r ORDER BY as_of_date DESC LIMIT 3""")
def audit_runs(spark, sf_dir):
    runs = table(spark, sf_dir, "orders").groupBy(F.col("o_orderdate").cast("date").alias("as_of_date")).agg(F.count("*").alias("row_count"), F.count_if(F.col("o_totalprice") > 1000).alias("with_price"))
    return A.latest_runs(runs)


