"""Keywords, sentiment and short interest of tickers, and the baskets that keywords form.

Articles are ``(id, published_utc, title, publisher, tickers, keywords,
insights)``; enriched rows are one for each ticker. Everything that a ticker,
keyword or basket needs is summed before it is collected into lists, and lists
have bounded length: at most ``most`` keywords of a ticker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from .merge import first_per
from .views import newest_first

SENTIMENTS = ("positive", "negative", "neutral")


def _mentions(articles: DataFrame, *columns: str) -> DataFrame:
    """A row for each ticker of each article."""
    return articles.select("id", "published_utc", F.explode(F.transform("tickers", lambda t: F.upper(t))).alias("ticker"), *columns)


def _insights(articles: DataFrame) -> DataFrame:
    """The insights that articles give about the tickers they mention."""
    rows = _mentions(articles, "title", "publisher", F.explode("insights").alias("_i"))
    return rows.where(F.upper("_i.ticker") == F.col("ticker")).select("id", "published_utc", "title", "publisher", "ticker", "_i.sentiment", F.col("_i.reasoning").alias("reasoning"))


def enrich(articles: DataFrame, most: int = 25) -> DataFrame:
    """Sentiment counts and score of every ticker with news, and its first ``most`` allowed keywords, newest articles first."""
    # normalised before they are exploded, so that the long expression is there once
    words = _mentions(articles.withColumn("keywords", F.transform("keywords", X.keyword)), "keywords")
    words = words.select("id", "published_utc", "ticker", F.posexplode("keywords").alias("_at", "keyword")).where(X.allowed(F.col("keyword")))
    seen = words.groupBy("ticker", "keyword").agg(F.min(F.struct((-F.unix_millis("published_utc")).alias("age"), "id", "_at")).alias("first"))
    kept = newest_first(seen, "ticker", most, F.col("first"))
    listed = kept.groupBy("ticker").agg(F.array_sort(F.collect_list(F.struct("first", "keyword"))).alias("_all")).select("ticker", F.transform("_all", lambda x: x["keyword"]).alias("_words"))
    feeling = F.lower("sentiment")
    known = F.when(feeling.isin(*SENTIMENTS), feeling).otherwise("neutral")
    counts = _insights(articles).withColumn("_s", known).groupBy("ticker").agg(*(F.count_if(F.col("_s") == s).cast("int").alias(f"sentiment_{s}") for s in SENTIMENTS))
    out = _mentions(articles).groupBy("ticker").agg(F.count("*").cast("int").alias("sentiment_articles")).join(listed, "ticker", "left").join(counts, "ticker", "left")
    out = out.fillna(0, [f"sentiment_{s}" for s in SENTIMENTS])
    total = sum((F.col(f"sentiment_{s}") for s in SENTIMENTS), F.lit(0))
    score = F.bround((F.col("sentiment_positive") - F.col("sentiment_negative")) / F.nullif(total, F.lit(0)), 4)
    words_ = F.coalesce("_words", F.array().cast("array<string>"))
    return out.select("ticker", *(f"sentiment_{s}" for s in SENTIMENTS), "sentiment_articles", score.alias("sentiment_score"), F.to_json(words_).alias("keywords_json"), F.size(words_).alias("keyword_count"))


def sentiment_signals(articles: DataFrame) -> DataFrame:
    """Every insight about a mentioned ticker, with how many of its kind the ticker has."""
    rows = _insights(articles).withColumn("sentiment", F.coalesce("sentiment", F.lit("neutral")))
    many = rows.groupBy("ticker", "sentiment").agg(F.count("*").alias("n_sentiment"))
    return rows.join(many, ["ticker", "sentiment"]).select("ticker", "id", F.col("published_utc").alias("date"), "title", "sentiment", "reasoning", "publisher", "n_sentiment")


def short_interest(reports: DataFrame, details: DataFrame) -> DataFrame:
    """The newest report of each ticker, and its share of the shares outstanding in percent."""
    rest = [F.col(c) for c in reports.columns if c not in ("ticker", "settlement_date")]
    newest = first_per(reports, ["ticker"], F.desc("settlement_date"), *rest)
    share = F.col("short_interest") / F.nullif("shares_outstanding", F.lit(0.0)) * 100.0
    return newest.join(details.select("ticker", "shares_outstanding"), "ticker", "left").withColumn("short_pct_float", share).drop("shares_outstanding")


def keyword_map(enriched: DataFrame) -> DataFrame:
    """Distinct ``(ticker, keyword)`` of the stored lists; a list that is no JSON has none."""
    rows = enriched.select("ticker", F.explode(F.transform(X.json_list(F.col("keywords_json")), X.keyword)).alias("keyword"))
    return rows.where(X.allowed(F.col("keyword"))).distinct()


def repeated(mapped: DataFrame, least: int = 3, share: float = 0.25) -> DataFrame:
    """``(keyword, ticker_count, n_tickers)`` of keywords that several tickers have, but no more than ``share`` of all."""
    total = mapped.agg(F.greatest(F.count_distinct("ticker"), F.lit(1)).alias("n_tickers"))
    counts = mapped.groupBy("keyword").agg(F.count("*").alias("ticker_count"))
    both = counts.join(F.broadcast(total), F.lit(True))  # one row
    return both.where((F.col("ticker_count") >= max(least, 2)) & (F.col("ticker_count") <= F.floor(F.col("n_tickers") * share)))


def baskets(mapped: DataFrame, least: int = 3, share: float = 0.25, emergent: int = 0) -> DataFrame:
    """``(basket_name, keyword, ticker_count, keyword_weight)``; the ``emergent`` most frequent keywords of no basket get one each."""
    rows = repeated(mapped, least, share).withColumn("basket_name", X.basket(F.col("keyword")))
    weight = F.log((1 + F.col("n_tickers")) / (1 + F.col("ticker_count"))) + 1.0
    rows = rows.withColumn("keyword_weight", weight)
    out = rows.where("basket_name IS NOT NULL")
    if emergent:
        own = rows.where("basket_name IS NULL").orderBy(F.desc("ticker_count"), "keyword").limit(emergent)
        out = out.unionByName(own.withColumn("basket_name", F.concat(F.lit("Keyword: "), "keyword")))
    return out.select("basket_name", "keyword", "ticker_count", "keyword_weight")


def membership(mapped: DataFrame, formed: DataFrame) -> DataFrame:
    """``(ticker, basket_name, score, matched_keywords_json, matched_keyword_count)``; weights are added in the order of the keywords."""
    hits = mapped.join(formed.select("keyword", "basket_name", "keyword_weight"), "keyword")
    all_ = hits.groupBy("ticker", "basket_name").agg(F.array_sort(F.collect_list(F.struct("keyword", "keyword_weight"))).alias("_all"))
    return all_.select(
        "ticker", "basket_name", F.aggregate("_all", F.lit(0.0), lambda s, x: s + x["keyword_weight"]).alias("score"),
        F.to_json(F.transform("_all", lambda x: x["keyword"])).alias("matched_keywords_json"), F.size("_all").alias("matched_keyword_count"),
    )


def top(members: DataFrame, most: int = 5) -> DataFrame:
    """The ``most`` best baskets of each ticker, numbered ``rn``."""
    ranked = newest_first(members, "ticker", most, F.desc("score"), F.desc("matched_keyword_count"), F.col("basket_name"))
    return ranked.withColumn("rn", F.row_number().over(Window.partitionBy("ticker").orderBy(F.desc("score"), F.desc("matched_keyword_count"), "basket_name")))


def latest_partition(rows: DataFrame, by: str = "as_of_date") -> DataFrame:
    """Only the rows of the newest date."""
    newest = rows.agg(F.max(by).alias("_newest"))
    return rows.join(F.broadcast(newest), F.col(by) == F.col("_newest")).drop("_newest")  # one row


def summary(members: DataFrame) -> DataFrame:
    """Each basket's tickers, mean and best score; tickers are listed by score."""
    return members.groupBy("basket_name").agg(
        F.count_distinct("ticker").alias("ticker_count"), F.avg("score").alias("avg_score"), F.max("score").alias("max_score"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "ticker"))), lambda x: x["ticker"]), ", ").alias("tickers"),
    )


def coverage(enriched: DataFrame) -> DataFrame:
    """How many tickers have keywords, news and short interest."""
    return enriched.agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("keyword_count") > 0).alias("with_keywords"), F.count_if(F.col("sentiment_articles") > 0).alias("with_news"), F.count("short_interest").alias("with_short")
    )
