"""Merges of a stage into a target, as functions that return the new target.

Each guarantees one row per key among what it inserts, so merging the same
stage twice equals merging it once. ``order`` decides between staged rows of
one key; it should be total.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PRIORITY_COLUMNS = ["source_priority", "confidence"]


def utc_date(column: str = "timestamp") -> Column:
    return F.to_date(F.timestamp_millis(column))


def first_per(rows: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in ``order``."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_rn", rank).where("_rn = 1").drop("_rn")


def absent_key(target: DataFrame, stage: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """Insert staged rows whose key the target lacks; existing rows win."""
    new = first_per(stage, keys, *order).join(target.select(*keys), keys, "left_anti")
    return target.unionByName(new.select(*target.columns))


def absent_date(target: DataFrame, stage: DataFrame, *order: Column) -> DataFrame:
    """Insert staged bars whose (ticker, UTC date) the target lacks."""
    return target.unionByName(_new_dates(target, stage, *order).select(*target.columns))


def _new_dates(target: DataFrame, stage: DataFrame, *order: Column) -> DataFrame:
    have = target.select("ticker", utc_date().alias("_d"))
    return first_per(stage.withColumn("_d", utc_date()), ["ticker", "_d"], *order).join(have, ["ticker", "_d"], "left_anti").drop("_d")


def provisional(target: DataFrame, stage: DataFrame) -> DataFrame:
    """Official staged bars replace provisional ones (no transaction count) of their date; then absent dates are inserted.

    Both sides meet in one shuffle by (ticker, UTC date): a date's bars know of each other there.
    """
    both = target.withColumn("_staged", F.lit(False)).unionByName(stage.select(*target.columns).withColumn("_staged", F.lit(True))).withColumn("_d", utc_date())
    counted, known = F.col("transactions").isNotNull(), F.col("ticker").isNotNull() & F.col("_d").isNotNull()  # nulls meet nothing
    dated = Window.partitionBy("ticker", "_d")
    order = dated.orderBy(F.desc("_staged"), ~counted, "timestamp", "close")
    rows = both.withColumns({"_official": known & F.max(F.col("_staged") & counted).over(dated), "_rn": F.row_number().over(order)})
    rows = rows.withColumn("_kept", ~F.col("_staged") & (counted | ~F.col("_official")))
    rows = rows.withColumn("_has", known & F.max("_kept").over(dated))
    return rows.where(F.col("_kept") | (F.col("_staged") & (F.col("_rn") == 1) & ~F.col("_has"))).select(*target.columns)


def replace(target: DataFrame, stage: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """Delete the target's rows of staged keys and insert the staged ones."""
    new = first_per(stage, keys, *order)
    return target.join(new.select(*keys), keys, "left_anti").select(*target.columns).unionByName(new.select(*target.columns))


def _blank(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit("")) == ""


def priority(target: DataFrame, stage: DataFrame) -> DataFrame:
    """Per ticker the staged row of least priority, then highest confidence; it replaces a target row whose
    priority is null or not smaller, or that has neither sector nor industry."""
    best = first_per(stage, ["ticker"], F.col("source_priority").asc_nulls_last(), F.col("confidence").desc_nulls_last(), F.col("source"))
    rank = best.select("ticker", F.col("source_priority").alias("_p"), F.lit(True).alias("_staged"))
    old = target.join(rank, "ticker", "left")
    loses = F.col("_staged").isNotNull() & (F.col("source_priority").isNull() | (F.col("_p") <= F.col("source_priority")) | (_blank("sector") & _blank("industry")))
    kept = old.where(~F.coalesce(loses, F.lit(False))).select(*target.columns)
    return kept.unionByName(best.join(kept.select("ticker"), "ticker", "left_anti").select(*target.columns))


def fill_only(target: DataFrame, stage: DataFrame) -> DataFrame:
    """Staged rows replace only rows that have neither sector nor industry, or fill absent tickers."""
    kept = target.where(~(_blank("sector") & _blank("industry"))).unionByName(target.where(_blank("sector") & _blank("industry")).join(stage.select("ticker"), "ticker", "left_anti").select(*target.columns))
    return kept.unionByName(stage.join(kept.select("ticker"), "ticker", "left_anti").select(*target.columns))


def overlay(first: DataFrame, second: DataFrame, key: str = "ticker") -> DataFrame:
    """All of ``first``, and rows of ``second`` for keys that ``first`` lacks."""
    return first.unionByName(second.join(first.select(key), key, "left_anti").select(*first.columns))


def newest(stage: DataFrame, keys: list[str], at: str) -> DataFrame:
    """The newest staged row of each key; rows without a time come last."""
    rest = [F.col(c) for c in stage.columns if c not in (*keys, at)]
    return first_per(stage, keys, F.col(at).desc_nulls_last(), *rest)


def prefer_official(stage: DataFrame) -> DataFrame:
    """One staged bar per (ticker, UTC date): one with a transaction count if there is any, then the earliest."""
    return first_per(stage.withColumn("_d", utc_date()), ["ticker", "_d"], F.col("transactions").isNull(), F.col("timestamp"), F.col("close")).drop("_d")


def metrics(target: DataFrame, stage: DataFrame, merged: DataFrame) -> DataFrame:
    """One row: staged, before, after, inserted."""
    counted = [df.agg(F.count("*").alias(n)) for df, n in ((stage, "staged"), (target, "before"), (merged, "after"))]
    one = counted[0]
    for c in counted[1:]:
        one = one.join(F.broadcast(c), F.lit(True))  # each has one row
    return one.withColumn("inserted", F.col("after") - F.col("before"))
