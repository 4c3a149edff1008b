"""Appending, replacing and evolving tables of files; families of views.

All writes are Spark's own: a failed task leaves nothing behind, and no setting
of the session is changed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.folders import exists


def append_ndjson(rows: DataFrame, path: str) -> None:
    """Add rows to a folder of newline-delimited JSON; nulls are left out."""
    rows.write.mode("append").json(path)


def replace_table(rows: DataFrame, path: str, kinds: dict[str, str]) -> None:
    """Write a table anew with the columns ``kinds`` (name: type); what does not cast is null."""
    rows.select(*(F.col(c).try_cast(t).alias(c) for c, t in kinds.items())).write.mode("overwrite").parquet(path)


def replace_partitions(rows: DataFrame, path: str, by: str = "as_of_date") -> None:
    """Replace the dates that ``rows`` hold; other dates stay as they are."""
    rows.repartition(by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def append_history(rows: DataFrame, path: str) -> None:
    """Add all staged rows to a history."""
    rows.write.mode("append").parquet(path)


def evolve(spark: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    """Append rows that may have columns the table lacks, or lack some of its; return the whole table, nulls where a row has none.

    Files stay as they were written: the schemas meet when the table is read.
    """
    if exists(spark, path):
        old = spark.read.option("mergeSchema", True).parquet(path)
        shared = [f for f in old.schema if f.name in rows.columns]
        rows = rows.withColumns({f.name: F.col(f"`{f.name}`").cast(f.dataType) for f in shared})
    rows.write.mode("append").parquet(path)
    return spark.read.option("mergeSchema", True).parquet(path)


def publish(rows: DataFrame, path: str) -> int:
    """Write a small table anew as the next version beside the old ones; readers of those are not disturbed."""
    spark = rows.sparkSession
    no = 0
    while exists(spark, f"{path}/v={no}"):
        no += 1
    rows.write.mode("errorifexists").parquet(f"{path}/v={no}")
    return no


def published(spark: SparkSession, path: str) -> DataFrame:
    """The newest version that has been written to its end."""
    no, newest = 0, None
    while exists(spark, f"{path}/v={no}"):
        if exists(spark, f"{path}/v={no}/_SUCCESS"):
            newest = no
        no += 1
    if newest is None:
        raise LookupError(f"nothing is published in {path}")
    return spark.read.parquet(f"{path}/v={newest}")


def create_views(spark: SparkSession, views: dict[str, Callable[[], DataFrame]]) -> None:
    """A temporary view for each name."""
    for name, make in views.items():
        make().createOrReplaceTempView(name)


def drop_views(spark: SparkSession, names: list[str]) -> None:
    for name in names:
        spark.catalog.dropTempView(name)


def require(spark: SparkSession, names: list[str]) -> None:
    """Stop before any work if a relation is missing."""
    missing = [n for n in names if not spark.catalog.tableExists(n)]
    if missing:
        raise LookupError(f"missing relations: {', '.join(missing)}")
