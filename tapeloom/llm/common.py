"""Helpers that the operators of this subpackage share.

Intermediate tables go to the folder that the cluster names in
``spark.checkpoint.dir``; they are Parquet, so a lost executor costs a re-read
and never a recomputation of the whole lineage.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share. Without one a local master gets a temporary folder; a cluster must name it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = os.path.join(tempfile.gettempdir(), f"tapeloom-{spark.sparkContext.applicationId}")
    return folder.rstrip("/")


def stash(df: DataFrame, what: str, spent: Iterable[DataFrame] = ()) -> DataFrame:
    """Write ``df`` to the shared folder and return it reread: cuts lineage and frees its shuffle files.

    The files stay, as frames that are not yet evaluated read them; like
    checkpoints, they are cleared with the folder. Only ``spent``, earlier
    results of this function that nothing reads once ``df`` is written, go at once.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    for old in spent:
        place = spark._jvm.org.apache.hadoop.fs.Path(old.stashed_at)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    spark._jvm.System.gc()  # the context cleaner drops shuffle files of plans nobody holds any more
    out = spark.read.schema(df.schema).parquet(path)
    out.stashed_at = path
    return out


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` for a function of one record batch that yields record batches.

    Spark bounds a batch by bytes as well as rows; functions cut it further
    where they need to, and no setting of the session is touched.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from fn(batch)

    return df.mapInArrow(run, schema)


def shared_keys(rows: DataFrame, key: str, owner: str | None, what: str) -> DataFrame:
    """The rows whose ``key`` occurs with two owners or more; without ``owner``, in two rows or more.

    The keys are counted with a partial aggregate, so a key that a third of all
    rows hold is pre-summed on every task, and are written before they are
    joined back: both sides of that join are then plain exchanges, which the
    adaptive planner can split when one key is hot. Counting rows sends the keys
    and little else; counting owners sends two of them with each key.
    """
    if owner is None:
        keys = rows.groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1").select(key)
    else:
        keys = rows.groupBy(key).agg(F.min(owner).alias("_lo"), F.max(owner).alias("_hi")).where("_lo <> _hi").select(key)
    return rows.join(stash(keys, f"{what}-keys"), key)


def least_hashes(rows: DataFrame, group: str, hashed: str, most: int, what: str, buckets: int = 4096) -> DataFrame:
    """The rows of every ``group`` with about its ``most`` least values of ``hashed``: all up to a bucket's end.

    Rows are first counted by range of the hash, a pre-summed table of
    ``buckets`` rows a group at most, so a group with a third of all rows never
    meets in one task; only the rows up to the range in which the ``most``-th
    lies go on. Rows with a null group are left out. Spark broadcasts the one row
    of each group if it is small enough.
    """
    width = F.shiftright(hashed, 64 - (buckets.bit_length() - 1)).cast("int").alias("_bucket")
    counts = stash(rows.where(F.col(group).isNotNull()).groupBy(group, width).agg(F.count("*").alias("_n")), f"{what}-buckets")
    before = F.sum("_n").over(Window.partitionBy(group).orderBy("_bucket")) - F.col("_n")
    last = counts.withColumn("_before", before).where(F.col("_before") < most).groupBy(group).agg(F.max("_bucket").alias("_last"))
    return rows.withColumn("_bucket", width).join(stash(last, f"{what}-last"), group).where("_bucket <= _last").drop("_bucket", "_last")


def components(edges: DataFrame, what: str) -> DataFrame:
    """Connected components of ``edges(a, b)`` as ``(node, component)``, the smallest node naming each.

    Alternates the large-star and small-star steps until every edge points at
    the root of a star; each step is one aggregate and one join, and the edge
    list never leaves the executors. Nodes without an edge are not listed.
    """
    spark = edges.sparkSession
    now = stash(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), what)
    mark = None
    while True:
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = stash(large, what)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        now = stash(small, what)
        seen = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if mark == tuple(seen):
            break
        mark = tuple(seen)
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()


__all__ = ["WORD", "arrow_map", "components", "least_hashes", "partitions", "read", "shared_folder", "shared_keys", "stash"]
