"""Bar tables whose merges commit as a whole, and rewrite only the periods that the stage touches.

A table is a folder. ``data`` holds what each commit wrote, one folder for each
period (the month of a bar's UTC time); nothing in it is ever changed. ``log``
holds one manifest for each version: which folder has which period, and how
many rows. The newest manifest is the table. A merge reads the touched periods
of that version, writes their successors into a new folder, and commits by
renaming a finished manifest to the next version's name, which the file system
refuses if another writer has taken it. So a merge that is killed at any point
leaves the old table, and one that was overtaken either moves its periods onto
the winner's version, if that left them alone, or merges anew.

Readers see the version they have opened. Only the manifest, one entry for each
period, is held by the driver. Merges must decide within a period, as all merges
by (ticker, date) or (ticker, timestamp) do. A bar without a timestamp is of the
period ``none``.

Each commit also notes, for every ticker of the periods it wrote, how many bars
there are, which days of the month have one (a bitmap) and when the last was.
This coverage is one row for each ticker and month, so gaps, and how far back a
ticker's newest bars reach, are told without reading bars.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.folders import fresh
from ..sources.tables import DAY

PERIOD = "_period"


class Overtaken(RuntimeError):
    """Other writers committed the same periods each time this merge was tried."""


@dataclass(frozen=True)
class Manifest:
    """One version of a table: the folder and row count of each period, and the last batch of each stream that is in it."""

    version: int
    schema: str
    parts: dict[str, str] = field(default_factory=dict)
    cover: dict[str, str] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)


def period(column: str = "timestamp") -> Column:
    return F.coalesce(F.date_format(F.timestamp_millis(column), "yyyy-MM"), F.lit("none"))


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _log(path: str, version: int) -> str:
    return f"{path}/log/{version:010d}.json"


def latest(spark: SparkSession, path: str) -> int | None:
    """The newest version, if there is any."""
    folder, fs = _place(spark, f"{path}/log")
    if not fs.exists(folder):
        return None
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return max((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), default=None)


def manifest(spark: SparkSession, path: str, version: int | None = None) -> Manifest:
    """A version of the table, the newest if none is given."""
    version = latest(spark, path) if version is None else version
    if version is None:
        raise LookupError(f"no table in {path}")
    return Manifest(**json.loads(spark.read.text(_log(path, version), wholetext=True).first()[0]))


def _commit(spark: SparkSession, path: str, new: Manifest) -> bool:
    """Make ``new`` the newest version, unless its place is taken."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    draft, fs = _place(spark, f"{path}/log/draft-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(json.dumps(new.__dict__).encode())
    out.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), conf).rename(draft, _place(spark, _log(path, new.version))[0], options)
        return True
    except Exception as e:
        if "FileAlreadyExistsException" not in str(e):
            raise
        fs.delete(draft, False)
        return False


COVER = "ticker string, period string, bars long, days int, last_ts long"


def _coverage(rows: DataFrame) -> DataFrame:
    day = F.dayofmonth(F.timestamp_millis("timestamp"))
    days = F.bit_or(F.expr("shiftleft(1, _day - 1)")).alias("days")
    return rows.select("ticker", "timestamp", day.alias("_day"), period().alias("period")).groupBy("ticker", "period").agg(F.count("*").alias("bars"), days, F.max("timestamp").alias("last_ts"))


def _write(rows: DataFrame, path: str, touched: list[str] | None) -> tuple[dict[str, str], dict[str, str], dict[str, int]]:
    """Write the periods ``touched`` and their coverage; the folders of both, and row counts observed by the tasks that write.

    Without ``touched`` all periods are written that the rows have: their folders are listed, and the coverage counts them.
    """
    seen, schema = Observation(), rows.schema
    tagged = rows.withColumn(PERIOD, period()).hint("rebalance", F.col(PERIOD))  # files of the advised size, whatever a period's share
    counts = [F.count_if(F.col(PERIOD) == p).alias(f"p{i}") for i, p in enumerate(touched or [])]
    part = f"data/{uuid.uuid4().hex}"
    tagged.observe(seen, F.count("*").alias("all"), *counts).sortWithinPartitions(PERIOD, "ticker", "timestamp").write.partitionBy(PERIOD).parquet(f"{path}/{part}")
    found = seen.get
    counted = {p: found.get(f"p{i}") or 0 for i, p in enumerate(touched or [])}
    if touched is None:
        folder, fs = _place(rows.sparkSession, f"{path}/{part}")
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        held = sorted(n.removeprefix(f"{PERIOD}=") for n in names if n.startswith(f"{PERIOD}="))
    elif sum(counted.values()) != (found.get("all") or 0):
        raise ValueError("the merge has rows of periods that its stage does not touch")
    else:
        held = [p for p, n in counted.items() if n]
    parts = {p: f"{part}/{PERIOD}={p}" for p in held}
    if parts:
        written = rows.sparkSession.read.schema(schema).parquet(*(f"{path}/{x}" for x in parts.values()))
        _coverage(written).repartition(F.col("period")).write.partitionBy("period").parquet(f"{path}/{part}-cover")
    cover = {p: f"{part}-cover/period={p}" for p in parts}
    if touched is None and parts:
        noted = coverage(rows.sparkSession, path, Manifest(0, "", parts, cover))
        counted = {r["period"]: r["n"] for r in noted.groupBy("period").agg(F.sum("bars").alias("n")).collect()}  # one for each period
    return parts, cover, {p: counted[p] for p in held}


def _touched(rows: DataFrame) -> dict[str, int]:
    """Rows of each period."""
    return {r["p"]: r["n"] for r in rows.groupBy(period().alias("p")).agg(F.count("*").alias("n")).collect()}


def create(rows: DataFrame, path: str) -> Manifest:
    """A new table with ``rows``; it is an error if there is one."""
    spark = rows.sparkSession
    parts, cover, counts = _write(rows, path, None)
    new = Manifest(0, rows.schema.json(), parts, cover, counts)
    if not _commit(spark, path, new):
        raise FileExistsError(f"there is a table in {path}")
    return new


def read(spark: SparkSession, path: str, at: Manifest | None = None, periods: list[str] | None = None) -> DataFrame:
    """The table, or the given periods of it; only their folders are listed and read."""
    at = at or manifest(spark, path)
    schema = StructType.fromJson(json.loads(at.schema))
    folders = [f"{path}/{part}" for p, part in sorted(at.parts.items()) if periods is None or p in periods]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def coverage(spark: SparkSession, path: str, at: Manifest | None = None) -> DataFrame:
    """``(ticker, period, bars, days, last_ts)`` of the table; bit d - 1 of ``days`` stands for day d of the month."""
    at = at or manifest(spark, path)
    if not at.cover:
        return spark.createDataFrame([], COVER)
    # a folder's name is its period: read under it, so that Spark gives it back as a column
    roots = sorted({f"{path}/{folder.rsplit('/', 1)[0]}" for folder in at.cover.values()})
    frames = []
    for root in roots:
        periods = [p for p, folder in at.cover.items() if f"{path}/{folder}".startswith(f"{root}/")]
        frames.append(spark.read.schema(COVER).option("basePath", root).parquet(*(f"{root}/period={p}" for p in periods)))
    return reduce(DataFrame.unionByName, frames)


def newest(spark: SparkSession, path: str, rows: int, at: Manifest | None = None) -> DataFrame:
    """Bars of every ticker that hold its ``rows`` newest, whole months of them, from no more months than it needs.

    Which months a ticker needs is counted back from its last one on the
    coverage; only the files of months that some ticker needs are listed and
    read, and of these the bars of tickers that need them go on.
    """
    at = at or manifest(spark, path)
    back = Window.partitionBy("ticker").orderBy(F.desc("period"))
    since = F.sum("bars").over(back) - F.col("bars")
    need = coverage(spark, path, at).where("period <> 'none'").withColumn("_since", since).where(F.col("_since") < rows).select("ticker", "period")
    months = [r["period"] for r in need.select("period").distinct().collect()]  # one for each month of the table at most
    bars = read(spark, path, at, months)
    return bars.withColumn("period", period()).join(need, ["ticker", "period"], "left_semi").select(*bars.columns)


def gaps(spark: SparkSession, source: str, derived: str, days: int | None = 30) -> DataFrame:
    """``bars.gap_report`` of two tables from their coverage alone."""
    have = coverage(spark, derived)
    if days is not None:
        last = have.agg(F.max("last_ts").alias("_newest"))
        have = have.join(F.broadcast(last), F.lit(True)).where(F.col("last_ts") > F.col("_newest") - days * DAY)  # one row
    found = coverage(spark, source).groupBy("ticker").agg(F.sum("bars").alias("bars"), F.max("last_ts").alias("last_ts"))
    return found.join(have.select("ticker").distinct(), "ticker", "left_anti")


def missing_days(spark: SparkSession, source: str, derived: str) -> DataFrame:
    """``(ticker, period, days)``: how many days of each ticker and month ``source`` has a bar of and ``derived`` has none, from the bitmaps."""
    a = coverage(spark, source).select("ticker", "period", F.col("days").alias("_a"))
    b = coverage(spark, derived).select("ticker", "period", F.col("days").alias("_b"))
    lack = F.bit_count(F.col("_a").bitwiseAND(F.bitwise_not(F.coalesce("_b", F.lit(0)))))
    return a.join(b, ["ticker", "period"], "left").select("ticker", "period", lack.cast("int").alias("days")).where("days > 0")


def merge(path: str, stage: DataFrame, how: Callable[[DataFrame, DataFrame], DataFrame], batch: tuple[str, int] | None = None, attempts: int = 5) -> dict[str, int]:
    """Commit ``how(target, stage)`` for the periods of ``stage``; what was staged, and the rows before and after.

    The counts are those of the commit itself: of the stage when its periods were
    looked for, of the manifest, and of the tasks that wrote. ``batch`` names a
    stream and one of its batches; a batch that is in the table already changes
    nothing. The stage is written to the shared folder first, as it is read
    several times and what makes it should run once.
    """
    spark, kept = stage.sparkSession, fresh(stage.sparkSession, "staged")
    stage.write.parquet(kept)
    stage = spark.read.schema(stage.schema).parquet(kept)
    staged = _touched(stage)
    touched = sorted(staged)
    base = manifest(spark, path)
    for _ in range(attempts):
        if not touched or (batch and base.batches.get(batch[0], -1) >= batch[1]):
            total = sum(base.rows.values())
            return {"version": base.version, "staged": sum(staged.values()), "before": total, "after": total, "inserted": 0}
        target = read(spark, path, base, touched)
        parts, cover, counts = _write(how(target, stage).select(*target.columns), path, touched)
        now = base
        while True:
            keep = lambda old: {p: v for p, v in old.items() if p not in staged}
            new = replace(now, version=now.version + 1, parts=keep(now.parts) | parts, cover=keep(now.cover) | cover, rows=keep(now.rows) | counts, batches=now.batches | (dict([batch]) if batch else {}))
            if _commit(spark, path, new):
                before, after = sum(now.rows.values()), sum(new.rows.values())
                return {"version": new.version, "staged": sum(staged.values()), "before": before, "after": after, "inserted": after - before}
            now = manifest(spark, path, now.version + 1)
            if any(now.parts.get(p) != base.parts.get(p) for p in touched) or (batch and now.batches.get(batch[0], -1) >= batch[1]):
                break
        base = manifest(spark, path)
    raise Overtaken(f"{path}: {attempts} merges were overtaken by others of the same periods")


def unused(spark: SparkSession, path: str) -> list[str]:
    """Folders below ``data`` that no version refers to: what killed and overtaken merges left, and what running ones are writing."""
    folder, fs = _place(spark, f"{path}/data")
    used = set()
    for version in range((latest(spark, path) or 0) + 1):
        try:
            at = manifest(spark, path, version)
            used |= {part.split("/")[1] for part in (*at.parts.values(), *at.cover.values())}
        except PySparkException:  # a version that was cleared away
            continue
    return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(folder)) if n not in used)
