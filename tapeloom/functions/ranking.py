"""Global ranks without a single-partition window.

Rows are put in order by ranges, as many as Spark makes partitions of them, so
the ranges grow in number with the rows and not in size. The ranges are counted
first; a row's rank is the count of the ranges before it plus its place in its
own. Ties in a row's number are broken before the ranges are cut, so one value
or null that many rows share spreads over ranges; where peers share a rank,
equal values are counted before they are ordered. The ordered rows are cut off
from the plan, so all of its branches see the same ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.folders import shared


def _in_order(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` from a checkpoint, in ranges of ``order``: ``_p`` numbers the range, ``_i`` rises inside it."""
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return cut(rows.withColumns({"_p": F.spark_partition_id(), "_i": F.monotonically_increasing_id()}))


def _before(ranges: DataFrame, size: str, *within: str) -> DataFrame:
    """``ranges`` (a row for each ``_p``) with the ``size`` of all ranges before, and of all there are, of the same ``within``."""
    w = Window.partitionBy(*within)
    return ranges.withColumns({"_before": F.sum(size).over(w.orderBy("_p")) - F.col(size), "_total": F.sum(size).over(w)})


def cut(df: DataFrame) -> DataFrame:
    """``df`` from a checkpoint in the folder the cluster names, so that plans which read it several times stay small."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared(df.sparkSession))
    return df.checkpoint()


def cume_dists(df: DataFrame, key: str, orders: dict[str, tuple[str, bool, bool]]) -> DataFrame:
    """For each ``name: (column, descending, nulls_first)`` the share of rows up to and including the row's peers.

    All nulls are peers. ``key`` tells the rows apart. All columns are ranked in
    one pass over long rows, and equal values are counted before they are
    ordered, so a value that many rows share costs one row.
    """
    df = cut(df)
    each = []
    for name, (column, descending, nulls_first) in orders.items():
        value = F.col(column).cast("double")
        side = F.when(value.isNull(), -1 if nulls_first else 1).otherwise(0)
        each.append(F.struct(F.lit(name).alias("_m"), side.alias("_side"), (-value if descending else value).alias("_v")))
    rows = df.select(key, F.explode(F.array(*each)).alias("_e")).select(key, "_e.*")
    values = _in_order(rows.groupBy("_m", "_side", "_v").agg(F.count("*").alias("_n")), F.col("_m"), F.col("_side"), F.col("_v"))
    ranges = _before(values.groupBy("_m", "_p").agg(F.sum("_n").alias("_c")), "_c", "_m").drop("_c")  # at most one row a range and measure
    upto = F.sum("_n").over(Window.partitionBy("_m", "_p").orderBy("_i"))
    values = values.withColumn("_k", upto).join(F.broadcast(ranges), ["_m", "_p"])
    values = values.select(F.col("_m").alias("_name"), F.col("_v").alias("_x"), ((F.col("_before") + F.col("_k")) / F.col("_total")).alias("_share"))
    found = rows.join(values, (F.col("_m") == F.col("_name")) & F.col("_v").eqNullSafe(F.col("_x")))
    found = found.groupBy(key).agg(*(F.max(F.when(F.col("_name") == name, F.col("_share"))).alias(name) for name in orders))
    return df.join(found, key)


def position(df: DataFrame, column: str, name: str, tie: str, descending: bool = False) -> DataFrame:
    """``name``: the row's number in the order of ``column``, nulls last, then ``tie``; ``_total`` rows are added too."""
    value = F.col(column).cast("double")
    rows = _in_order(cut(df), (-value if descending else value).asc_nulls_last(), F.col(tie))  # read twice: for the ranges, then into them
    ranges = _before(rows.groupBy("_p").agg(F.count("*").alias("_c"), F.min("_i").alias("_first")), "_c").drop("_c")  # one row a range
    out = rows.join(F.broadcast(ranges), "_p")
    return out.withColumn(name, (F.col("_before") + F.col("_i") - F.col("_first") + 1).cast("int")).drop("_p", "_i", "_first", "_before")


def ntile(df: DataFrame, tiles: int, column: str, name: str, tie: str, descending: bool = False) -> DataFrame:
    """``name``: which of ``tiles`` parts of the order the row is in; the first parts hold one row more where they do not divide evenly."""
    out = position(df, column, "_pos", tie, descending)
    size, more = F.floor(F.col("_total") / tiles), F.col("_total") % tiles
    at = F.col("_pos") - 1
    tile = F.when(at < more * (size + 1), F.floor(at / (size + 1))).otherwise(more + F.floor((at - more * (size + 1)) / F.nullif(size, F.lit(0))))
    return out.withColumn(name, (tile + 1).cast("int")).drop("_pos", "_total")


def rank_from_top(df: DataFrame, column: str, name: str) -> DataFrame:
    """``name``: one more than the number of rows with a greater value; null where there is none."""
    df = cut(df)
    counted = df.select((-F.col(column).cast("double")).alias("_v")).where("_v IS NOT NULL").groupBy("_v").agg(F.count("*").alias("_n"))
    values = _in_order(counted, F.col("_v"))
    ranges = _before(values.groupBy("_p").agg(F.sum("_n").alias("_c")), "_c").drop("_c", "_total")  # one row a range
    less = F.sum("_n").over(Window.partitionBy("_p").orderBy("_i")) - F.col("_n")
    ranked = values.withColumn("_k", less).join(F.broadcast(ranges), "_p").select("_v", (F.col("_before") + F.col("_k") + 1).cast("bigint").alias(name))
    return df.withColumn("_v", -F.col(column).cast("double")).join(ranked, "_v", "left").drop("_v")


def order_statistics(rows: DataFrame, keys: list[str], value: str, ranks: dict[str, Column], steps: int = 256) -> DataFrame:
    """``keys`` and, for each ``name: rank``, the value of that rank (from 1) in its group; a rank is a column of the group's size ``_n``.

    Selection by counting: equal values are counted first, so the group with a
    third of all rows is summed by every task; a histogram of ``steps`` equal
    steps between a group's least and greatest value tells in which step a rank
    lies, and only that step's values are put in order. Nulls have no rank, a
    null key is a group, and a group's values are never held in one row.
    """
    group = F.struct(*keys)
    counted = cut(rows.where(F.col(value).isNotNull()).groupBy(group.alias("_g"), F.col(value).alias("_v")).agg(F.count("*").alias("_c")))
    sizes = counted.groupBy("_g").agg(F.sum("_c").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    share = (F.col("_v").cast("double") - F.col("_low")) / (F.col("_high").cast("double") - F.col("_low"))
    step = F.when(F.col("_high") > F.col("_low"), F.least(F.floor(share * steps), F.lit(steps - 1))).otherwise(0)
    stepped = counted.join(sizes, "_g").select("_g", "_v", "_c", "_n", step.cast("int").alias("_step"))
    counts = stepped.groupBy("_g", "_step").agg(F.sum("_c").alias("_s"), F.first("_n").alias("_n"))  # at most ``steps`` rows a group
    upto = F.sum("_s").over(Window.partitionBy("_g").orderBy("_step"))
    asked = F.explode(F.array(*(F.struct(F.lit(name).alias("name"), rank.cast("long").alias("rank")) for name, rank in ranks.items())))
    asked = counts.withColumn("_before", upto - F.col("_s")).withColumn("_r", asked).where("_before < _r.rank AND _r.rank <= _before + _s")
    inside = stepped.select("_g", "_step", "_v", "_c").join(asked.select("_g", "_step", "_before", "_r"), ["_g", "_step"])
    here = F.sum("_c").over(Window.partitionBy("_g", "_r.name").orderBy("_v")) + F.col("_before")
    found = inside.withColumn("_k", here).where("_k >= _r.rank").groupBy("_g", F.col("_r.name").alias("_name")).agg(F.min("_v").alias("_v"))
    return found.groupBy("_g").agg(*(F.max(F.when(F.col("_name") == name, F.col("_v"))).alias(name) for name in ranks)).select("_g.*", *ranks)
