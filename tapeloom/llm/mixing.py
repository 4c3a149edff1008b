"""Mixing sources to target weights by weighted fair queueing, in DataFrame functions only.

Every document has a pseudo-random place (a hash of its id) in its source's
queue, and the queue runs up to ``epochs`` times. A copy's virtual finish time
is the words its source has sent up to and including it, divided by the
source's target. Copies are ordered by finish time over all sources and taken
until the budget is spent, so each source comes within a document of its target.

Running sums never put one source, or the whole order, into a single task: the
queue is dealt into slots by ranges of the hash (then of the finish time), the
slots are summed first, and each slot adds the sum of those before it.

Nulls: a null text has size 0, a null source is the last source, a null doc_id
has a place by its text. Rows that repeat (id and source) are separate documents next to each
other in the queue; where they differ in text alone, its hash orders them, so
reruns over other file splits agree. An empty table, or one without words, takes
nothing. The columns of ``docs`` may have any names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, stash

WEIGHTS, SHARE, EPOCHS, SLOTS = (5.0, 2.0, 1.0), 1.5, 2, 4096


def sizes(docs: DataFrame) -> DataFrame:
    """``(doc_id, source, size, place, slot)``; rows keep their number ``_n`` so that repeats stay apart."""
    text_hash = F.xxhash64(F.coalesce("text", F.lit("")))
    # rows without an id have only their text to tell them apart
    place = F.xxhash64(F.coalesce(F.col("doc_id"), text_hash), F.coalesce(F.col("source"), F.lit("")))
    out = docs.select("doc_id", "source", text_hash.alias("text_hash"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), place.alias("place"))
    out = out.withColumn("_n", F.monotonically_increasing_id())
    return stash(out.withColumn("slot", F.shiftright("place", 52) + SLOTS // 2), "mix-sizes")


def targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """``(source, source_size, target)``: the budget by weight, none above ``epochs`` times its source's size.

    The excess of capped sources goes to the others by weight, again and again;
    its fixed point is the level at which the capped ones are those with the
    least cap per unit of weight, found here by running sums in that order.
    One row for each source is all that this handles.
    """
    by = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    every = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*map(F.lit, weights))[((F.row_number().over(every) - 1) % len(weights)).cast("int")]
    cap = (epochs * F.col("source_size")).cast("double")
    by = by.withColumn("weight", cycle).withColumn("cap", cap).withColumn("ratio", F.col("cap") / F.col("weight"))
    up = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    down = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    budget = F.least(F.lit(share) * F.sum("source_size").over(whole), F.sum("cap").over(whole))
    level = (budget - F.coalesce(F.sum("cap").over(up), F.lit(0.0))) / F.sum("weight").over(down)
    by = by.withColumn("level", level)
    fits = F.col("level") <= F.col("ratio")
    final = F.min_by(F.when(fits, F.col("level")), F.when(fits, F.col("ratio"))).over(whole)
    target = F.least(F.col("cap"), F.coalesce(final, F.lit(float("inf"))) * F.col("weight"))
    return stash(by.select("source", "source_size", target.alias("target")), "mix-targets")


def schedule(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The sized documents, the targets, and the taken copies ``(_n, doc_id, source, size, epoch, finish)``."""
    sized = sizes(docs)
    goal = targets(sized, weights, share, epochs)
    slots = sized.groupBy("source", "slot").agg(F.sum("size").alias("words"))
    before = F.sum("words").over(Window.partitionBy("source").orderBy("slot")) - F.col("words")
    slots = slots.select(F.col("source").alias("_s"), F.col("slot").alias("_slot"), before.alias("sent"))
    slots = stash(slots.join(goal.withColumnRenamed("source", "_g"), F.col("_s").eqNullSafe(F.col("_g"))).drop("_g"), "mix-slots")
    inside = F.sum("size").over(Window.partitionBy("source", "slot").orderBy("place", "doc_id", "size", "text_hash", "_n").rowsBetween(Window.unboundedPreceding, 0))
    queue = sized.withColumn("inside", inside)
    queue = queue.join(slots, queue["source"].eqNullSafe(slots["_s"]) & (queue["slot"] == slots["_slot"])).where("target > 0 AND size > 0")
    copies = queue.withColumn("epoch", F.explode(F.array(*(F.lit(e) for e in range(epochs)))))
    finish = (F.col("sent") + F.col("inside") + F.col("epoch") * F.col("source_size")) / F.col("target")
    # a copy that ends a whole document after its source's target is never reached; the slots of the order are bounded with it
    copies = copies.withColumn("finish", finish).where("finish <= 1 + size / target").select("_n", "doc_id", "source", "size", "text_hash", "epoch", "finish")
    copies = stash(copies.withColumn("turn", F.least(F.floor(F.col("finish") * SLOTS), F.lit(4 * SLOTS)).cast("int")), "mix-copies")
    budget = goal.agg(F.round(F.sum("target")).cast("long").alias("budget"))
    turns = copies.groupBy("turn").agg(F.sum("size").alias("words"))
    order = Window.orderBy("turn")  # one row for each slot of the order
    turns = turns.select("turn", (F.sum("words").over(order) - F.col("words")).alias("taken_before")).join(F.broadcast(budget), F.lit(True))
    turns = stash(turns.where("taken_before < budget"), "mix-turns")
    upto = F.sum("size").over(Window.partitionBy("turn").orderBy("finish", "source", "doc_id", "epoch", "text_hash", "_n").rowsBetween(Window.unboundedPreceding, 0))
    taken = copies.withColumn("upto", upto).join(turns, "turn").where("taken_before + upto <= budget")
    return sized, goal, taken.select("_n", "doc_id", "source", "size", "epoch", "finish")


def mix(docs: DataFrame, **how) -> DataFrame:
    """``(doc_id, size, source_size, target, taken, copies)`` for every document."""
    sized, goal, taken = schedule(docs, **how)
    counts = taken.groupBy("_n").agg(F.count("*").alias("copies"))
    out = sized.join(goal.withColumnRenamed("source", "_g"), sized["source"].eqNullSafe(F.col("_g"))).join(counts, "_n", "left")
    copies = F.coalesce("copies", F.lit(0))
    return out.select("doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"), copies.alias("copies"), "source", "place", "text_hash")


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with their columns."""
    copies = mix(docs, **how).groupBy("doc_id", "text_hash", "source").agg(F.sum("copies").alias("copies"), F.count("*").alias("rows")).where("copies > 0")
    copies = stash(copies, "mix-taken").select(F.col("doc_id").alias("id"), "text_hash", F.col("source").alias("host"), "copies", "rows")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))
    same = F.col("doc.doc_id").eqNullSafe(F.col("id")) & F.col("doc.source").eqNullSafe(F.col("host")) & (F.xxhash64(F.coalesce("doc.text", F.lit(""))) == F.col("text_hash"))
    found = rows.join(copies, same)
    single = found.where("rows = 1").unionByName(found.where("rows > 1").dropDuplicates(["id", "text_hash", "host"]))  # repeated rows share one count
    return single.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("doc.*")
