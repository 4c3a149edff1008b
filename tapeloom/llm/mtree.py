"""Exact top-k by inner product: best-first search in an M-tree.

Vectors are lifted by one coordinate so that all have the norm of the longest:
the squared distance of a query to a lifted vector then falls exactly as their
inner product grows, and the nearest neighbours are the best scores.

The upper levels of the tree are tables. A node with more than ``subtree``
vectors is split: a few of its vectors become routing objects, every vector
goes to its nearest one, and the child keeps its routing object, its covering
radius and its distance to the parent's object. All crowded nodes of a level
are split in one pass, until none is left. A leaf of that tree is read by one
task, which builds its inner nodes and pages of at most ``PAGE`` entries, with
radii and parent distances again.

A query first descends to its nearest leaf and takes the k best there. Their
worst is its reach. Then it descends level by level into every node whose
covering ball the reach meets; a node whose stored parent distance rules it out
by the triangle inequality is not even compared. Only the leaves that are left
receive the query, and are searched best first with the reach it brings along.
Scores are integers and compared exactly, ties go to the smaller id.

Equal vectors have equal scores, so of each only the rows with the ``k + 1``
smallest ids can be among anyone's k best (one of them may be the query's own);
the rest are left out before the tree is built, and a vector that a third of
all rows share never fills a node. A row that repeats id and vector is counted,
not repeated.

Rows with a null id or vector, or with null or non-finite components, take no
part. Vectors of other lengths than the longest are padded with zeros. A query
leaves out its own row and no other: rows that repeat its id are candidates like
any, and so are all but one of the rows that repeat it whole. Equal queries are
answered once, queries of one id with other vectors each for itself. An empty
table has no result. Scaled components beyond 2**56 count as that bound; up to
there scores are exact whatever their size (as wide decimals where longs could
overflow) and decide the ranks, and a score that a long cannot hold is null.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from decimal import Decimal
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, stash

K, PAGE, SUBTREE, FANOUT, EVERY, UNIT, BOUND = 10, 128, 4096, 64, 100, 1024, 2**56
#: Routing objects of one level that are sent to every task, in bytes; vectors that meet their routing objects in one task where there are more.
SENT, MEET = 32_000_000, 200_000


def integers(vectors: DataFrame) -> DataFrame:
    """``(vec_id, v)``: floor(1024 x) of every component of the vectors that take part."""
    as_double = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    out = vectors.select(F.col("vec_id").cast("long"), as_double.alias("_v")).where(F.col("vec_id").isNotNull() & F.col("_v").isNotNull() & finite)
    scaled = lambda x: F.greatest(F.least(x * UNIT, F.lit(float(BOUND))), F.lit(-float(BOUND)))
    return out.select("vec_id", F.transform("_v", lambda x: F.floor(scaled(x))).alias("v"))


def candidates(rows: DataFrame, k: int) -> DataFrame:
    """``(vec_id, v, copies)``: all that can be among the k best of any query."""
    counted = rows.groupBy("v", "vec_id").agg(F.count("*").alias("n"))
    near = counted.withColumn("_rn", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("_rn") <= k + 1)
    return near.select("vec_id", "v", F.least("n", F.lit(k + 1)).cast("int").alias("copies"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    size = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy()
    out = np.zeros((len(column), dims), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def lift(vectors: np.ndarray, norm2: float) -> np.ndarray:
    x = vectors.astype(np.float64)
    return np.concatenate((x, np.sqrt(np.maximum(norm2 - (x * x).sum(1), 0))[:, None]), 1)


# The upper levels


def _nearest(x: np.ndarray, routers: np.ndarray, norm2: float) -> tuple[np.ndarray, np.ndarray]:
    """For each vector its nearest routing object and how far it is."""
    x, r = lift(x, norm2), lift(routers, norm2)
    best = (x @ r.T).argmax(1)  # all lifted vectors have one norm
    return best, np.sqrt(((x - r[best]) ** 2).sum(1))


_SPLIT = "vec_id long, v array<long>, copies int, node long, far double"


def _moved(batch: pa.RecordBatch, node: np.ndarray, child: np.ndarray, far: np.ndarray) -> pa.RecordBatch:
    columns = [batch.column("vec_id"), batch.column("v"), batch.column("copies"), pa.array(node * FANOUT + child + 1), pa.array(far)]
    return pa.RecordBatch.from_arrays(columns, names=["vec_id", "v", "copies", "node", "far"])


def _split(crowded: DataFrame, sizes: DataFrame, routers: DataFrame, dims: int, norm2: float, sent: int = SENT, meet: int = MEET) -> DataFrame:
    """``(vec_id, v, copies, node, far)``: every vector of ``crowded(node, ...)`` under the nearest routing object of its node.

    Up to ``sent`` bytes of routing objects go to every task once. Where a level
    has more, they go to their nodes' vectors: these are dealt by node in parts
    of about ``meet``, so no node, however large, is one task, and every part
    gets the node's routing objects once.
    """
    total = routers.agg(F.sum(F.size("routers"))).first()[0] * dims * 8
    if total <= sent:
        table = {r["node"]: np.array([list(v) + [0] * (dims - len(v)) for v in r["routers"]], np.int64) for r in routers.collect()}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, node = _matrix(batch.column("v"), dims), batch.column("node").to_numpy()
                child, far = np.zeros(len(node), np.int64), np.zeros(len(node))
                for n in np.unique(node):
                    at = np.flatnonzero(node == n)
                    child[at], far[at] = _nearest(x[at], table[int(n)], norm2)
                yield _moved(batch, node, child, far)

        return crowded.select("vec_id", "v", "copies", "node").mapInArrow(run, _SPLIT)

    parts = sizes.select("node", F.ceil(F.col("n") / meet).cast("int").alias("parts"))
    dealt = crowded.join(parts, "node").select("node", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("kind"), F.lit(0).alias("no"), "vec_id", "v", "copies")
    objects = routers.join(parts, "node").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    objects = objects.select("node", "part", F.lit(0).alias("kind"), F.posexplode("routers").alias("no", "v"), F.lit(0).cast("long").alias("vec_id"), F.lit(0).alias("copies"))
    both = dealt.unionByName(objects).repartition(partitions(crowded.sparkSession), "node", "part").sortWithinPartitions("node", "part", "kind", "no")

    def meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, known = None, []
        for batch in batches:
            node, part, kind = (batch.column(c).to_numpy() for c in ("node", "part", "kind"))
            cuts = np.flatnonzero(np.concatenate(([True], (node[1:] != node[:-1]) | (part[1:] != part[:-1]) | (kind[1:] != kind[:-1]), [True])))
            for a, b in zip(cuts[:-1], cuts[1:]):
                piece = batch.slice(a, b - a)
                x = _matrix(piece.column("v"), dims)
                if (node[a], part[a]) != place:
                    place, known = (node[a], part[a]), []
                if kind[a] == 0:
                    known.append(x)
                    continue
                yield _moved(piece, node[a:b], *_nearest(x, np.concatenate(known), norm2))

    return both.mapInArrow(meeting, _SPLIT)


def _dot(a: str, b: str) -> Column:
    """Inner product of two vectors for bounds, not for scores; a shorter one is padded with zeros."""
    number = lambda x: F.coalesce(x.cast("double"), F.lit(0.0))
    return F.aggregate(F.zip_with(a, b, lambda x, y: number(x) * number(y)), F.lit(0.0), lambda s, x: s + x)


def _lifted_distance(a: str, b: str, norm2: float) -> Column:
    """Distance of two lifted vectors."""
    high = lambda c: F.sqrt(F.greatest(F.lit(norm2) - _dot(c, c), F.lit(0.0)))
    return F.sqrt(F.greatest(2 * (F.lit(norm2) - _dot(a, b) - high(a) * high(b)), F.lit(0.0)))


def grow(rows: DataFrame, dims: int, norm2: float, subtree: int, fanout: int, sent: int = SENT) -> tuple[DataFrame, DataFrame, int]:
    """The leaves' vectors ``(node, vec_id, v, copies)``, the nodes ``(node, parent, router, radius, parent_far, leaf)`` and the number of levels."""
    now = rows.withColumn("node", F.lit(0).cast("long"))
    sizes = now.groupBy("node").agg(F.count("*").alias("n"))
    leaves, nodes, levels, above = [], [], 0, None
    while True:
        sizes = stash(sizes, "mtree-sizes")
        crowded = sizes.where(F.col("n") > subtree)
        if crowded.isEmpty():
            leaves.append(now.select("node", "vec_id", "v", "copies"))
            break
        if levels:
            leaves.append(now.join(crowded, "node", "left_anti").select("node", "vec_id", "v", "copies"))
            full = now.join(crowded, "node")
        else:  # all are in the root
            full = now.withColumn("n", F.lit(sizes.first()["n"]))
        # a node needs no more routing objects than twice its leaves
        place = F.row_number().over(Window.partitionBy("node").orderBy(F.xxhash64("vec_id", F.lit(levels)), "vec_id"))
        wanted = F.least(F.lit(fanout), F.greatest(F.lit(2), F.ceil(2 * F.col("n") / subtree)))
        some = full.withColumn("_k", place).where((F.col("_k") <= fanout) & (F.col("_k") <= wanted))
        routers = stash(some.groupBy("node").agg(F.array_sort(F.array_distinct(F.collect_list("v"))).alias("routers")), "mtree-routers")
        now = stash(_split(full.select("node", "vec_id", "v", "copies"), crowded, routers, dims, norm2, sent), "mtree-level")
        sizes = now.groupBy("node").agg(F.count("*").alias("n"), F.max("far").alias("radius"))
        sizes = stash(sizes, "mtree-radii")
        child = routers.select(F.col("node").alias("parent"), F.posexplode("routers").alias("no", "router")).withColumn("node", F.col("parent") * FANOUT + F.col("no") + 1)
        level = child.join(sizes, "node").select("node", "parent", "router", "radius", (F.col("n") <= subtree).alias("leaf"))
        if above is None:
            level = level.withColumn("parent_far", F.lit(None).cast("double"))
        else:
            over = above.select(F.col("node").alias("parent"), F.col("router").alias("parent_router"))
            level = level.join(over, "parent").withColumn("parent_far", _lifted_distance("router", "parent_router", norm2)).drop("parent_router")
        above = stash(level, "mtree-nodes")
        nodes.append(above)
        sizes, levels = sizes.select("node", "n"), levels + 1
    union = lambda x: reduce(DataFrame.unionByName, x)
    return union(leaves), union(nodes) if nodes else None, levels


def _below(frontier: DataFrame, nodes: DataFrame, norm2: float) -> DataFrame:
    """The children of the frontier's nodes with the query's distance ``d`` and least possible distance ``low``."""
    children = nodes.select(F.col("node").alias("child"), F.col("parent").alias("node"), "router", "radius", "parent_far", "leaf")
    rows = frontier.join(children, "node")
    if "reach" in frontier.columns:  # no distance is taken where the stored one rules the child out
        rows = rows.where(F.col("d").isNull() | F.col("parent_far").isNull() | (F.abs(F.col("d") - F.col("parent_far")) - F.col("radius") <= F.col("reach")))
    d = F.sqrt(F.greatest(F.col("q2") + norm2 - 2.0 * _dot("v", "router"), F.lit(0.0)))
    return rows.withColumn("d", d).withColumn("low", F.greatest(F.col("d") - F.col("radius"), F.lit(0.0))).drop("node", "router", "radius", "parent_far").withColumnRenamed("child", "node")


def nearest_leaf(queries: DataFrame, nodes: DataFrame, levels: int, norm2: float) -> DataFrame:
    """``(vec_id, q, v, q2, node)``: the leaf that a query reaches by its nearest routing object on every level."""
    now, done = queries.withColumn("node", F.lit(0).cast("long")), []
    for _ in range(levels):
        step = _below(now, nodes, norm2)
        best = F.row_number().over(Window.partitionBy("vec_id", "q").orderBy("d", "node"))
        step = stash(step.withColumn("_rn", best).where("_rn = 1").select("vec_id", "q", "v", "q2", "node", "leaf"), "mtree-descent")
        done.append(step.where("leaf").drop("leaf"))
        now = step.where("NOT leaf").drop("leaf")
    return reduce(DataFrame.unionByName, done)


def within_reach(queries: DataFrame, nodes: DataFrame, levels: int, norm2: float) -> DataFrame:
    """``(vec_id, q, v, q2, reach, node)``: the leaves whose covering ball a query's ``reach`` meets."""
    now, done = queries.withColumns({"node": F.lit(0).cast("long"), "d": F.lit(None).cast("double")}), []
    for _ in range(levels):
        step = stash(_below(now, nodes, norm2).where("low <= reach").select("vec_id", "q", "v", "q2", "reach", "node", "d", "leaf"), "mtree-frontier")
        done.append(step.where("leaf").drop("leaf", "d"))
        now = step.where("NOT leaf").drop("leaf")
    return reduce(DataFrame.unionByName, done)


# A leaf: inner nodes and pages in one task


class Node:
    """A routing object with its covering radius; either entries with their distances to it, or children with theirs."""

    __slots__ = ("router", "radius", "far", "children", "at", "parent")

    def __init__(self, lifted: np.ndarray, at: np.ndarray, over: np.ndarray | None):
        x = lifted[at]
        self.router = x[((x - x.mean(0)) ** 2).sum(1).argmin()]
        away = np.sqrt(((x - self.router) ** 2).sum(1))
        self.radius, self.at, self.far, self.children = float(away.max()), at, away, []
        self.parent = float(np.sqrt(((self.router - over) ** 2).sum())) if over is not None else 0.0
        if len(at) > PAGE:
            a = int(away.argmax())
            da = ((x - x[a]) ** 2).sum(1)
            b = int(da.argmax())
            near = da < ((x - x[b]) ** 2).sum(1)
            if not 0 < near.sum() < len(at):  # all alike: any split will do
                near = np.arange(len(at)) < len(at) // 2
            self.children = [Node(lifted, at[near], self.router), Node(lifted, at[~near], self.router)]


class Tree:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray, copies: np.ndarray, norm2: float):
        self.ids, self.vectors, self.copies, self.norm2 = ids, vectors, copies, norm2
        self.root = Node(lift(vectors, norm2), np.arange(len(ids)), None)

    def scores(self, at: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Exact inner products; Python's integers where longs could overflow."""
        if self.norm2 < 2.0**62:
            return self.vectors[at] @ query
        return self.vectors[at].astype(object) @ query.astype(object)

    def search(self, qid: int, query: np.ndarray, k: int, reach: float) -> list[tuple[int, int]]:
        """The k best ``(score, -id)`` for a query among those within its reach, best first."""
        q = np.append(query.astype(np.float64), 0.0)
        top = float(q @ q) + self.norm2
        slack = 1e-6 * (1 + np.sqrt(top))  # rounding must never rule out a vector
        away = float(np.sqrt(((self.root.router - q) ** 2).sum()))
        heap, no, best = [(max(away - self.root.radius, 0), 0, away, self.root)], 0, []
        while heap:
            low, _, d, node = heapq.heappop(heap)
            if low > reach + slack:
                break
            for child in node.children:
                if abs(d - child.parent) - child.radius > reach + slack:
                    continue
                away = float(np.sqrt(((child.router - q) ** 2).sum()))
                no += 1
                heapq.heappush(heap, (max(away - child.radius, 0), no, away, child))
            if node.children:
                continue
            at = node.at[np.abs(d - node.far) <= reach + slack]
            score = self.scores(at, query)
            if len(best) == k:  # the rest cannot enter
                near = score >= best[0][0]
                at, score = at[near], score[near]
            own = self.ids[at] == qid
            own[own] = (self.vectors[at[own]] == query).all(1)
            for s, i, less in zip(score.tolist(), at.tolist(), own.tolist()):
                for _ in range(int(self.copies[i]) - less):
                    entry = (s, -int(self.ids[i]))
                    if len(best) < k:
                        heapq.heappush(best, entry)
                    elif entry > best[0]:
                        heapq.heapreplace(best, entry)
            if len(best) == k:
                reach = min(reach, np.sqrt(max(top - 2.0 * best[0][0], 0)) + slack)
        return sorted(best, reverse=True)


def searched(leaves: DataFrame, asked: DataFrame, dims: int, norm2: float, k: int) -> DataFrame:
    """``(query_id, q, vec_id, score)``: the k best of each leaf for the queries ``asked(vec_id, v, q, reach, node)`` of it."""
    kept = leaves.join(asked.select("node").distinct(), "node", "left_semi").select("node", F.lit(0).alias("kind"), "vec_id", "v", "copies", F.lit(0.0).alias("reach"), F.lit(0).cast("long").alias("q"))
    both = kept.unionByName(asked.select("node", F.lit(1).alias("kind"), "vec_id", "v", F.lit(0).alias("copies"), "reach", "q"))
    wide = norm2 >= 2.0**62
    kind = pa.decimal128(38, 0) if wide else pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, got, tree = None, [], None
        for batch in batches:
            nodes, kinds = batch.column("node").to_numpy(), batch.column("kind").to_numpy()
            cuts = np.flatnonzero(np.concatenate(([True], (nodes[1:] != nodes[:-1]) | (kinds[1:] != kinds[:-1]), [True])))
            for a, b in zip(cuts[:-1], cuts[1:]):
                part = batch.slice(a, b - a)
                ids, x = part.column("vec_id").to_numpy(), _matrix(part.column("v"), dims)
                if nodes[a] != node:
                    node, got, tree = nodes[a], [], None
                if kinds[a] == 0:
                    got.append((ids, x, part.column("copies").to_numpy()))
                    continue
                if tree is None:
                    tree, got = Tree(*(np.concatenate(y) for y in zip(*got)), norm2), []
                out = [(int(i), int(q), -v, Decimal(s) if wide else s) for i, q, y, r in zip(ids, part.column("q").to_numpy(), x, part.column("reach").to_numpy()) for s, v in tree.search(int(i), y, k, float(r))]
                if out:
                    i, q, v, s = zip(*out)
                    yield pa.RecordBatch.from_arrays([pa.array(i, pa.int64()), pa.array(q, pa.int64()), pa.array(v, pa.int64()), pa.array(s, kind)], names=["query_id", "q", "vec_id", "score"])

    laid = both.repartition(partitions(leaves.sparkSession), "node").sortWithinPartitions("node", "kind", "vec_id")
    return laid.mapInArrow(run, f"query_id long, q long, vec_id long, score {'decimal(38,0)' if wide else 'long'}")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "q", "rank", "vec_id", "score")


def _shown(ranked: DataFrame) -> DataFrame:
    return ranked.select("query_id", "rank", "vec_id", F.expr("try_cast(score AS bigint)").alias("score"))


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, subtree: int = SUBTREE, fanout: int = FANOUT, sent: int = SENT) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` for the rows whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    rows = stash(integers(vectors), "mtree-vectors")
    dims, norm2 = rows.agg(F.max(F.size("v")), F.max(_dot("v", "v"))).first()
    if dims is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dims, norm2 = max(1, int(dims)), float(norm2)
    leaves, nodes, levels = grow(stash(candidates(rows, k), "mtree-candidates"), dims, norm2, subtree, fanout, sent)
    queries = stash(rows.where(F.col("vec_id") % every == 0).distinct().withColumns({"q": F.xxhash64("v"), "q2": _dot("v", "v")}), "mtree-queries")
    endless = F.lit(float("inf"))
    if not levels:
        return _shown(_ranked(searched(leaves, queries.select("vec_id", "q", "v", endless.alias("reach"), F.lit(0).cast("long").alias("node")), dims, norm2, k), k))
    first = nearest_leaf(queries, nodes, levels, norm2)
    begun = stash(_ranked(searched(leaves, first.withColumn("reach", endless), dims, norm2, k), k), "mtree-first")
    worst = begun.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), "q", F.col("score").cast("double").alias("worst"))
    slack = 1e-6 * (1 + F.sqrt(F.col("q2") + norm2))
    reach = F.when(F.col("worst").isNull(), endless).otherwise(F.sqrt(F.greatest(F.col("q2") + norm2 - 2.0 * F.col("worst"), F.lit(0.0))) + slack)
    known = queries.join(worst, ["vec_id", "q"], "left").withColumn("reach", reach).drop("worst")
    rest = within_reach(known, nodes, levels, norm2).join(first.select("vec_id", "q", "node"), ["vec_id", "q", "node"], "left_anti")
    return _shown(_ranked(begun.select("query_id", "q", "vec_id", "score").unionByName(searched(leaves, rest, dims, norm2, k)), k))
