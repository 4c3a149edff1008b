"""Order statistics and global ranks against sorted lists."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tapeloom.functions.ranking import cume_dists, ntile, order_statistics, position, rank_from_top


def test_order_statistics_equal_sorted_lists(spark):
    rng = random.Random(8)
    groups = {"even": [rng.random() for _ in range(500)], "ties": [rng.choice([1.0, 2.0, 5.0]) for _ in range(301)], "wide": [1e12, -1e12, *[0.001 * k for k in range(100)]], "one": [7.0], "two": [1.0, 2.0], None: [3.0, -1.0, 2.0], "same": [4.0] * 50}
    rows = [(k, v) for k, values in groups.items() for v in values] + [("even", None), ("none", None)]
    rng.shuffle(rows)
    n = F.col("_n")
    ranks = {"least": F.lit(1), "quarter": F.expr("_n div 4 + 1"), "lower": F.floor((n + 1) / 2), "last": n}
    for steps in (256, 1, 3):
        got = {r["k"]: tuple(r[c] for c in ranks) for r in order_statistics(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", ranks, steps).collect()}
        assert got == {k: (s[0], s[len(s) // 4], s[(len(s) + 1) // 2 - 1], s[-1]) for k, s in ((k, sorted(v)) for k, v in groups.items())}
    assert order_statistics(spark.createDataFrame([], "k string, v double"), ["k"], "v", ranks).count() == 0


@pytest.fixture(params=[True, False], ids=["merged ranges", "all ranges"])
def ranges(spark, request):
    """Small ranges merged into one, as Spark does with few rows, and left apart."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", request.param)
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def scored(n: int = 900) -> list[tuple[str, float | None]]:
    """A third without a value, a third with the same one, the rest spread with some ties."""
    rng = random.Random(5)
    values = [None if k % 3 == 0 else 2.5 if k % 3 == 1 else rng.choice([rng.uniform(-9, 9), 7.0, 0.0]) for k in range(n)]
    rows = [(f"t{k:04d}", v) for k, v in enumerate(values)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("descending", [False, True])
def test_position_and_ntile_equal_a_sorted_list(spark, ranges, descending):
    rows = scored()
    df = spark.createDataFrame(rows, "k string, v double")
    sign = -1 if descending else 1
    order = [k for k, v in sorted(rows, key=lambda r: (r[1] is None, sign * (r[1] or 0.0), r[0]))]
    got = position(df, "v", "at", "k", descending).collect()
    assert {r["k"]: r["at"] for r in got} == {k: i + 1 for i, k in enumerate(order)}
    assert {r["_total"] for r in got} == {len(rows)}
    tiles = {r["k"]: r["tile"] for r in ntile(df, 7, "v", "tile", "k", descending).collect()}
    size, more = divmod(len(rows), 7)
    want = [t + 1 for t in range(7) for _ in range(size + (t < more))]
    assert tiles == dict(zip(order, want))


def test_shares_and_ranks_of_peers_equal_counts(spark, ranges):
    rows = scored()
    df = spark.createDataFrame(rows, "k string, v double")
    there = [v for _, v in rows if v is not None]
    nulls = len(rows) - len(there)
    got = {r["k"]: r for r in cume_dists(df, "k", {"up": ("v", False, True), "down": ("v", True, False)}).collect()}
    top = {r["k"]: r["rank"] for r in rank_from_top(df, "v", "rank").collect()}
    assert len(got) == len(top) == len(rows)
    for k, v in rows:
        up = nulls if v is None else nulls + sum(x <= v for x in there)
        down = len(rows) if v is None else sum(x >= v for x in there)
        assert (got[k]["up"], got[k]["down"]) == (up / len(rows), down / len(rows))
        assert top[k] == (None if v is None else 1 + sum(x > v for x in there))


def test_ranks_of_nothing(spark, ranges):
    empty, nulls = spark.createDataFrame([], "k string, v double"), spark.createDataFrame([("b", None), ("a", None)], "k string, v double")
    assert position(empty, "v", "at", "k").count() == ntile(empty, 5, "v", "at", "k").count() == rank_from_top(empty, "v", "at").count() == cume_dists(empty, "k", {"c": ("v", False, True)}).count() == 0
    assert {r["k"]: r["at"] for r in position(nulls, "v", "at", "k").collect()} == {"a": 1, "b": 2}
    assert {r["at"] for r in rank_from_top(nulls, "v", "at").collect()} == {None}
    assert {r["c"] for r in cume_dists(nulls, "k", {"c": ("v", False, True)}).collect()} == {1.0}
