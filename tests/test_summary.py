"""Quantile summaries and the parts cut from them."""

import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablehaul.plans import balance, summary
from tablehaul.plans.balance import lower_bounds, plan_leaves, with_leaf_number
from tablehaul.plans.summary import Summary, cuts, decode, encode
from tablehaul.sources.tables import read_by_key_range


def skewed(n, seed):
    pick = np.random.default_rng(seed)
    return [
        pick.integers(-(2**63), 2**63 - 1, n),
        np.arange(n) ** 2,
        (pick.pareto(0.3, n) * 100).clip(0, 2**60).astype(np.int64),
        np.where(pick.random(n) < 0.4, 7, pick.integers(0, 1000, n)),
    ][seed % 4]


def test_encoded_keys_sort_like_tuples():
    pick = np.random.default_rng(3)
    columns = [pick.integers(-3, 3, 500), pick.integers(-(2**63), 2**63 - 1, 500), pick.integers(0, 2, 500)]
    order = np.argsort(encode(columns), kind="stable")
    assert [tuple(c[i] for c in columns) for i in order] == sorted(zip(*columns, strict=True))
    assert all((a == b).all() for a, b in zip(columns, decode(encode(columns), 3), strict=True))
    assert (decode(encode(columns[1:2]), 1)[0] == columns[1]).all()


@pytest.mark.parametrize("seed", range(8))
def test_ranks_stay_within_the_bound(seed):
    """Three levels of merging: each adds at most half a point's weight to a rank."""
    points, rows = 500, skewed(200_000, seed)
    leaves = [Summary.of(encode([part])).compressed(points) for part in np.array_split(rows, 24)]
    middle = [Summary.merged(leaves[i : i + 6]).compressed(points) for i in range(0, 24, 6)]
    whole = Summary.merged(middle).compressed(points)
    assert whole.weights.sum() == len(rows) and len(whole.keys) <= points
    keys, ends = np.sort(encode([rows])), np.cumsum(whole.weights)
    low = np.searchsorted(keys, whole.keys, "left")
    high = np.searchsorted(keys, whole.keys, "right")
    off = np.maximum(low - ends, (ends - whole.weights) - high).max()
    assert off <= 3 * len(rows) / points


@pytest.mark.parametrize("seed", range(8))
def test_merging_by_slices(monkeypatch, seed):
    """The same summary as from one sort of all points, without a copy of them."""
    monkeypatch.setattr(summary, "SLICE_POINTS", 2_000)
    rows = skewed(200_000, seed)
    order = np.sort(rows) if seed >= 4 else rows
    parts = [Summary.of(encode([part, part % 7])) for part in np.array_split(order, 6)]
    for points in (50, 4_000, 150_000, 300_000):
        whole, want = summary.merge(parts, points), Summary.merged(parts).compressed(points)
        assert (whole.keys == want.keys).all() and (whole.weights == want.weights).all()


def test_merging_holds_its_parts_and_little_more():
    pick = np.random.default_rng(1)
    parts = [Summary.of(encode([pick.integers(0, 2**60, 400_000) for _ in range(6)])) for _ in range(8)]
    tracemalloc.start()
    whole = summary.merge(parts, 100_000)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(whole.keys) == 100_000 and peak < sum(p.keys.nbytes for p in parts) / 2


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("parts", [8, 100])
def test_parts_are_even(spark, seed, parts):
    rows = skewed(120_000, seed)
    df = spark.createDataFrame([(int(a), i) for i, a in enumerate(rows)], "a bigint, b bigint").repartition(7)
    leaves = plan_leaves(df, ["a", "b"], parts, int(rows.min()), int(rows.max()), len(rows))
    share = len(rows) / parts
    assert sum(leaf.rows for leaf in leaves) == len(rows) and min(leaf.rows for leaf in leaves) > 0
    whole = [leaf.rows for leaf in leaves if not leaf.prefix]
    if seed < 2:
        assert len(leaves) == parts and 0.95 * share <= min(whole) and max(whole) <= 1.05 * share
    assert max(leaf.rows for leaf in leaves) <= 2.05 * share


@pytest.mark.parametrize("heavy", [2, 40, 700])
def test_key_columns_are_read_twice(spark, heavy):
    read = spark.sparkContext.accumulator(0)

    @F.pandas_udf("bigint")
    def seen(v):
        read.add(len(v))
        return v

    df = spark.range(0, 21_000, 1, 5).select(seen(F.col("id") % heavy).alias("a"), F.col("id").alias("b"))
    leaves = plan_leaves(df, ["a", "b"], 300, 0, heavy - 1, 21_000)
    assert read.value == 2 * 21_000 and sum(leaf.rows for leaf in leaves) == 21_000
    assert max(leaf.rows for leaf in leaves) <= 2.05 * 70


def test_many_tasks_are_merged_in_levels(spark, monkeypatch):
    monkeypatch.setattr(summary, "MERGED_ROWS", 500)
    monkeypatch.setattr(summary, "FAN_IN", 4)
    monkeypatch.setattr(summary, "FEWEST_POINTS", 64)
    monkeypatch.setattr(summary, "CHUNK_ROWS", 100)
    df = spark.range(0, 30_000, 1, 40).select((F.col("id") * 7919 % 30_011).alias("a"))
    leaves = plan_leaves(df, ["a"], 6, 0, 30_010, 30_000)
    assert [leaf.rows > 4_500 for leaf in leaves] == [True] * 6 and sum(leaf.rows for leaf in leaves) == 30_000


@pytest.mark.parametrize("parts", [8, 10_000])
def test_rows_are_placed_without_python(spark, parts):
    orders = spark.range(0, 40_000, 1, 4).select((F.col("id") * F.col("id")).alias("k"), F.col("id").alias("v"))
    split = read_by_key_range(orders, ["k"], parts, even_floor=0)
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    sizes = split.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi")).orderBy("p").collect()
    assert len(sizes) == parts and sum(r.n for r in sizes) == 40_000
    assert all(a.hi < b.lo for a, b in zip(sizes, sizes[1:], strict=False))
    assert max(r.n for r in sizes) <= 1.05 * 40_000 / parts + 1


@pytest.mark.parametrize("columns", [1, 3])
@pytest.mark.parametrize("n", [1, 2, 63, 64, 65, 1000])
def test_places_are_those_of_a_binary_search(spark, n, columns):
    pick = np.random.default_rng(n)
    bounds = sorted({tuple(int(x) for x in row) for row in pick.integers(-50, 50, (n, columns))})
    leaves = [balance.Leaf(b[:-1], b[-1], b[-1], 0) for b in bounds]
    rows = [tuple(int(x) for x in row) for row in pick.integers(-60, 60, (400, columns))]
    df = spark.createDataFrame(rows, ", ".join(f"k{i} bigint" for i in range(columns)))
    got = with_leaf_number(df, leaves, df.columns, "n").collect()
    lower = lower_bounds(leaves, columns)
    assert [r.n for r in got] == [max(sum(b <= tuple(r[:-1]) for b in lower) - 1, 0) for r in got]


def test_one_full_key_that_fills_shares(spark):
    df = spark.createDataFrame([(5, 7)] * 500 + [(5, 3)] + [(i, 0) for i in range(100)], "a bigint, b bigint").repartition(4)
    leaves = plan_leaves(df, ["a", "b"], 10, 0, 99, 601)
    assert [leaf.rows for leaf in leaves if leaf.one_key and leaf.rows > 1] == [500]
    split = read_by_key_range(df, ["a", "b"], 10, even_floor=0)
    held = split.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in held) <= 140 and sum(r["count"] for r in held) == 601


def test_cuts_of_few_points():
    one = Summary.of(encode([np.array([4, 4, 4])]))
    assert cuts(one, 1, 3, 4, 4) == [([], 4, 4)]
    assert cuts(Summary.of(encode([np.array([1, 2, 3, 4])])), 1, 2, 0, 9) == [([], 0, 2), ([], 3, 9)]
