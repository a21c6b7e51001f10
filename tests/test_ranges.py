import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tablehaul.plans.balance import plan_leaves, with_leaf_number
from tablehaul.plans.profile import profile_frame, profile_key
from tablehaul.plans.ranges import (
    assign_range,
    leaf_predicates,
    plan_balanced_ranges,
    plan_chunks,
    plan_key_predicates,
    plan_ranges,
    range_counts,
    range_id,
    range_predicates,
)

LO, HI = -(2**63), 2**63 - 1


@given(st.integers(LO, HI), st.integers(LO, HI), st.integers(1, 300))
@settings(max_examples=300, deadline=None)
def test_ranges_partition_the_interval(a, b, n):
    lo, hi = min(a, b), max(a, b)
    ranges = plan_ranges(lo, hi, n)
    assert ranges[0].lo == lo and ranges[-1].hi == hi
    assert all(r.lo <= r.hi for r in ranges)
    assert all(x.hi + 1 == y.lo for x, y in zip(ranges, ranges[1:]))
    widths = [r.hi - r.lo for r in ranges]
    assert max(widths) - min(widths) <= 1
    assert len(ranges) == min(n, hi - lo + 1)


def test_bad_plans_are_refused():
    with pytest.raises(ValueError):
        plan_ranges(0, 10, 0)
    with pytest.raises(ValueError):
        plan_ranges(5, 4, 2)


random.seed(7)
CASES = {
    "dense": list(range(100)),
    "one": [7],
    "mixed": [-5, -1, 0, 3, 9],
    "extreme": [LO, -1, 0, 1, HI],
    "near_top": [HI - 3, HI - 2, HI - 1, HI],
    "random": sorted({random.randint(LO, HI) for _ in range(80)}),
    "squares": [i * i for i in range(120)],
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("n", [1, 2, 7, 8, 64, "n+3"])
def test_range_id_agrees_with_plan(keyed, name, n):
    keys = CASES[name]
    n = len(keys) + 3 if n == "n+3" else n
    lo, hi = min(keys), max(keys)
    plan = plan_ranges(lo, hi, n)
    got = keyed(keys).select("k", range_id(F.col("k"), lo, hi, n).alias("r")).collect()
    assert len(got) == len(keys)
    for row in got:
        assert plan[row["r"]].lo <= row["k"] <= plan[row["r"]].hi


def test_range_counts_show_empty_ranges(keyed):
    counts = range_counts(keyed([0, 1, 2, 79]), "k", 8).orderBy("range_id").collect()
    assert [r["n_rows"] for r in counts] == [3, 0, 0, 0, 0, 0, 0, 1]


def test_range_counts_of_empty_table(keyed):
    assert range_counts(keyed([1]).where("false"), "k", 8).count() == 0


@pytest.mark.parametrize("size", [1, 4, 7, 1000])
def test_chunks_are_disjoint_and_cover(spark, size):
    ranges = plan_ranges(-20, 41, 5)
    chunks = plan_chunks(spark, ranges, size).collect()
    keys = [k for c in chunks for k in range(c["lo"], c["hi"] + 1)]
    assert sorted(keys) == list(range(-20, 42))
    assert all(c["hi"] - c["lo"] + 1 <= size for c in chunks)


def test_chunks_at_the_bigint_bound(spark):
    chunks = plan_chunks(spark, plan_ranges(HI - 9, HI, 2), 4).orderBy("lo").collect()
    assert chunks[-1]["hi"] == HI and sum(c["hi"] - c["lo"] + 1 for c in chunks) == 10



def test_balanced_ranges_even_out_squares(keyed):
    df = keyed([i * i for i in range(4000)])
    ranges = plan_balanced_ranges(df, "k", 8)
    counts = df.groupBy(assign_range(F.col("k"), ranges).alias("r")).count().collect()
    assert len(counts) == 8
    assert all(450 <= c["count"] <= 550 for c in counts)
    assert ranges[0].lo == 0 and ranges[-1].hi == 3999**2
    assert all(x.hi + 1 == y.lo for x, y in zip(ranges, ranges[1:]))


def test_balanced_ranges_with_one_hot_value(keyed):
    df = keyed([5] * 900 + list(range(100)))
    ranges = plan_balanced_ranges(df, "k", 8)
    assert any(r.lo == 5 == r.hi for r in ranges) and len(ranges) <= 8
    ids = df.select(assign_range(F.col("k"), ranges).alias("r"), "k").collect()
    assert len(ids) == 1000
    assert all(ranges[x["r"]].lo <= x["k"] <= ranges[x["r"]].hi for x in ids)


@pytest.mark.parametrize("open_ended", [False, True])
@pytest.mark.parametrize("n", [1, 2, 8, 64])
def test_each_row_meets_one_predicate(keyed, n, open_ended):
    keys = [-5, -1, 0, 3, 9, 500]
    predicates = range_predicates("`k`", plan_ranges(-5, 500, n), open_ended)
    df = keyed(keys + ([-1000, 1000] if open_ended else []))
    hits = df.select(sum(F.expr(p).cast("int") for p in predicates).alias("hits")).collect()
    assert {r["hits"] for r in hits} == {1}


@pytest.mark.parametrize("hot", [0, 1, 50, 98, 99])
def test_a_hot_value_anywhere_stands_alone(keyed, hot):
    ranges = plan_balanced_ranges(keyed([hot] * 300 + list(range(100)) * 3), "k", 8)
    assert any(r.lo == hot == r.hi for r in ranges) and len(ranges) <= 8
    assert ranges[0].lo == 0 and ranges[-1].hi == 99
    assert all(x.hi + 1 == y.lo for x, y in zip(ranges, ranges[1:]))


def test_any_number_of_balanced_ranges(keyed):
    """More ranges than a comparison tree holds; ids agree with the plan."""
    df = keyed([i * i for i in range(4000)])
    ranges = plan_balanced_ranges(df, "k", 1500)
    assert 1300 <= len(ranges) <= 1500
    ids = df.select(assign_range(F.col("k"), ranges).alias("r"), "k").collect()
    assert all(ranges[x["r"]].lo <= x["k"] <= ranges[x["r"]].hi for x in ids)
    predicates = plan_key_predicates(df, ["k"], 20)
    hits = df.select(sum(F.expr(p).cast("int") for p in predicates).alias("hits")).distinct().collect()
    assert [r["hits"] for r in hits] == [1] and 18 <= len(predicates) <= 20


def test_extreme_keys_are_cut(keyed):
    keys = [-(2**63), 2**63 - 1, *range(-50, 50), *[2**62 + i for i in range(100)]]
    ranges = plan_balanced_ranges(keyed(keys), "k", 10)
    assert ranges[0].lo == -(2**63) and ranges[-1].hi == 2**63 - 1 and len(ranges) >= 8
    assert all(x.hi + 1 == y.lo for x, y in zip(ranges, ranges[1:]))
    assert max(sum(r.lo <= k <= r.hi for k in keys) for r in ranges) <= 2 * len(keys) / 10


def test_jobs_do_not_grow_with_heavy_values(spark, monkeypatch):
    """All heavy values of a column are counted in the same jobs."""

    def jobs(heavy):
        df = spark.range(8000).select((F.col("id") % heavy).alias("a"), (F.col("id") * 7 % 8000).alias("b"))
        collects = []
        collect = type(df).collect
        monkeypatch.setattr(type(df), "collect", lambda self: collects.append(1) or collect(self))
        leaves = plan_leaves(df, ["a", "b"], 100, 0, heavy - 1, 8000)
        monkeypatch.undo()
        assert sum(leaf.rows for leaf in leaves) == 8000 and max(leaf.rows for leaf in leaves) <= 160
        return len(collects)

    assert jobs(2) == jobs(20)


def test_leaves_place_rows_like_their_predicates(spark):
    rows = [(7, i % 5, i) for i in range(300)] + [(i, 0, 0) for i in range(-20, 40)] + [(7, 2, 0)] * 50
    df = spark.createDataFrame(rows, "a long, b int, c long")
    leaves = plan_leaves(df, ["a", "b", "c"], 12, -20, 39, len(rows))
    predicates = leaf_predicates(leaves, ["a", "b", "c"])
    hits = [F.when(F.expr(p), i) for i, p in enumerate(predicates)]
    placed = with_leaf_number(df, leaves, ["a", "b", "c"], "n")
    wrong = placed.select("n", F.coalesce(*hits).alias("m")).where("n <> m OR m IS NULL")
    assert wrong.count() == 0 and any(leaf.prefix for leaf in leaves)
    assert [(*leaf.prefix, leaf.lo) for leaf in leaves] == sorted((*leaf.prefix, leaf.lo) for leaf in leaves)


def test_composite_predicates_split_a_hot_leading_key(spark):
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, 42).otherwise(F.col("id")).alias("a"), F.col("id").alias("b")
    )
    predicates = plan_key_predicates(df, ["a", "b"], 12)
    counts = df.agg(*[F.count_if(F.expr(p)).alias(f"c{i}") for i, p in enumerate(predicates)]).first()
    assert sum(counts) == 6000
    assert max(counts) <= 2 * 6000 / 12


def test_profile_rejects_null_keys(spark):
    df = spark.createDataFrame([(1, 1), (None, 2)], "a int, b int")
    with pytest.raises(ValueError, match="NULL"):
        profile_key(df, ["a"])
    with pytest.raises(ValueError, match="NULL"):
        profile_key(df, ["b", "a"])


def test_profile_rejects_text_keys(spark):
    df = spark.createDataFrame([("x",)], "a string")
    with pytest.raises(ValueError, match="integers"):
        profile_key(df, ["a"])
    with pytest.raises(ValueError, match="not in the table"):
        profile_key(df, ["nope"])


def test_profile_can_be_answered_from_footers(spark, table):
    settings = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        frame = profile_frame(table("lineitem"), ["l_orderkey", "l_linenumber"])
        assert "PushedAggregation: [COUNT(*), MIN(l_orderkey)" in frame._jdf.queryExecution().toString()
        assert frame.first()["n"] == 6000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
