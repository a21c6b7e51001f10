"""Least unique column sets, exact key counts, sketches of columns."""

from collections import Counter
from itertools import combinations

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from pyspark.sql import functions as F

from conftest import SF_DIR
from tablehaul.plans import discovery
from tablehaul.plans.discovery import discover_keys, key_uniqueness
from tablehaul.plans.sketches import COUNT_ERROR, DISTINCT_ERROR, column_sketches, heavy_values, merge_sketches, read_sketches, sketch_columns


def brute_force(rows, names, most):
    found = []
    for size in range(1, most + 1):
        for s in combinations(range(len(names)), size):
            values = [tuple(r[i] for i in s) for r in rows]
            if any(None in v for v in values) or len(set(values)) < len(rows) or any(set(f) <= set(s) for f in found):
                continue
            found.append(s)
    return [[names[i] for i in s] for s in found] if len(rows) > 1 else []


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(*[st.one_of(st.integers(0, 4), st.integers(0, 4), st.none()) if i == 3 else st.integers(0, 4 + i) for i in range(5)]), max_size=14))
def test_least_sets(spark, rows):
    names = ["a", "b", "c", "d", "e"]
    df = spark.createDataFrame(rows, ", ".join(f"{n} bigint" for n in names))
    assert discover_keys(df, max_columns=4) == brute_force(rows, names, 4)


def test_lineitem_key_and_a_repeated_row(spark):
    """The declared key of four columns is unique, but not least: three of them are."""
    lines = spark.read.parquet(f"{SF_DIR.replace('0.001', '0.01')}/lineitem.parquet")
    names = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    rows = list(lines.select(*names).toPandas().itertuples(index=False, name=None))
    assert discover_keys(lines) == brute_force(rows, names, 4) == [names[:3]]
    assert key_uniqueness(lines, names).first()["n_repeated"] == 0
    assert discover_keys(lines.union(lines.limit(1))) == []


def test_names_types_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "x", 1), (2, "x", 1)], "`a.b` int, t string, c long")
    assert discover_keys(df) == [["a.b"]]
    assert discover_keys(df, ["t", "c"]) == []
    assert discover_keys(df.limit(0)) == []
    assert discover_keys(df.select("t")) == []
    with pytest.raises(ValueError):
        discover_keys(df, ["nope"])


def test_key_uniqueness(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 2), (None, 2)], "a int, b int")
    assert tuple(key_uniqueness(df, ["a", "b"]).first()) == (5, 3, 2, 2)
    assert tuple(key_uniqueness(df.limit(0), ["a"]).first()) == (0, 0, 0, 0)


def test_sketches_of_a_hot_value(spark):
    value = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 5 == 0, None).otherwise(F.col("id"))
    df = spark.range(0, 60_000, 1, 6).select(value.alias("v"), (F.col("id") % 10).cast("string").alias("id"), F.array("id").alias("many"))
    by_name = {r["column_name"]: r for r in column_sketches(df).collect()}
    v = by_name["v"]
    truth = Counter(7 if i % 3 == 0 else None if i % 5 == 0 else i for i in range(60_000))
    assert v["n_null"] == truth.pop(None)
    assert abs(v["n_distinct"] - len(truth)) <= DISTINCT_ERROR * len(truth)
    assert v["heavy"][0]["value"] == "7" and abs(v["heavy"][0]["n"] - truth[7]) <= v["count_error"] <= COUNT_ERROR * 60_000 + 1
    assert v["skewed"] and not v["dictionary"]
    assert by_name["id"]["dictionary"] and len(by_name["id"]["heavy"]) == 10 and by_name["many"]["n_distinct"] > 50_000
    assert [tuple(r) for r in heavy_values(df.select("v"), 0.02).collect()] == [(0, "v", "7", truth[7])]
    with pytest.raises(ValueError):
        heavy_values(df, COUNT_ERROR)


def test_sketches_merge(spark):
    df = spark.range(40_000).select((F.col("id") % 700).alias("v"), F.repeat(F.lit("long "), 40).alias("t"))
    parts = [sketch_columns(df.where(F.col("v") % 3 == i)) for i in range(3)]
    merged = read_sketches(merge_sketches(parts[0].union(parts[1]).union(parts[2])))
    got = {r["column_name"]: r for r in merged.collect()}
    assert got["v"]["n"] == 40_000 and abs(got["v"]["n_distinct"] - 700) <= 1 + DISTINCT_ERROR * 700
    assert got["t"]["n_distinct"] == 1 and got["t"]["heavy"][0]["value"].startswith("sha256:") and got["t"]["heavy"][0]["n"] == 40_000


def test_sketches_of_no_rows(spark):
    empty = spark.createDataFrame([], "a int, b string")
    assert [(r["n"], r["n_null"], r["n_distinct"], r["heavy"]) for r in column_sketches(empty).collect()] in ([], [(0, 0, 0, [])] * 2)
    assert heavy_values(empty).count() == 0


def test_near_keys_are_refuted_by_some_hashes(spark):
    rows = spark.range(0, 20_000, 1, 4).select((F.col("id") % 19_000).alias("c0"), F.col("id").alias("c1"), (F.col("id") % 7).alias("c2"))
    sets = [(0,), (1,), (0, 2), (1, 2)]
    assert discovery._repeated(rows, sets, discovery.SCREEN) == {0} and discovery._unique(rows, sets) == sets[1:]


def test_equal_hashes_are_no_equal_keys(spark, monkeypatch):
    """Sets whose hashes meet are decided by their values."""
    rows = spark.createDataFrame([(1, 1), (2, 1), (3, 2), (4, 2)], "c0 long, c1 long").repartition(2)
    monkeypatch.setattr(discovery.F, "xxhash64", lambda *_: F.lit(0).cast("bigint"))
    assert discovery._unique(rows, [(0,), (1,), (0, 1)]) == [(0,), (0, 1)]
