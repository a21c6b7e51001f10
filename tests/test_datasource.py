"""The key-range data source: partitions, filters, and folders that it refuses."""

import pytest
from pyspark.sql import functions as F

from tablehaul import run_extract
from tablehaul.sources.datasource import Group, plan_row_groups, register_key_ranges


@pytest.fixture(scope="module")
def extract(spark, tmp_path_factory):
    rows = spark.range(0, 8000, 1, 5).select((F.col("id") * 3).alias("k"), (F.col("id") % 7).alias("v"), F.concat(F.lit("t"), "id").alias("t"))
    register_key_ranges(spark)
    return run_extract(rows, "t", str(tmp_path_factory.mktemp("source")), ["k"], 16).path


def view(spark, path, **options):
    named = ", ".join(f"{k} '{v}'" for k, v in {"path": path, "key": "k", "ranges": 16, **options}.items())
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW ranged USING key_ranges OPTIONS ({named})")


@pytest.mark.parametrize(
    ("bounds", "condition", "partitions"),
    [
        ({}, "true", 16), ({"lower": 3003, "upper": 3003}, "k = 3003", 1), ({"lower": 12000}, "k >= 12000", 8), ({"upper": 2990}, "k <= 2990", 2),
        ({"lower": 5, "upper": 4}, "false", 1), ({"lower": 23998}, "false", 1), ({"lower": 1400, "upper": 3100}, "k BETWEEN 1400 AND 3100", 3),
    ],
)
def test_bounds_leave_matching_ranges(spark, extract, bounds, condition, partitions):
    view(spark, extract, **bounds)
    found = spark.sql("SELECT * FROM ranged")
    assert found.rdd.getNumPartitions() == partitions
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, spark.read.parquet(extract).where(condition).collect()))


def test_conditions_of_one_scan_do_not_reach_another(spark, extract):
    """They would if the source accepted pushed filters, which therefore it does not."""
    view(spark, extract)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        count = "SELECT count(*) AS n FROM ranged"
        assert spark.sql(f"{count} WHERE k < 300").first().n == 100
        assert spark.sql(count).first().n == 8000
        both = spark.sql(f"{count} WHERE k < 300 UNION ALL {count} UNION ALL {count} WHERE k BETWEEN 6 AND 11 AND v = 3")
        assert sorted(r.n for r in both.collect()) == [1, 100, 8000]
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_columns_and_joins(spark, extract):
    view(spark, extract, ranges=4)
    got = spark.sql("SELECT v, count(DISTINCT k) AS n FROM ranged JOIN (SELECT 9 AS k UNION ALL SELECT 12) USING (k) GROUP BY v ORDER BY v").collect()
    assert [tuple(r) for r in got] == [(3, 1), (4, 1)]


def test_folders_out_of_order_are_refused(spark, extract, tmp_path):
    path = str(tmp_path / "mixed")
    spark.read.parquet(extract).repartition(12).write.parquet(path)
    view(spark, path)
    with pytest.raises(Exception, match="not in order"):
        spark.sql("SELECT count(*) FROM ranged").collect()
    view(spark, path, rescan="true")
    assert spark.sql("SELECT count(*), count(DISTINCT k) FROM ranged").first() == (8000, 8000)


def test_null_keys_and_missing_options_are_refused(spark, tmp_path):
    path = str(tmp_path / "nulls")
    spark.createDataFrame([(None, 1), (2, 2)], "k bigint, v int").coalesce(1).write.parquet(path)
    view(spark, path)
    with pytest.raises(Exception, match="no NULL"):
        spark.sql("SELECT * FROM ranged").collect()
    with pytest.raises(Exception, match="needs the option"):
        spark.read.format("key_ranges").option("path", path).load().collect()


def test_plans_end_where_row_groups_end():
    groups = [Group(i, 0, 100, 10 * i, 10 * i + 9) for i in range(10)]
    plan = plan_row_groups(groups, 4)
    assert [hi for _, hi in plan] == [29, 49, 79, 2**63 - 1] and all(a[1] + 1 == b[0] for a, b in zip(plan, plan[1:], strict=False))
    assert plan_row_groups([Group(0, i, 5, 0, 9) for i in range(6)], 3) == [(-(2**63), 2**63 - 1)]
    assert plan_row_groups([], 3) == []
    assert len(plan_row_groups([*groups, Group(0, 1, 5000, 100, 200)], 4)) <= 4
