import pytest
from pyspark.sql import functions as F

from tablehaul.operators.paging import page, read_in_key_order, with_page_number, with_row_number
from tablehaul.plans.profile import column_stats
from tablehaul.sources.files import is_plain_scan, source_bytes
from tablehaul.sources.tables import default_partitions, read_all, read_by_key_range, register_source

LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def parts_of(df, key):
    return (
        df.groupBy(F.spark_partition_id().alias("p"))
        .agg(F.count("*").alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi"))
        .orderBy("p")
        .collect()
    )


def explained(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.mark.parametrize("n", [1, 2, 7, 8, 64])
def test_every_key_once_in_disjoint_partitions(table, n):
    orders = table("orders")
    ranged = read_by_key_range(orders, ["o_orderkey"], n)
    parts = parts_of(ranged, "o_orderkey")
    assert sum(p["n"] for p in parts) == orders.count() == ranged.select("o_orderkey").distinct().count()
    assert all(a["hi"] < b["lo"] for a, b in zip(parts, parts[1:]))
    assert max(p["n"] for p in parts) - min(p["n"] for p in parts) <= 1


def test_more_ranges_than_keys(table):
    region = read_by_key_range(table("region"), ["r_regionkey"], 8)
    assert sorted(r[0] for r in region.select("r_regionkey").collect()) == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("keys", [[7], [-5, -1, 0, 3, 9], [-(2**63), 0, 2**63 - 1]])
def test_edge_keys_each_once(keyed, keys):
    out = read_by_key_range(keyed(keys), ["k"], 4)
    assert sorted(r["k"] for r in out.collect()) == sorted(keys)


def test_rows_are_sorted_within_ranges(table):
    out = read_by_key_range(table("lineitem"), LINE_KEYS, 5).select(
        F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("m"), *LINE_KEYS
    )
    rows = [tuple(r[k] for k in LINE_KEYS) for r in out.orderBy("m").collect()]
    assert rows == sorted(rows)


def test_one_far_outlier_does_not_fill_a_single_task(keyed):
    df = keyed([*range(4000), 2**60])
    parts = parts_of(read_by_key_range(df, ["k"], 8, even_floor=100), "k")
    assert sum(p["n"] for p in parts) == 4001 and max(p["n"] for p in parts) < 1000
    assert all(a["hi"] < b["lo"] for a, b in zip(parts, parts[1:]))


def test_hot_leading_key_is_split_by_the_next(spark):
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("a"), F.col("id").alias("b")
    ).repartition(6)
    parts = parts_of(read_by_key_range(df, ["a", "b"], 12, even_floor=100), "a")
    assert sum(p["n"] for p in parts) == 6000 and max(p["n"] for p in parts) < 1000


def test_copies_of_one_full_key_are_split(spark):
    df = spark.range(0, 6000, 1, 12).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("a"))
    parts = parts_of(read_by_key_range(df, ["a"], 12, even_floor=100), "a")
    assert sum(p["n"] for p in parts) == 6000 and max(p["n"] for p in parts) < 1200


def test_even_keys_take_one_shuffle_without_sampling(table):
    plan = explained(read_by_key_range(table("orders"), ["o_orderkey"], 8))
    assert plan.count("Exchange") and "rangepartitioning" not in plan
    assert "shufflepartitionidpassthrough" in plan


def test_null_keys_fail_early(spark):
    df = spark.createDataFrame([(1,), (None,)], "k int")
    with pytest.raises(ValueError, match="NULL"):
        read_by_key_range(df, ["k"], 4)


def test_projection_and_filter_reach_the_scan(spark, table):
    plan = explained(read_all(spark, table("lineitem"), ["l_orderkey", "l_tax"]))
    assert "struct<l_orderkey:bigint,l_tax:double>" in plan
    register_source(spark, "orders_view", "/root/testdata/sf0.001/orders.parquet")
    out = spark.sql("SELECT o_custkey FROM orders_view WHERE o_orderkey BETWEEN 10 AND 19")
    assert out.count() == 10
    assert "GreaterThanOrEqual(o_orderkey,10)" in explained(out)
    with pytest.raises(ValueError):
        read_all(spark, table("orders"), ["nope"])


def numbers(df, keys):
    return [r["row_no"] for r in df.orderBy(*keys).collect()]


@pytest.mark.parametrize("floor", [0, 10**6])
@pytest.mark.parametrize("n", [1, 3, 8, 200])
def test_row_numbers_follow_the_key(table, n, floor):
    conversations = table("conversations")
    out = with_row_number(conversations, ["conv_id", "turn"], n, even_floor=floor)
    assert out.columns == [*conversations.columns, "row_no"]
    assert numbers(out, ["conv_id", "turn"]) == list(range(1, conversations.count() + 1))


def test_row_numbers_of_skewed_keys(spark):
    df = spark.range(3000).select((F.col("id") * F.col("id") * F.col("id")).alias("k"))
    assert numbers(with_row_number(df, ["k"], 8, even_floor=0), ["k"]) == list(range(1, 3001))


def test_row_numbers_of_an_empty_table(keyed):
    out = with_row_number(keyed([1]).where("false"), ["k"], 4)
    assert out.count() == 0 and out.columns == ["k", "row_no"]


def test_pages(keyed):
    pages = with_page_number(keyed(range(536)), ["k"], 100, 5).groupBy("page_no").count().orderBy("page_no").collect()
    assert [(p["page_no"], p["count"]) for p in pages] == [(i, 100) for i in range(5)] + [(5, 36)]
    with pytest.raises(ValueError):
        with_page_number(keyed([1]), ["k"], 0)


def test_page_slices_near_and_far(keyed):
    df = keyed(range(0, 40_000, 2))
    assert [r["k"] for r in page(df, ["k"], 101, 103).collect()] == [200, 202, 204]
    assert sorted(r["k"] for r in page(df, ["k"], 15_001, 15_003).collect()) == [30_000, 30_002, 30_004]
    assert page(df, ["k"], 30_000, 30_010).count() == 0
    with pytest.raises(ValueError):
        page(df, ["k"], 0, 5)


@pytest.mark.parametrize("first,last", [(1, 12_000), (9_999, 10_002), (20_000, 20_049), (29_990, 40_000), (5, 30_000)])
@pytest.mark.parametrize("shape", ["even", "cubes", "hot"])
def test_slices_of_any_size_and_key(spark, first, last, shape):
    i = F.col("id")
    lead = {"even": i * 3, "cubes": i * i * i, "hot": F.when(i > 12_000, 12_000).otherwise(i)}[shape]
    df = spark.range(30_000).select(lead.alias("a"), i.alias("b"))
    got = sorted(r["b"] for r in page(df, ["a", "b"], first, last).collect())
    assert got == list(range(first - 1, min(last, 30_000)))


def test_far_slices_read_only_their_ranges(table):
    plan = explained(page(table("lineitem").unionAll(table("lineitem")), ["l_orderkey"], 11_000, 11_001))
    assert "GreaterThanOrEqual(l_orderkey" in plan


def test_key_order_across_partitions(table):
    parts = parts_of(read_in_key_order(table("conversations"), ["conv_id", "turn"], 4), "conv_id")
    assert all(a["hi"] <= b["lo"] for a, b in zip(parts, parts[1:]))


def test_column_stats(spark):
    df = spark.createDataFrame([("ab", 1), ("abcd", None), (None, None)], "s string, n int")
    rows = {r["column_name"]: r for r in column_stats(df).collect()}
    assert rows["s"]["avg_length"] == 3.0 and rows["s"]["null_ratio"] == pytest.approx(1 / 3)
    assert rows["n"]["avg_length"] is None and rows["n"]["null_ratio"] == pytest.approx(2 / 3)
    assert {r["n"] for r in rows.values()} == {3}


def test_column_stats_with_odd_names_and_no_rows(spark):
    df = spark.createDataFrame([("x", 1)], "`it's` string, `a``b\\\\c` int")
    assert [r["column_name"] for r in column_stats(df).orderBy("position").collect()] == df.columns
    empty = column_stats(df.where("false")).collect()
    assert len(empty) == 2 and {(r["n"], r["null_ratio"]) for r in empty} == {(0, None)}


def test_odd_key_names(spark):
    df = spark.range(100).select(F.col("id").alias("a.b"), (F.col("id") % 3).alias("c`d"))
    for floor in (0, None):
        out = with_page_number(df, ["a.b", "c`d"], 10, 4, even_floor=floor)
        assert out.columns == ["a.b", "c`d", "page_no"]
        assert [r["count"] for r in out.groupBy("page_no").count().collect()] == [10] * 10
    from tablehaul.operators.reconcile import reconcile

    assert list(reconcile(df, df, ["a.b", "c`d"]).first()) == [100, 100, 0, 0, 0]


def test_wide_rows_are_checked_for_skew_earlier():
    from tablehaul.plans.strategy import partition_rows

    assert partition_rows(10**9, None) == 1_000_000
    assert partition_rows(600_000, 10**7) == 1_000_000
    assert partition_rows(1_000_000, 10**12) < 100


def test_page_checks_keys_at_every_position(spark, table):
    rows = spark.createDataFrame([(i if i else None, str(i)) for i in range(20)], "k int, t string")
    for first in (1, 15, 11_000):
        with pytest.raises(ValueError, match="integers"):
            page(rows, ["t"], first, first + 1)
        with pytest.raises(ValueError, match="NULL"):
            page(rows, ["k"], first, first + 1)


def test_partitions_of_a_join_follow_what_its_scans_read(table):
    lineitem, orders = table("lineitem"), table("orders")
    joined = lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey)
    assert source_bytes(joined) == source_bytes(lineitem) + source_bytes(orders)
    assert default_partitions(joined, 6000) <= 8


def test_plain_scans_are_told_by_their_plan(spark, table):
    orders = table("orders")
    assert is_plain_scan(orders) and is_plain_scan(orders.where("o_orderkey > 5").select(F.lit("Exchange").alias("Exchange")))
    for other in (orders.repartition(3), orders.distinct(), orders.union(orders), orders.orderBy("o_orderkey")):
        assert not is_plain_scan(other)


def test_whole_rows_are_read_once(spark, table):
    """A lopsided key: cuts come from the key columns alone, and no copy of the table is staged."""
    orders = table("orders").withColumn("sq", F.col("o_orderkey") * F.col("o_orderkey"))
    split = read_by_key_range(orders, ["sq"], 8, even_floor=0)
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and "rangepartitioning" not in plan
    sizes = [r["n"] for r in split.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 1500 and max(sizes) <= 2 * 1500 / 8
