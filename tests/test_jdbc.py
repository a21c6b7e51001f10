"""The JDBC path without a database: reader calls are answered from a local table.

The stand-in evaluates the very predicates that a source would receive.
"""

import re

import pytest
from pyspark.sql import DataFrameReader, functions as F

from tablehaul.operators.extract import extract_table_jdbc, run_extract_jdbc
from tablehaul.plans.catalog import describe_tables
from tablehaul.plans.ranges import plan_ranges
from tablehaul.sources import jdbc


class Calls(list):
    pass


@pytest.fixture()
def source(spark, monkeypatch):
    calls = Calls()
    calls.df = None

    def fake_jdbc(self, url, table, predicates=None, properties=None, **_):
        calls.append({"table": table, "predicates": predicates, "properties": properties})
        if not predicates:
            return calls.df
        spark_predicates = [re.sub(r'"([^"]+)"', r"`\1`", p) for p in predicates]
        parts = [calls.df.where(F.expr(p)) for p in spark_predicates]
        out = parts[0]
        for p in parts[1:]:
            out = out.union(p)
        return out

    def fake_profile(spark, url, table, key=None, properties=None, quote='"'):
        row = calls.df.agg(F.count("*"), *([F.min(key), F.max(key)] if key else [])).first()
        return jdbc.KeyProfile(row[0], *(row[1:] if key else (None, None)), 0)

    monkeypatch.setattr(DataFrameReader, "jdbc", fake_jdbc)
    monkeypatch.setattr("tablehaul.operators.extract.profile_jdbc", fake_profile)
    monkeypatch.setattr("tablehaul.sources.jdbc.profile_jdbc", fake_profile)
    yield calls
    spark.conf.unset("spark.sql.unionOutputPartitioning")


def test_profile_statement_is_one_aggregate_with_quoted_names():
    assert jdbc.profile_query('OD"D', "K") == (
        'SELECT COUNT(*) AS n, MIN("K") AS lo, MAX("K") AS hi, COUNT("K") AS keyed FROM "OD""D"'
    )
    assert jdbc.table_name(("S", "T")) == '"S"."T"'
    assert jdbc.profile_query("T", None) == 'SELECT COUNT(*) AS n FROM "T"'


def test_catalog_needs_all_queries(spark):
    with pytest.raises(ValueError, match="index_segments"):
        jdbc.read_catalog(spark, "jdbc:x", {n: "SELECT 1" for n in ("relation_fields", "fields", "indices", "relation_constraints")})


def test_one_predicate_per_connection(spark, table, source):
    source.df = table("orders")
    profile = jdbc.KeyProfile(1500, 0, 1499, 0)
    out = jdbc.read_jdbc_by_key_range(spark, "jdbc:x", "ORDERS", ["o_orderkey"], profile, n=4)
    assert source[0]["table"] == '"ORDERS"'
    assert source[0]["predicates"] == [
        '"o_orderkey" <= 374',
        '"o_orderkey" >= 375 AND "o_orderkey" <= 749',
        '"o_orderkey" >= 750 AND "o_orderkey" <= 1124',
        '"o_orderkey" >= 1125',
    ]
    assert source[0]["properties"]["fetchsize"] == "10000"
    assert out.count() == out.select("o_orderkey").distinct().count() == 1500


def test_own_ranges_and_unknown_keys(spark, table, source):
    source.df = table("orders")
    profile = jdbc.KeyProfile(1500, 0, 1499, 0)
    ranges = plan_ranges(0, 1499, 2)
    jdbc.read_jdbc_by_key_range(spark, "jdbc:x", "ORDERS", ["o_orderkey"], profile, ranges)
    assert len(source[0]["predicates"]) == 2
    with pytest.raises(ValueError, match="not in the table"):
        jdbc.read_jdbc_by_key_range(spark, "jdbc:x", "ORDERS", ["nope"], profile, predicates=["1 = 1"])


@pytest.mark.parametrize("balanced", [False, True])
def test_jdbc_extract_is_exact(spark, table, source, tmp_path, balanced):
    lineitem = table("lineitem")
    hot = F.when(F.col("l_returnflag") == "A", 0).otherwise(F.col("l_orderkey"))
    source.df = lineitem.withColumn("l_orderkey", hot.cast("bigint"))
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    stats = run_extract_jdbc(spark, "jdbc:x", "LINEITEM", str(tmp_path), keys, 12, balanced=balanced)
    assert (stats.strategy, stats.rows) == ("key_order", lineitem.count())
    back = spark.read.parquet(stats.path)
    want = source.df.withColumn("l_linenumber", F.col("l_linenumber").cast("bigint"))
    assert back.exceptAll(want).isEmpty() and want.exceptAll(back).isEmpty()
    if balanced:
        assert any("l_linenumber" in p for call in source for p in call["predicates"] or [])


def test_jdbc_without_key_and_empty(spark, table, source, tmp_path):
    source.df = table("labels")
    assert run_extract_jdbc(spark, "jdbc:x", "LABELS", str(tmp_path)).strategy == "unkeyed"
    assert source[0]["predicates"] is None
    source.df = table("labels").where("false")
    assert run_extract_jdbc(spark, "jdbc:x", "NONE", str(tmp_path), ["doc_id"]).strategy == "empty"


def test_fractional_key_is_refused(spark, source, tmp_path):
    source.df = spark.range(4000).select((F.col("id") / 3).cast("decimal(12,3)").alias("K"), F.col("id"))
    with pytest.raises(ValueError, match="integers"):
        run_extract_jdbc(spark, "jdbc:x", "T", str(tmp_path), ["K"], 8)
    whole = source.df.withColumn("K", F.col("id").cast("decimal(12,0)"))
    source.df = whole
    assert run_extract_jdbc(spark, "jdbc:x", "T", str(tmp_path), ["K"], 8).rows == 4000


def test_source_that_changes_is_noticed(spark, table, source, tmp_path, monkeypatch):
    source.df = table("orders")
    monkeypatch.setattr("tablehaul.operators.extract.count_jdbc", lambda *a: 1501)
    with pytest.raises(RuntimeError, match="1501 after"):
        run_extract_jdbc(spark, "jdbc:x", "ORDERS", str(tmp_path), ["o_orderkey"], 4)
    assert not list(tmp_path.glob("orders.parquet"))
    assert run_extract_jdbc(spark, "jdbc:x", "ORDERS", str(tmp_path), ["o_orderkey"], 4, quiet_source=False).rows == 1500


def test_open_connections_are_limited(spark, table, source, tmp_path):
    source.df = table("orders").coalesce(1)
    # else the stand-in's union of one-partition frames is one partition
    spark.conf.set("spark.sql.unionOutputPartitioning", "false")
    stats = run_extract_jdbc(spark, "jdbc:x", "ORDERS", str(tmp_path), ["o_orderkey"], 40, connections=3)
    waves = [call["predicates"] for call in source if call["predicates"]][-14:]
    assert sum(map(len, waves)) == len({p for w in waves for p in w}) == 40 and max(map(len, waves)) == 3
    files = sorted(f.name for f in (tmp_path / "orders.parquet").glob("part-*"))
    assert len(files) == 40 and stats.rows == 1500
    # names follow key order
    tops = [spark.read.parquet(str(tmp_path / "orders.parquet" / f)).agg(F.max("o_orderkey")).first()[0] for f in files]
    assert tops == sorted(tops)


def test_a_sort_and_a_retry_hold_one_range(spark, table, source, tmp_path, monkeypatch):
    """64 ranges in waves of 8: each task that is written has the rows of one range only."""
    from tablehaul.operators import extract

    source.df = table("orders").coalesce(1)
    spark.conf.set("spark.sql.unionOutputPartitioning", "false")
    written, write = [], extract.write_extract
    monkeypatch.setattr(extract, "write_extract", lambda df, *a: written.append(df) or write(df, *a))
    run_extract_jdbc(spark, "jdbc:x", "ORDERS", str(tmp_path), ["o_orderkey"], 64, balanced=False)
    assert len(written) == 8
    for df in written:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
        sizes = df.groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) == 8 and max(r["count"] for r in sizes) <= 1500 // 64 + 1


def test_lopsided_key_is_cut_by_rows_unasked(spark, table, source, tmp_path):
    orders = table("orders")
    source.df = orders.withColumn("o_orderkey", F.when(F.col("o_orderkey") == 7, 10**15).otherwise(F.col("o_orderkey")))
    run_extract_jdbc(spark, "jdbc:x", "ORDERS", str(tmp_path), ["o_orderkey"], 10)
    predicates = [p for call in source if call["predicates"] for p in call["predicates"]][-10:]
    counts = [source.df.where(p.replace('"', "`")).count() for p in predicates]
    assert sum(counts) == 1500 and max(counts) <= 300


def test_predicates_of_an_unkeyed_table(spark, table, source, tmp_path):
    source.df = table("labels")
    stats = run_extract_jdbc(spark, "jdbc:x", "LABELS", str(tmp_path), predicates=['"doc_id" < 50', '"doc_id" >= 50'])
    assert len(source[-1]["predicates"]) == 2 and stats.rows == source.df.count()


def test_from_a_name_to_an_extract(spark, table, source, tmp_path):
    source.df = table("conversations")
    catalog = describe_tables(spark, {"CONVERSATIONS": source.df}, {"CONVERSATIONS": ["conv_id", "turn"]}, {("CONVERSATIONS", "text")})
    stats = extract_table_jdbc(spark, "jdbc:x", "conversations", str(tmp_path), catalog)
    assert (stats.strategy, stats.rows) == ("key_order", source.df.count()) and source[-1]["table"] == '"CONVERSATIONS"'
    with pytest.raises(ValueError, match="no table"):
        extract_table_jdbc(spark, "jdbc:x", "conversation", str(tmp_path), catalog)
