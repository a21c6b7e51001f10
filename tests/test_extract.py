import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tablehaul.operators import extract as extract_module
from tablehaul.operators.extract import extract_stats, run_extract, run_extracts
from tablehaul.operators.reconcile import key_balance
from tablehaul.operators.reconcile import reconcile as plain_reconcile
from tablehaul.plans.catalog import mark_text_blobs
from tablehaul.plans.profile import profile_key
from tablehaul.sources import tables
from tablehaul.sources.parquet import compact, write_extract
from tablehaul.sources.tables import partitions_are_ranges, read_by_key_range


def part_files(path):
    return sorted(glob.glob(f"{path}/part-*"))


def same_rows(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_single_key_extract(spark, table, tmp_path):
    orders = table("orders")
    stats = run_extract(orders, "ORDERS", str(tmp_path), ["o_orderkey"], 8)
    assert stats.path == f"{tmp_path}/orders.parquet"
    assert (stats.strategy, stats.rows) == ("single_key", 1500)
    assert stats.megabytes > 0 and stats.rows_per_second > 0
    assert same_rows(spark.read.parquet(stats.path), orders)
    assert os.listdir(tmp_path) == ["orders.parquet"]
    bounds = []
    for f in part_files(stats.path):
        keys = pq.read_table(f, columns=["o_orderkey"])["o_orderkey"].to_pylist()
        assert keys == sorted(keys)
        bounds.append((keys[0], keys[-1]))
    assert len(bounds) == 8 and all(a[1] < b[0] for a, b in zip(bounds, bounds[1:]))


def test_more_ranges_than_keys(spark, table, tmp_path):
    assert run_extract(table("region"), "region", str(tmp_path), ["r_regionkey"], 8).rows == 5


def test_empty_table_leaves_no_file(table, tmp_path):
    stats = run_extract(table("orders").where("false"), "orders", str(tmp_path), ["o_orderkey"])
    assert (stats.strategy, stats.rows, stats.megabytes, stats.path) == ("empty", 0, 0.0, None)
    assert os.listdir(tmp_path) == []


def test_existing_extract_is_kept_unless_told(spark, table, tmp_path):
    run_extract(table("nation"), "nation", str(tmp_path), ["n_nationkey"])
    with pytest.raises(FileExistsError):
        run_extract(table("nation"), "nation", str(tmp_path), ["n_nationkey"])
    stats = run_extract(table("nation").where("n_nationkey < 5"), "nation", str(tmp_path), ["n_nationkey"], overwrite=True)
    assert spark.read.parquet(stats.path).count() == 5
    assert os.listdir(tmp_path) == ["nation.parquet"]


def test_failure_raises_and_keeps_the_old_extract(spark, table, tmp_path, monkeypatch):
    old = run_extract(table("nation"), "nation", str(tmp_path), ["n_nationkey"])

    def broken(df, *args):
        raise_it = F.raise_error(F.lit("bad row")).cast("string")
        return df.withColumn("n_name", F.when(F.col("n_nationkey") == 7, raise_it).otherwise(F.col("n_name")))

    monkeypatch.setattr(extract_module, "coerce_table", broken)
    with pytest.raises(Exception, match="bad row"):
        run_extract(table("nation"), "nation", str(tmp_path), ["n_nationkey"], overwrite=True)
    assert spark.read.parquet(old.path).count() == 25
    assert os.listdir(tmp_path) == ["nation.parquet"]


def test_lost_rows_are_noticed(table, tmp_path, monkeypatch):
    monkeypatch.setattr(extract_module, "coerce_table", lambda df, *a: df.where("n_nationkey <> 3"))
    with pytest.raises(RuntimeError, match="25 rows in source"):
        run_extract(table("nation"), "nation", str(tmp_path), ["n_nationkey"])
    assert not os.path.exists(f"{tmp_path}/nation.parquet")


def test_swapped_rows_are_noticed_by_key_check(table, tmp_path, monkeypatch):
    swap = F.when(F.col("n_nationkey") == 3, 4).otherwise(F.col("n_nationkey"))
    monkeypatch.setattr(extract_module, "coerce_table", lambda df, *a: df.withColumn("n_nationkey", swap))
    with pytest.raises(RuntimeError, match="differs"):
        run_extract(table("nation"), "nation", str(tmp_path), ["n_nationkey"], check_keys=True)


def test_strategies_and_overrides(table, tmp_path):
    keys = ["conv_id", "turn"]
    assert run_extract(table("conversations"), "a", str(tmp_path), keys, check_keys=True).strategy == "key_order"
    assert run_extract(table("conversations"), "b", str(tmp_path), keys, strategy="leading_key").strategy == "leading_key"
    assert run_extract(table("conversations"), "c", str(tmp_path), keys, strategy="unkeyed").strategy == "unkeyed"
    assert run_extract(table("labels"), "d", str(tmp_path)).strategy == "unkeyed"
    with pytest.raises(ValueError, match="needs a key"):
        run_extract(table("labels"), "e", str(tmp_path), strategy="single_key")


def test_single_file(table, tmp_path):
    stats = run_extract(table("orders"), "orders", str(tmp_path), ["o_orderkey"], 4, single_file=True)
    files = part_files(stats.path)
    assert len(files) == 1
    keys = pq.read_table(files[0], columns=["o_orderkey"])["o_orderkey"].to_pylist()
    assert keys == sorted(keys) and len(keys) == 1500


def test_text_blob_mark_reaches_the_extract(spark, table, tmp_path):
    documents = mark_text_blobs(table("documents"), ["text"])
    stats = run_extract(documents, "documents", str(tmp_path), ["doc_id"])
    assert spark.read.parquet(stats.path).schema["text"].metadata == {"is_text_blob": True}


def test_writer_settings(spark, tmp_path):
    df = spark.range(0, 2_500_000, 1, 1).select("id", (F.col("id") % 10).alias("d"))
    write_extract(df, f"{tmp_path}/plain")
    write_extract(df, f"{tmp_path}/snappy", compress=True, rows_per_file=1_000_000)
    meta = pq.ParquetFile(part_files(f"{tmp_path}/plain")[0]).metadata
    assert [meta.row_group(i).num_rows for i in range(meta.num_row_groups)] == [1_000_000, 1_000_000, 500_000]
    assert meta.row_group(0).column(1).compression == "UNCOMPRESSED"
    assert any("DICTIONARY" in e for e in meta.row_group(0).column(1).encodings)
    files = part_files(f"{tmp_path}/snappy")
    assert len(files) == 3
    assert pq.ParquetFile(files[0]).metadata.row_group(0).column(0).compression == "SNAPPY"


def test_compaction(spark, table, tmp_path):
    orders = table("orders")
    write_extract(orders.repartition(16), f"{tmp_path}/many")
    assert len(part_files(f"{tmp_path}/many")) == 16
    assert compact(spark, f"{tmp_path}/many", f"{tmp_path}/few", 750) == 2
    assert len(part_files(f"{tmp_path}/few")) == 2
    assert same_rows(spark.read.parquet(f"{tmp_path}/few"), orders)
    compact(spark, f"{tmp_path}/many", f"{tmp_path}/keyed", 500, ["o_orderkey"])
    bounds = []
    for f in part_files(f"{tmp_path}/keyed"):
        keys = pq.read_table(f, columns=["o_orderkey"])["o_orderkey"].to_pylist()
        bounds.append((min(keys), max(keys)))
    assert len(bounds) == 3 and all(a[1] < b[0] for a, b in zip(bounds, bounds[1:]))


def test_many_tables(spark, table, tmp_path):
    jobs = [
        (lambda name=name, key=key: run_extract(table(name), name, str(tmp_path), [key]))
        for name, key in [("region", "r_regionkey"), ("nation", "n_nationkey"), ("supplier", "s_suppkey")]
    ]
    rows = extract_stats(spark, run_extracts(jobs)).collect()
    assert [(r["table_name"], r["rows"]) for r in rows] == [("region", 5), ("nation", 25), ("supplier", 10)]


@pytest.mark.parametrize("screen", [False, True])
def test_reconcile_counts(spark, screen):
    def reconcile(*args):
        return plain_reconcile(*args, screen=screen)

    source = spark.range(100).withColumnRenamed("id", "k")
    extract = source.where("k not in (5, 6)").union(source.where("k in (1, 2, 3)"))
    report = reconcile(source, extract, ["k"]).first().asDict()
    assert report == {"source_rows": 100, "extracted_rows": 101, "duplicate_rows": 3, "missing_rows": 2, "extra_rows": 0}
    extra = reconcile(source, source.union(spark.createDataFrame([(500,), (500,), (None,)], "k bigint")), ["k"]).first()
    assert (extra["extra_rows"], extra["missing_rows"], extra["duplicate_rows"]) == (3, 0, 0)
    empty = source.where("false")
    assert list(reconcile(empty, empty, ["k"]).first()) == [0, 0, 0, 0, 0]
    assert key_balance(source, extract, ["k"]).where("in_source <> in_extract").count() == 5


def test_presorted_sources_are_not_shuffled(spark, table, tmp_path):
    orders, profile = table("orders"), profile_key(table("orders"), ["o_orderkey"])
    write_extract(read_by_key_range(orders, ["o_orderkey"], 4), f"{tmp_path}/sorted")
    write_extract(orders.repartition(4), f"{tmp_path}/mixed")
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(2**27))  # one file per partition
    try:
        ranged, mixed = spark.read.parquet(f"{tmp_path}/sorted"), spark.read.parquet(f"{tmp_path}/mixed")
        assert partitions_are_ranges(ranged, ["o_orderkey"], profile)
        assert not partitions_are_ranges(mixed, ["o_orderkey"], profile)
        assert not partitions_are_ranges(ranged.repartition(2), ["o_orderkey"], profile)
        for name, df in (("a", ranged), ("b", mixed)):
            stats = run_extract(df, name, str(tmp_path), ["o_orderkey"], 3, presorted=True, check_keys=True)
            assert len(part_files(stats.path)) == (4 if name == "a" else 3)
            assert same_rows(spark.read.parquet(stats.path), orders)
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)


def test_compaction_leaves_no_small_files(spark, tmp_path):
    """Eight files of 1,001 rows at 1,000 a file: nine even ones."""
    spark.range(8008).repartitionByRange(8, "id").write.parquet(f"{tmp_path}/in")
    assert compact(spark, f"{tmp_path}/in", f"{tmp_path}/out", 1000) == 9
    back = spark.read.parquet(f"{tmp_path}/out")
    files = back.groupBy(F.col("_metadata.file_path")).agg(F.count("*").alias("n")).collect()
    assert sorted(r.n for r in files) == [888] + [890] * 8 and back.distinct().count() == 8008
    spark.range(0).write.parquet(f"{tmp_path}/none")
    compact(spark, f"{tmp_path}/none", f"{tmp_path}/empty", 10)
    assert spark.read.schema("id bigint").parquet(f"{tmp_path}/empty").count() == 0


def test_empty_is_not_a_choice(spark, table, tmp_path):
    with pytest.raises(ValueError, match="unknown strategy"):
        run_extract(table("orders"), "ORDERS", str(tmp_path), ["o_orderkey"], strategy="empty")


@pytest.mark.parametrize("screen", [False, True])
def test_reconcile_sees_contents_if_asked(spark, table, screen):
    orders = table("orders").withColumnsRenamed({"o_orderkey": "s", "o_custkey": "e", "o_orderstatus": "bucket"})
    lost = orders.withColumn("o_totalprice", F.when(F.col("s") % 10 > 0, F.col("o_totalprice")))
    assert list(plain_reconcile(orders, lost, ["s", "e"], screen=screen).first()) == [1500, 1500, 0, 0, 0]
    assert list(plain_reconcile(orders, lost, ["s", "e"], screen=screen, content=True).first()) == [1500, 1500, 0, 150, 150]
    with pytest.raises(ValueError, match="same columns"):
        plain_reconcile(orders, orders.drop("o_totalprice"), ["s"], content=True)


def test_ranges_of_a_large_table_suit_a_task(spark, tmp_path, monkeypatch):
    """The number of ranges that the caller names is a least one."""
    monkeypatch.setattr(tables, "partition_rows", lambda rows, source_bytes: 100)
    df = spark.range(0, 1000, 1, 3).select(F.col("id").alias("k"))
    stats = run_extract(df, "T", str(tmp_path), ["k"], 2)
    sizes = [r["count"] for r in spark.read.parquet(stats.path).groupBy(F.col("_metadata.file_name")).count().collect()]
    assert stats.rows == sum(sizes) == 1000 and len(sizes) >= 10 and max(sizes) <= 100
