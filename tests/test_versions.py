"""Ledgers: extracts that go on after a failure, and deltas."""

import os

import pytest
from pyspark.sql import functions as F

import tablehaul as th
from tablehaul.operators import versions


def rows(spark, n=8000):
    hot = F.when(F.col("id") % 3 == 0, F.lit(500)).otherwise(F.col("id"))
    return spark.range(0, n, 1, 6).select(hot.alias("a"), F.col("id").alias("b"), F.concat(F.lit("v"), "id").alias("v"), (F.col("id") % 5).cast("int").alias("w"))


def files(path):
    return {f for f in os.listdir(path) if f.endswith(".parquet")}


def same(a, b):
    return a.exceptAll(b).count() == 0 == b.exceptAll(a).count()


@pytest.mark.parametrize("waves", [1, 4])
def test_a_range_that_fails_is_all_that_is_read_again(spark, tmp_path, monkeypatch, waves):
    """The second run writes the open ranges only; each row is there once."""
    source, out = rows(spark), str(tmp_path)
    plain = versions.coerce_table
    dies = F.when(F.col("b") == 7999, F.raise_error(F.lit("lost")).cast("string")).otherwise(F.col("v"))

    def dies_when_written(df, *options):
        """Behind the shuffle, once the other ranges have had time to commit."""
        slow = F.pandas_udf(lambda v: (__import__("time").sleep(2 * int((v >= 7900).any())), v)[1], "bigint")
        return plain(df, *options) if df is source else plain(df, *options).withColumn("b", slow("b")).withColumn("v", dies)

    monkeypatch.setattr(versions, "coerce_table", dies_when_written)
    with pytest.raises(Exception, match="lost"):
        th.run_extract_resumable(source, "T", out, ["a", "b"], 12, waves)
    monkeypatch.undo()
    assert not os.path.exists(f"{out}/t.parquet")
    first = files(f"{out}/.t.parquet.open/data")
    assert first
    read = spark.sparkContext.accumulator(0)

    @F.pandas_udf("string")
    def seen(v):
        read.add(len(v))
        return v

    stats = th.run_extract_resumable(source.withColumn("v", seen("v")), "T", out, ["a", "b"], 12)
    entries = th.ledger(spark, stats.path).collect()
    kept = sum(r.rows for r in entries if set(r.files) & first)
    assert kept > 0 and read.value <= 8000 - kept + 8000 // 6 and stats.rows == 8000
    assert first <= files(stats.path) and sum(r.rows for r in entries) == 8000
    assert {f for r in entries for f in r.files} == files(stats.path)
    assert same(th.read_version(spark, stats.path), source) and same(spark.read.parquet(stats.path), source)
    assert not os.path.exists(f"{out}/.t.parquet.open")


def test_torn_ranges_are_written_again(spark, tmp_path, monkeypatch):
    """A range of several files of which one is missing counts as open."""
    source, out = rows(spark), str(tmp_path)
    monkeypatch.setattr(versions, "rows_per_file", lambda *a: 300)
    commit = versions._commit
    monkeypatch.setattr(versions, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
    with pytest.raises(RuntimeError, match="died"):
        th.run_extract_resumable(source, "T", out, ["a", "b"], 6)
    data = f"{out}/.t.parquet.open/data"
    torn = sorted(f for f in files(data) if "-c001" in f)[0]
    os.unlink(f"{data}/{torn}")
    before = files(data)
    monkeypatch.setattr(versions, "_commit", commit)
    stats = th.run_extract_resumable(source, "T", out, ["a", "b"], 6)
    gone = before - files(stats.path)
    assert len({f.split("-")[1] for f in gone}) <= 1 and same(th.read_version(spark, stats.path), source)


def test_another_source_starts_anew(spark, tmp_path):
    out = str(tmp_path)
    dies = rows(spark).withColumn("v", F.when(F.col("b") == 9, F.raise_error(F.lit("lost")).cast("string")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        th.run_extract_resumable(dies, "T", out, ["a", "b"], 4)
    stats = th.run_extract_resumable(rows(spark, 900), "T", out, ["a", "b"], 4)
    assert stats.rows == 900 and same(th.read_version(spark, stats.path), rows(spark, 900))
    assert th.run_extract_resumable(rows(spark, 0), "E", out, ["a"]).path is None


def test_delta_replaces_what_changed(spark, tmp_path):
    old = rows(spark)
    stats = th.run_extract_resumable(old, "T", str(tmp_path), ["a", "b"], 20)
    before = files(stats.path)
    assert th.extract_delta(old, stats.path, ["a", "b"]) == {"kept": len(before), "replaced": 0, "removed": 0, "added": 0}
    assert th.versions(spark, stats.path) == [1]
    b = F.col("b")
    new = old.filter(b != 1000).withColumn("w", F.when(b == 4001, F.lit(None).cast("int")).otherwise(F.col("w")))
    new = new.union(spark.createDataFrame([(500, -1, "x", 1), (-7, 3, "y", 2)], old.schema)).union(rows(spark, 9000).filter((b >= 8000) & (F.col("a") > 8000)))
    report = th.extract_delta(new, stats.path, ["a", "b"])
    assert 1 <= report["replaced"] <= 4 and report["kept"] >= 14 and report["removed"] == 0 and report["added"] >= 1
    assert same(th.read_version(spark, stats.path), new) and same(th.read_version(spark, stats.path, 1), old)
    assert before <= files(stats.path)
    live = {f for r in th.ledger(spark, stats.path).collect() for f in r.files}
    assert len(live & before) >= report["kept"]
    assert th.vacuum(spark, stats.path) == len(files(stats.path) | before) - len(live)
    assert files(stats.path) == live and same(spark.read.parquet(stats.path), new)
    # from one delta to the next
    last = new.filter((F.col("a") > 100) & (F.col("a") != 4000))
    report = th.extract_delta(last, stats.path, ["a", "b"])
    assert report["removed"] >= 0 and same(th.read_version(spark, stats.path), last)
    assert same(th.read_version(spark, stats.path), last) and th.versions(spark, stats.path) == [2, 3]


def test_delta_sees_swapped_nulls_and_other_columns(spark, tmp_path):
    old = spark.createDataFrame([(i, None, i) for i in range(50)], "k bigint, x bigint, y bigint")
    stats = th.run_extract_resumable(old, "T", str(tmp_path), ["k"], 3)
    swapped = old.select("k", F.col("y").alias("x"), F.col("x").alias("y"))
    assert th.extract_delta(swapped, stats.path, ["k"])["replaced"] == 3
    assert same(th.read_version(spark, stats.path), swapped)
    with pytest.raises(ValueError, match="other columns"):
        th.extract_delta(old.drop("y"), stats.path, ["k"])


def test_a_delta_that_dies_changes_nothing(spark, tmp_path):
    old = rows(spark, 3000)
    stats = th.run_extract_resumable(old, "T", str(tmp_path), ["a", "b"], 5)
    calls = spark.sparkContext.accumulator(0)

    @F.pandas_udf("int")
    def dies_late(w):
        calls.add(1)
        return w

    new = old.withColumn("w", F.when(F.col("b") == 5, F.col("w") + 1).otherwise(F.col("w")))
    broken = new.withColumn("w", dies_late("w"))
    monkey = versions.write_extract
    versions.write_extract = lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost"))
    try:
        with pytest.raises(RuntimeError, match="lost"):
            th.extract_delta(broken, stats.path, ["a", "b"])
    finally:
        versions.write_extract = monkey
    assert th.versions(spark, stats.path) == [1] and same(th.read_version(spark, stats.path), old)
    th.extract_delta(new, stats.path, ["a", "b"])
    assert same(th.read_version(spark, stats.path), new)


def test_entries_need_no_sort_of_the_rows(spark, tmp_path):
    """Highest keys and ranges of one key, from partial sums of the files."""
    rows = spark.range(0, 900, 1, 3).select((F.col("id") % 30).alias("a"), (-F.col("id")).alias("b")).union(spark.createDataFrame([(99, 1)] * 200, "a long, b long"))
    stats = th.run_extract_resumable(rows, "T", str(tmp_path), ["a", "b"], 5)
    known = th.ledger(spark, stats.path).collect()
    for r in known:
        keys = [tuple(k) for k in spark.read.parquet(*[f"{stats.path}/{f}" for f in r.files]).select("a", "b").collect()]
        assert tuple(r.hi_key) == max(keys) and r.rows == len(keys) and r.one_key == (len(set(keys)) == 1)
    assert any(r.one_key for r in known)
    plan = [(versions.Leaf(tuple(r.prefix), r.lo, r.hi, r.rows), i, 1) for i, r in enumerate(known)]
    entries = versions._entries(spark, stats.path, ["a", "b"], plan, {i: r.files for i, r in enumerate(known)})
    made = entries._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate(keys=[file_" in made and "SortAggregate(key=[file_" not in made
