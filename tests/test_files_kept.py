"""Page directories, checksum trees and compaction by sizes."""

import os

import pytest
from pyspark.sql import functions as F

import tablehaul as th
from tablehaul.sources import compaction
from tablehaul.sources.compaction import SourceFile, plan_bins


def rows(spark, n=6000):
    hot = F.when(F.col("id") % 3 == 0, F.lit(500)).otherwise(F.col("id"))
    return spark.range(0, n, 1, 6).select(hot.alias("a"), F.col("id").alias("b"), F.concat(F.lit("v"), "id").alias("file"), (F.col("id") % 5).alias("n"))


def files(path):
    return {f for f in os.listdir(path) if f.endswith(".parquet")}


def same(a, b):
    return a.exceptAll(b).count() == 0 == b.exceptAll(a).count()


@pytest.fixture(scope="module")
def extract(spark, tmp_path_factory):
    path = th.run_extract(rows(spark), "t", str(tmp_path_factory.mktemp("paged")), ["a", "b"], 12).path
    assert th.write_directory(spark, path, ["a", "b"], every=70) == 6000
    return path


@pytest.mark.parametrize(("first", "last"), [(1, 1), (1, 6000), (500, 501), (2990, 3400), (5999, 6000), (5990, 9000), (6001, 6002), (71, 71), (70, 140)])
def test_pages_come_from_their_files(spark, extract, first, last):
    found = th.page_from_directory(spark, extract, ["a", "b"], first, last)
    want = rows(spark).orderBy("a", "b").collect()[first - 1 : last]
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want))
    if want:
        read = {os.path.basename(f) for f in found.inputFiles()}
        holding = spark.read.parquet(extract).select("a", "b", F.input_file_name().alias("f"))
        keys = {(r.a, r.b) for r in want}
        assert read == {os.path.basename(r.f) for r in holding.collect() if (r.a, r.b) in keys}
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Aggregate" not in plan and "Sort" not in plan and "Exchange hash" not in plan


def test_directories_need_order(spark, tmp_path):
    path = str(tmp_path / "mixed")
    rows(spark).repartition(4).write.parquet(path)
    with pytest.raises(Exception, match="not in key order"):
        th.write_directory(spark, path, ["a", "b"])
    with pytest.raises(FileNotFoundError):
        th.page_from_directory(spark, path, ["a", "b"], 1, 2)
    empty = str(tmp_path / "empty")
    rows(spark, 0).write.parquet(empty)
    assert th.write_directory(spark, empty, ["a", "b"]) == 0
    assert th.page_from_directory(spark, empty, ["a", "b"], 1, 9).count() == 0


def test_directory_of_a_version(spark, tmp_path):
    path = th.run_extract_resumable(rows(spark), "T", str(tmp_path), ["a", "b"], 6).path
    new = rows(spark).filter(F.col("b") != 4000)
    th.extract_delta(new, path, ["a", "b"])
    assert th.write_directory(spark, path, ["a", "b"], 100) == 5999
    want = new.orderBy("a", "b").collect()[4000:4100]
    assert sorted(map(tuple, th.page_from_directory(spark, path, ["a", "b"], 4001, 4100).collect())) == sorted(map(tuple, want))


@pytest.mark.parametrize("leaf_rows", [40, 1000, 10**6])
def test_trees_lead_to_what_differs(spark, extract, leaf_rows):
    leaves = th.write_digests(spark, extract, ["a", "b"], leaf_rows)
    source = rows(spark)
    clean = th.reconcile_tree(source, extract, ["a", "b"]).first()
    assert tuple(clean) == (6000, 6000, 0, 0, 0, 0, 0)
    one = source.withColumn("n", F.when(F.col("b") == 3001, F.lit(None).cast("bigint")).otherwise(F.col("n")))
    found = th.reconcile_tree(one, extract, ["a", "b"]).first()
    assert tuple(found)[:6] == (6000, 6000, 0, 1, 1, 1) and found.keys_read <= 2 * 2.1 * max(6000 / leaves, 1)
    some = source.filter(F.col("b") != 77).union(source.filter(F.col("b") == 5000)).union(spark.createDataFrame([(-5, 1, "x", 1)], source.schema))
    found = th.reconcile_tree(some, extract, ["b", "a"][::-1]).first()
    assert tuple(found)[:5] == (6001, 6000, 0, 2, 1) and found.leaves_read <= 3
    assert th.reconcile_tree(source.limit(0), extract, ["a", "b"]).first().extra_rows == 6000
    with pytest.raises(ValueError, match="same columns"):
        th.reconcile_tree(source.drop("n"), extract, ["a", "b"])


def test_many_bad_leaves_are_compared_whole(spark, extract, monkeypatch):
    from tablehaul.operators import digests

    monkeypatch.setattr(digests, "MOST_LEAVES", 3)
    th.write_digests(spark, extract, ["a", "b"], 100)
    found = th.reconcile_tree(rows(spark).withColumn("n", F.col("n") + 1), extract, ["a", "b"]).first()
    assert (found.missing_rows, found.extra_rows) == (6000, 6000) and found.leaves_read > 50


def test_bins_are_full_and_leave_what_fits():
    made = [SourceFile(f"f{i:02d}", n, n) for i, n in enumerate([100, 60, 49, 30, 20, 1, 250, 50, 0, 45, 5])]
    bins = plan_bins(made, 100)
    assert [[f.rows for f in b] for b in bins] == [[49, 45, 5, 1, 0], [30, 20], [250]]
    ordered = plan_bins(made, 100, keep_order=True)
    assert [[f.name for f in b] for b in ordered] == [["f02", "f03", "f04", "f05"], ["f08", "f09", "f10"], ["f06"]]
    assert plan_bins([SourceFile("a", 7, 7)], 100) == []


@pytest.mark.parametrize("keep_order", [False, True])
def test_only_files_that_do_not_fit_are_written(spark, tmp_path, keep_order):
    path = str(tmp_path / "t")
    for lo, hi, per in ((0, 2000, 500), (2000, 2600, 90), (2600, 5100, 2500), (5100, 5101, 9), (5101, 5101, 9), (5101, 6000, 700)):
        th.write_extract(rows(spark).filter(F.col("b").between(lo, hi - 1)).coalesce(1), path, rows_per_file=per, mode="append")
    before = {f.name: f.rows for f in compaction.source_files(spark, path)}
    fits = {f for f, n in before.items() if 250 <= n <= 500}
    done = th.compact_in_place(spark, path, 500, keep_order)
    after = {f.name: f.rows for f in compaction.source_files(spark, path)}
    assert fits <= set(after) and max(after.values()) <= 500 and min(after.values()) > 0
    assert done.files_kept >= len(fits) and done.files_after == len(after) and done.files_before == len(before)
    assert done.rows_rewritten == sum(n for f, n in before.items() if f not in after) and done.bytes_rewritten > 0
    assert same(spark.read.parquet(path), rows(spark))
    again = th.compact_in_place(spark, path, 500, keep_order)
    assert again.rows_rewritten == 0 and again.files_kept == len(after)


def test_files_in_key_order_stay_so(spark, tmp_path):
    path = str(tmp_path / "t")
    for i, per in enumerate((500, 40, 500, 60, 900)):
        part = rows(spark).filter(F.col("b").between(1200 * i, 1200 * i + 1199)).coalesce(1).sortWithinPartitions("b")
        th.write_extract(part, f"{path}{i}", rows_per_file=per)
    from tablehaul.sources.files import move_parts

    first = 0
    os.mkdir(path)
    for i in range(5):
        first = move_parts(spark, f"{path}{i}", path, first)
    th.compact_in_place(spark, path, 500, keep_order=True)
    ordered = [[r.b for r in spark.read.parquet(f"{path}/{f}").select("b").collect()] for f in sorted(files(path))]
    assert [b for part in ordered for b in part] == list(range(6000))


@pytest.mark.parametrize("dies_at", [0, 3, 8])
def test_a_swap_that_dies_is_finished_by_the_next_call(spark, tmp_path, monkeypatch, dies_at):
    path = str(tmp_path / "t")
    th.write_extract(rows(spark).coalesce(1), path, rows_per_file=400)
    steps = [0]

    def dying(real):
        def step(*args):
            if steps[0] == dies_at:
                raise RuntimeError("died")
            steps[0] += 1
            return real(*args)

        return step

    real = compaction.remove_dir, compaction.move_file
    monkeypatch.setattr(compaction, "remove_dir", dying(real[0]))
    monkeypatch.setattr(compaction, "move_file", dying(real[1]))
    with pytest.raises(RuntimeError, match="died"):
        th.compact_in_place(spark, path, 150)
    monkeypatch.undo()
    th.compact_in_place(spark, path, 150)
    assert same(spark.read.parquet(path), rows(spark))
    assert max(f.rows for f in compaction.source_files(spark, path)) <= 150
    assert not [f for f in os.listdir(path) if f.startswith((".compaction", "_compaction"))]


def test_versions_are_left_alone(spark, tmp_path):
    path = th.run_extract_resumable(rows(spark), "T", str(tmp_path), ["a", "b"], 3).path
    with pytest.raises(ValueError, match="versions"):
        th.compact_in_place(spark, path, 10)
