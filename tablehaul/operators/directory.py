"""Paging of a finished extract: a sparse directory from row numbers to files and keys.

``<extract>/_directory`` has one row for every n-th row of each file in key order: its number over the whole table, file, place in the file
and key. It is written once, from footers and key columns; a page then reads the directory's few rows around it and the
files that hold it, without counting or sorting.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from tablehaul.names import columns, unused
from tablehaul.operators.versions import read_version, versions
from tablehaul.plans.profile import check_keys
from tablehaul.sources.files import exists, replace_dir

DIRECTORY = "_directory"
EVERY = 10_000


def _current(spark: SparkSession, path: str) -> DataFrame:
    return read_version(spark, path) if versions(spark, path) else spark.read.parquet(path)


def write_directory(spark: SparkSession, path: str, keys: Sequence[str], every: int = EVERY) -> int:
    """Write the directory of an extract whose files are disjoint key ranges, sorted by ``keys``; returns the table's rows.

    Files that overlap or are not in order are an error. Bounded: one row per file reaches a broadcast and one window; the order of
    marks is checked file by file.
    """
    if every < 1:
        raise ValueError("a directory needs a distance between its rows")
    data = _current(spark, path)
    check_keys(data, keys)
    file, place, key = unused(data.columns, "file", "place", "key")
    key_list = F.array(*[c.cast("bigint") for c in columns(keys)])
    counts = data.groupBy(F.col("_metadata.file_name").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    rows = data.select(key_list.alias(key), F.col("_metadata.file_name").alias(file), F.col("_metadata.row_index").alias(place))
    marked = rows.join(F.broadcast(counts), F.col(file) == F.col("name"))
    marks = marked.filter((F.col(place) % every == 0) | (F.col(place) == F.col("n") - 1))
    marks = marks.select(F.col("name").alias("file"), F.col(place).alias("place"), F.col(key).alias("key"), "n")
    in_file = Window.partitionBy("file").orderBy("place")
    marks = marks.withColumn("falls", F.coalesce(F.lag("key").over(in_file) > F.col("key"), F.lit(False)))
    # one row per file
    ends = marks.groupBy("file").agg(F.first("n").alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi"), F.bool_or("falls").alias("falls"))
    earlier = Window.orderBy("lo").rowsBetween(Window.unboundedPreceding, -1)
    files = ends.select(
        "file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        F.assert_true(~F.col("falls") & F.coalesce(F.max("hi").over(earlier) <= F.col("lo"), F.lit(True)), F.lit("files are not in key order")).alias("ok"),
    )
    numbered = marks.select("file", "place", "key").join(F.broadcast(files), "file").filter("ok IS NULL").select(
        (F.col("before") + F.col("place") + 1).cast("bigint").alias("row_no"), "file", "place", "key", F.lit(every).alias("every")
    )
    unfinished = f"{path}/.{uuid.uuid4().hex}"
    numbered.sort("row_no").write.parquet(unfinished)
    replace_dir(spark, unfinished, f"{path}/{DIRECTORY}")
    return spark.read.parquet(f"{path}/{DIRECTORY}").agg(F.max("row_no")).first()[0] or 0


def page_from_directory(spark: SparkSession, path: str, keys: Sequence[str], first: int, last: int) -> DataFrame:
    """Rows ``first .. last`` (1-based, inclusive) in key order, from the files that hold them.

    The directory must be of the extract as it is: write it again after a delta or a compaction.
    """
    if not 1 <= first <= last:
        raise ValueError(f"not a row interval: {first}..{last}")
    if not exists(spark, f"{path}/{DIRECTORY}"):
        raise FileNotFoundError(f"{path} has no directory; write_directory makes one")
    directory = spark.read.parquet(f"{path}/{DIRECTORY}")
    some = directory.select("every").first()
    nothing = _current(spark, path).limit(0)
    if some is None:
        return nothing
    # every n-th row of a file is a mark, its first and last row too: those around the slice lie within n rows
    around = directory.filter(F.col("row_no").between(first - some.every, last + some.every))
    marks = around.orderBy("row_no").collect()
    below = [m for m in marks if m.row_no <= first]
    if not below or marks[-1].row_no < first:
        return nothing
    inside = [below[-1], *[m for m in marks if first < m.row_no <= last]]
    after = [m for m in marks if m.row_no >= last]
    offsets = {m.file: m.row_no - m.place for m in inside}
    data = spark.read.parquet(*[f"{path}/{f}" for f in offsets])
    key = columns(keys[:1])[0]
    bounds = key >= inside[0].key[0]
    if after:
        bounds = bounds & (key <= after[0].key[0])
    offset, number = unused(data.columns, "offset", "number")
    # one row per file of the slice
    of = F.broadcast(spark.createDataFrame(list(offsets.items()), f"of_file string, {offset} bigint"))
    placed = data.filter(bounds).withColumn(number, F.col("_metadata.row_index")).withColumn("of_", F.col("_metadata.file_name"))
    found = placed.join(of, F.col("of_") == F.col("of_file")).filter((F.col(number) + F.col(offset)).between(first, last))
    return found.select(*columns(data.columns))
