"""Parquet sink and compaction."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from tablehaul.names import columns, unused
from tablehaul.plans.profile import profile_key
from tablehaul.sources.files import remove_dir, replace_dir
from tablehaul.sources.tables import plan_split, split_by_leaves

# Fixed value: rows per row group.
ROW_GROUP_ROWS = 1_000_000

# monotonically_increasing_id keeps a row's place in its partition below this bit.
PLACE_BITS = 33


def write_extract(
    df: DataFrame,
    path: str,
    compress: bool = False,
    rows_per_file: int | None = None,
    mode: str = "errorifexists",
    options: Mapping[str, str] | None = None,
) -> None:
    """Dictionary-encoded Parquet, uncompressed or Snappy, bounded row groups."""
    writer = (
        df.write.mode(mode)
        .option("compression", "snappy" if compress else "none")
        .option("parquet.enable.dictionary", "true")
        .option("parquet.block.row.count.limit", str(ROW_GROUP_ROWS))
    )
    for name, value in (options or {}).items():
        writer = writer.option(name, value)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", str(rows_per_file))
    writer.parquet(path)


def compact(
    spark: SparkSession,
    path_in: str,
    path_out: str,
    rows_per_file: int,
    keys: Sequence[str] = (),
    compress: bool = False,
) -> int:
    """Rewrite a folder as about ``rows / rows_per_file`` files, none above ``rows_per_file`` rows but for a few per cent with keys.

    The row count comes from file footers. Without keys rows keep their file order: they are counted per input
    partition and dealt out evenly by their number, so no file is left over. With keys the output is laid out again in
    key order. As with an extract, files go to a sibling folder, their footers must hold as many rows as the input,
    and the folder is then moved. Returns the number of files written.
    """
    df = spark.read.parquet(path_in)
    rows = df.count()
    files = max(1, -(-rows // rows_per_file))
    if keys:
        profile = profile_key(df, keys)
        laid = split_by_leaves(df, keys, plan_split(df, keys, files, profile), files, rows) if rows else df
    else:
        laid = _dealt_evenly(df, rows, files)
    folder, _, name = path_out.rstrip("/").rpartition("/")
    unfinished = f"{folder}/.{name}-{uuid.uuid4().hex}"
    try:
        write_extract(laid, unfinished, compress)
        back = spark.read.schema(df.schema).parquet(unfinished)
        if back.count() != rows:
            raise RuntimeError(f"{path_out}: {rows} rows in {path_in}, {back.count()} stored")
        written = back.select(F.col("_metadata.file_path")).distinct().count()
    except BaseException:
        remove_dir(spark, unfinished)
        raise
    replace_dir(spark, unfinished, path_out.rstrip("/"))
    return written


def _dealt_evenly(df: DataFrame, rows: int, files: int) -> DataFrame:
    """Rows numbered in scan order and dealt to ``files`` partitions of equal size."""
    part, place, before, of, target = unused(df.columns, "part", "place", "before", "of_part", "target")
    bits = (1 << PLACE_BITS) - 1
    counts = df.groupBy(F.spark_partition_id().alias(of)).agg(F.count(F.lit(1)).alias("n"))
    # one row per input partition
    earlier = F.sum("n").over(Window.orderBy(of).rowsBetween(Window.unboundedPreceding, -1))
    fits = F.when(F.col("n") < F.lit(1 << PLACE_BITS), F.coalesce(earlier, F.lit(0).cast("bigint"))).otherwise(
        F.raise_error(F.lit("too many rows in one partition"))
    )
    offsets = counts.select(of, fits.alias(before))
    placed = df.withColumns({part: F.spark_partition_id(), place: F.monotonically_increasing_id().bitwiseAND(F.lit(bits))})
    number = F.col(before) + F.col(place)
    dealt = F.call_function("div", number, F.lit(max(1, -(-rows // files))).cast("bigint")).cast("int")
    joined = placed.join(F.broadcast(offsets), F.col(part) == F.col(of)).withColumn(target, dealt)
    return joined.repartitionById(files, F.col(target)).select(*columns(df.columns))
