"""Row and page numbers in key order without a single-task sort."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from tablehaul.names import column, columns, unused
from tablehaul.plans.balance import with_leaf_number
from tablehaul.plans.profile import KeyProfile, check_keys, profile_key
from tablehaul.plans.ranges import range_counts
from tablehaul.sources.parquet import PLACE_BITS
from tablehaul.sources.tables import (
    default_partitions,
    plan_split,
    ranges_are_even,
    read_by_key_range,
    split_by_plan,
)

# Up to this many leading rows a top-k is cheaper than numbering the table.
TOP_ROWS = 10_000

# Key ranges counted to find a slice; with more rows each range only gets larger.
MAX_COUNTED = 100_000


def with_row_number(
    df: DataFrame,
    keys: Sequence[str],
    n: int | None = None,
    profile: KeyProfile | None = None,
    even_floor: int | None = None,
) -> DataFrame:
    """``df`` plus ``row_no``, 1-based over the whole table in order of unique ``keys``.

    A row's number is its place in its sorted partition plus the rows of all
    earlier partitions. The partition is a function of the key, of its
    equal-width range or of a plan over all key columns whose parts are counted as it is made, so counting (key columns only)
    and numbering agree without anything being materialised.
    """
    check_keys(df, keys)
    if "row_no" in {c.lower() for c in df.columns}:
        raise ValueError("the table has a column row_no; rename it first")
    profile = profile or profile_key(df, keys)
    if profile.rows == 0:
        return df.withColumn("row_no", F.lit(0).cast("bigint"))
    n = n or default_partitions(df, profile.rows)
    if ranges_are_even(df, keys[0], n, profile, even_floor):
        split = split_by_plan(df, keys, n, profile)
        counts = range_counts(df, keys[0], n, profile).select("range_id", "n_rows")
    else:
        leaves = plan_split(df, keys, n, profile)
        (number,) = unused(df.columns, "leaf")
        placed = with_leaf_number(df, leaves, keys, number)
        split = placed.repartitionById(len(leaves), F.col(number)).drop(number).sortWithinPartitions(*columns(keys))
        counts = df.sparkSession.createDataFrame([(i, leaf.rows) for i, leaf in enumerate(leaves)], "range_id bigint, n_rows bigint")
    part, place, before, of = unused(df.columns, "part", "place", "before", "of_part")
    placed = split.withColumns({
        part: F.spark_partition_id().cast("bigint"),
        place: F.monotonically_increasing_id().bitwiseAND(F.lit((1 << PLACE_BITS) - 1)),
    })
    # one row per partition; its size is checked, as a place has PLACE_BITS bits
    earlier = F.sum("n_rows").over(Window.orderBy("range_id").rowsBetween(Window.unboundedPreceding, -1))
    fits = F.when(F.col("n_rows") < F.lit(1 << PLACE_BITS), F.coalesce(earlier, F.lit(0).cast("bigint"))).otherwise(
        F.raise_error(F.lit("too many rows in one partition"))
    )
    offsets = counts.select(F.col("range_id").alias(of), fits.alias(before))
    joined = placed.join(F.broadcast(offsets), F.col(part) == F.col(of))
    return joined.select(*columns(df.columns), (F.col(before) + F.col(place) + F.lit(1)).alias("row_no"))


def with_page_number(
    df: DataFrame,
    keys: Sequence[str],
    page_rows: int,
    n: int | None = None,
    profile: KeyProfile | None = None,
    even_floor: int | None = None,
) -> DataFrame:
    """``df`` plus ``page_no``: page *i* holds rows ``i*page_rows+1 .. (i+1)*page_rows``."""
    if page_rows < 1:
        raise ValueError("a page needs at least one row")
    if "page_no" in {c.lower() for c in df.columns}:
        raise ValueError("the table has a column page_no; rename it first")
    # a column row_no of the table itself steps aside
    given = df.columns
    aside = {c: name for c, name in zip(given, unused(given, *[f"own_{c}" for c in given]), strict=True) if c.lower() == "row_no"}
    keys = [aside.get(k, k) for k in keys]
    numbered = with_row_number(df.withColumnsRenamed(aside), keys, n, profile, even_floor)
    page = F.call_function("div", F.col("row_no") - F.lit(1), F.lit(page_rows).cast("bigint"))
    paged = numbered.withColumn("page_no", page).drop("row_no")
    return paged.withColumnsRenamed({name: c for c, name in aside.items()})


def read_in_key_order(
    df: DataFrame, keys: Sequence[str], n: int | None = None, page_rows: int | None = None
) -> DataFrame:
    """Whole table in key order across partitions; with ``page_rows``, pages numbered."""
    if page_rows is not None:
        return with_page_number(df, keys, page_rows, n)
    return read_by_key_range(df, keys, n)


def page(df: DataFrame, keys: Sequence[str], first: int, last: int) -> DataFrame:
    """Rows ``first .. last`` (1-based, inclusive) of the table in key order.

    Keys are integers without NULLs, wherever the slice lies. Near the start this is a top-k. Further in, rows are
    counted per key range first, from the key column alone; then only the ranges that hold the slice are
    read, through a key filter that reaches the scan.
    """
    if not 1 <= first <= last:
        raise ValueError(f"not a row interval: {first}..{last}")
    by = columns(keys)
    profile = profile_key(df, keys)
    if first > profile.rows:
        return df.limit(0)
    if last <= TOP_ROWS:
        return df.orderBy(*by).offset(first - 1).limit(last - first + 1)
    n = min(-(-profile.rows // TOP_ROWS), MAX_COUNTED)
    # one row per range
    counts = range_counts(df, keys[0], n, profile).orderBy("range_id").collect()
    ends = list(accumulate(r["n_rows"] for r in counts))
    start = bisect_left(ends, first)
    stop = bisect_left(ends, min(last, profile.rows))
    before = ends[start] - counts[start]["n_rows"]
    part = df.where(column(keys[0]).between(counts[start]["lo"], counts[stop]["hi"]))
    if last - before <= TOP_ROWS:
        return part.orderBy(*by).offset(first - 1 - before).limit(last - first + 1)
    numbered = with_row_number(part, keys)
    return numbered.where(F.col("row_no").between(first - before, last - before)).drop("row_no")
