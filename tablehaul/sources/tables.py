"""Table scans: whole, by key range, in key order, and as a SQL name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from tablehaul import names
from tablehaul.plans.balance import Leaf, plan_leaves, with_leaf_number
from tablehaul.plans.profile import KeyProfile, check_keys, profile_key
from tablehaul.plans.ranges import heaviest_range, range_id
from tablehaul.plans.strategy import partition_rows, partitions_for
from tablehaul.sources.files import is_plain_scan, source_bytes


def read_all(
    spark: SparkSession,
    source: str | DataFrame,
    columns: Sequence[str] | None = None,
    source_format: str = "parquet",
) -> DataFrame:
    """One scan, no order; parallel by file splits. ``columns`` prunes the scan."""
    df = source if isinstance(source, DataFrame) else spark.read.format(source_format).load(source)
    if columns is None:
        return df
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns not in the table: {missing}")
    return df.select(*names.columns(columns))


def ranges_are_even(
    df: DataFrame, key: str, n: int, profile: KeyProfile, floor: int | None = None
) -> bool:
    """Whether no equal-width range holds more than twice its share of the rows.

    Ranges of up to ``floor`` rows, by default what suits one task, are never too
    large, so small tables are not counted.
    """
    if floor is None:
        floor = partition_rows(profile.rows, source_bytes(df))
    if profile.rows <= floor:
        return True
    allowed = max(2 * profile.rows // min(n, profile.span), floor)
    return heaviest_range(df, key, n, profile) <= allowed


def default_partitions(df: DataFrame, rows: int, has_text_blob: bool = False) -> int:
    cores = df.sparkSession.sparkContext.defaultParallelism
    return partitions_for(rows, source_bytes(df), has_text_blob, cores)


def enough_partitions(df: DataFrame, n: int, rows: int) -> int:
    """``n``, or as many as it takes for each to suit one task, which sorts it."""
    return max(n, -(-rows // partition_rows(rows, source_bytes(df))))


def split_by_plan(df: DataFrame, keys: Sequence[str], n: int, profile: KeyProfile) -> DataFrame:
    """Partition *i* holds equal-width range *i* of the leading key, sorted by all keys."""
    ids = range_id(names.column(keys[0]), profile.lo, profile.hi, n)
    return df.repartitionById(min(n, profile.span), ids).sortWithinPartitions(*names.columns(keys))


def split_by_leaves(df: DataFrame, keys: Sequence[str], leaves: Sequence[Leaf], n: int, rows: int) -> DataFrame:
    """Partition *i* holds leaf *i* of a plan over all key columns, sorted by them.

    The place of a row is a function of its key, so passes agree with each other. Only copies of one full key that hold
    several shares are dealt over more partitions, by their place in the input, which is the same when a lost task runs again.
    """
    by, parts = names.columns(keys), len(leaves)
    (number,) = names.unused(df.columns, "leaf")
    df = with_leaf_number(df, leaves, keys, number)
    place = F.col(number)
    share = max(2 * rows // n, 1)
    copied = [(i, -(-leaf.rows // share)) for i, leaf in enumerate(leaves) if leaf.one_key and leaf.rows > share]
    if copied:
        before = 0
        shifted = F.lit(None).cast("int")
        for i, extra in copied:
            inside = F.pmod(F.monotonically_increasing_id(), F.lit(extra)).cast("int")
            shifted = F.when(place == i, F.lit(i + before) + inside).otherwise(shifted)
            before += extra - 1
        earlier = sum((F.when(place > i, extra - 1).otherwise(0) for i, extra in copied), F.lit(0))
        df, parts = df.withColumn(number, F.coalesce(shifted, place + earlier)), parts + before
    return df.repartitionById(parts, F.col(number)).drop(number).sortWithinPartitions(*by)


def plan_split(df: DataFrame, keys: Sequence[str], n: int, profile: KeyProfile) -> list[Leaf]:
    """A plan of about ``n`` equal parts; reads the key columns only, twice."""
    return plan_leaves(df, keys, n, profile.lo, profile.hi, profile.rows)


def read_by_key_range(
    df: DataFrame,
    keys: Sequence[str],
    n: int | None = None,
    profile: KeyProfile | None = None,
    even_floor: int | None = None,
) -> DataFrame:
    """Rows in up to ``n`` disjoint key ranges, one partition each, sorted by all keys.

    Partitions follow key order, so part files do too. Equal-width ranges of the
    leading key place rows by arithmetic; where they are lopsided (gaps, outliers, a
    hot leading key) the cuts are taken from a summary of the key columns. Either way whole rows are
    read once.
    Without ``n``, partitions are sized by the table's rows and bytes.
    """
    check_keys(df, keys)
    profile = profile or profile_key(df, keys)
    if profile.rows == 0:
        return df
    n = n or default_partitions(df, profile.rows)
    if ranges_are_even(df, keys[0], n, profile, even_floor):
        return split_by_plan(df, keys, n, profile)
    return split_by_leaves(df, keys, plan_split(df, keys, n, profile), n, profile.rows)


def partitions_are_ranges(df: DataFrame, keys: Sequence[str], profile: KeyProfile) -> bool:
    """Whether each input partition holds its own interval of the leading key, none too much of it.

    Reads that column and compares one row per input partition. Partitions of a
    file scan are the same in every pass; behind a shuffle they need not be, so only
    a plain scan counts.
    """
    if not is_plain_scan(df):
        return False
    key = names.column(keys[0])
    bounds = df.groupBy(F.spark_partition_id().alias("part")).agg(
        F.min(key).alias("lo"), F.max(key).alias("hi"), F.count(F.lit(1)).alias("n_rows")
    )
    earlier = F.max("hi").over(Window.orderBy("lo").rowsBetween(Window.unboundedPreceding, -1))
    facts = bounds.select("n_rows", (F.col("lo") <= earlier).alias("overlaps")).agg(
        F.count(F.lit(1)).alias("parts"), F.max("n_rows").alias("heaviest"), F.bool_or("overlaps").alias("overlap")
    )
    parts, heaviest, overlap = facts.first()
    return not overlap and heaviest <= max(2 * profile.rows // parts, partition_rows(profile.rows, source_bytes(df)))


def register_source(spark: SparkSession, name: str, source: str | DataFrame) -> DataFrame:
    """Make a table readable as ``SELECT ... FROM name``; filters and columns reach its scan."""
    df = read_all(spark, source)
    df.createOrReplaceTempView(name)
    return df
