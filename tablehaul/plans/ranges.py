"""Key ranges: equal-width, chunked, balanced, and which range a key falls in.

Bounds are inclusive and disjoint, so every key belongs to exactly one range. Plans
are computed with Python integers (a plan has as many rows as ranges); the data
side is arithmetic on the key, never a join against the plan.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tablehaul.names import column, quoted
from tablehaul.plans.balance import Leaf, place_in_array, plan_leaves
from tablehaul.plans.profile import KeyProfile, profile_key

# Ranges up to which a comparison tree beats a search in an array; the ids are the same.
TREE_RANGES = 256


class KeyRange(NamedTuple):
    range_id: int
    lo: int
    hi: int


def plan_ranges(lo: int, hi: int, n: int) -> list[KeyRange]:
    """``n`` ranges of equal width over [lo, hi], fewer when there are fewer keys."""
    if n < 1:
        raise ValueError("at least one range is needed")
    if hi < lo:
        raise ValueError(f"empty key interval [{lo}, {hi}]")
    span = hi - lo + 1
    n = min(n, span)
    starts = [lo + span * i // n for i in range(n)] + [hi + 1]
    return [KeyRange(i, starts[i], starts[i + 1] - 1) for i in range(n)]


def ranges_frame(spark: SparkSession, ranges: Sequence[KeyRange]) -> DataFrame:
    return spark.createDataFrame(
        [tuple(r) for r in ranges],
        T.StructType(
            [
                T.StructField("range_id", T.LongType()),
                T.StructField("lo", T.LongType()),
                T.StructField("hi", T.LongType()),
            ]
        ),
    )


def plan_chunks(spark: SparkSession, ranges: Sequence[KeyRange], size: int) -> DataFrame:
    """Each range cut into chunks of ``size`` key values: ``range_id, chunk_id, lo, hi``."""
    if size < 1:
        raise ValueError("chunk size must be positive")
    cut = [(*r, -(-(r.hi - r.lo + 1) // size) - 1) for r in ranges]
    frame = spark.createDataFrame(cut, "range_id bigint, lo bigint, hi bigint, last bigint")
    start = F.col("lo") + F.col("chunk_id") * F.lit(size)
    return frame.select(
        "range_id", "lo", "hi", "last", F.explode(F.sequence(F.lit(0).cast("bigint"), "last")).alias("chunk_id")
    ).select(
        "range_id",
        "chunk_id",
        start.alias("lo"),
        # the last chunk takes the range's own end, so no sum passes the bigint bound
        F.when(F.col("chunk_id") == F.col("last"), F.col("hi"))
        .otherwise(start + F.lit(size - 1))
        .alias("hi"),
    )


def _constant_id(value: int) -> Column:
    # not a bare integer literal, which grouping would take for a column position
    return F.lit(str(value)).cast("int")


def range_id(key: Column, lo: int, hi: int, n: int) -> Column:
    """Id of the equal-width range (``plan_ranges(lo, hi, n)``) a key falls in.

    Inverse of the plan's floor formula. Bigint arithmetic where the product is
    known to fit, decimal otherwise.
    """
    span = hi - lo + 1
    n = min(n, span)
    if n == 1:
        return _constant_id(0)
    if span * n < 2**63 and abs(lo) < 2**62 and abs(hi) < 2**62:
        place = (key.cast("bigint") - F.lit(lo) + F.lit(1)) * F.lit(n) - F.lit(1)
        return F.call_function("div", place, F.lit(span)).cast("int")
    wide = T.DecimalType(20, 0)
    offset = key.cast(wide) - F.lit(lo).cast(wide) + F.lit(1).cast(wide)
    place = offset.cast(wide) * F.lit(n).cast(T.DecimalType(10, 0)) - F.lit(1).cast(wide)
    return F.call_function("div", place, F.lit(str(span)).cast(wide)).cast("int")


def range_counts(df: DataFrame, key: str, n: int, profile: KeyProfile | None = None) -> DataFrame:
    """Rows per equal-width range, empty ranges included: ``range_id, lo, hi, n_rows``."""
    profile = profile or profile_key(df, [key])
    if profile.rows == 0:
        return ranges_frame(df.sparkSession, []).withColumn("n_rows", F.lit(0).cast("bigint"))
    ranges = plan_ranges(profile.lo, profile.hi, n)
    counted = df.groupBy(range_id(column(key), profile.lo, profile.hi, n).cast("bigint").alias("range_id")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    return (
        ranges_frame(df.sparkSession, ranges)
        .join(counted, "range_id", "left")
        .select("range_id", "lo", "hi", F.coalesce("n_rows", F.lit(0).cast("bigint")).alias("n_rows"))
    )


def heaviest_range(df: DataFrame, key: str, n: int, profile: KeyProfile) -> int:
    """Rows in the fullest equal-width range; reads the key column only."""
    ids = df.groupBy(range_id(column(key), profile.lo, profile.hi, n)).agg(F.count(F.lit(1)).alias("n_rows"))
    return ids.agg(F.max("n_rows")).first()[0] or 0


def plan_balanced_ranges(
    df: DataFrame, key: str, n: int, profile: KeyProfile | None = None
) -> list[KeyRange]:
    """About equal rows per range, cut at quantiles of the key from a summary (``plans/summary.py``).

    A key value that fills several shares is cut off on both sides and stands alone,
    so fewer than ``n`` ranges may come back; any other range holds at most about
    two shares. Still disjoint and gap-free over [lo, hi].
    """
    if n < 1:
        raise ValueError("at least one range is needed")
    profile = profile or profile_key(df, [key])
    if profile.rows == 0:
        return []
    leaves = plan_leaves(df, [key], n, profile.lo, profile.hi, profile.rows, count=False)
    return [KeyRange(i, leaf.lo, leaf.hi) for i, leaf in enumerate(leaves)]


def assign_range(key: Column, ranges: Sequence[KeyRange]) -> Column:
    """Range id for any plan: a balanced tree of comparisons (log2 n per row), or a search by halves for plans of many ranges."""
    if not ranges:
        raise ValueError("at least one range is needed")
    if len(ranges) > TREE_RANGES:
        return _search_ranges(key, ranges)
    if len(ranges) == 1:
        return _constant_id(ranges[0].range_id)
    half = len(ranges) // 2
    return F.when(key <= F.lit(ranges[half - 1].hi), assign_range(key, ranges[:half])).otherwise(
        assign_range(key, ranges[half:])
    )


def _search_ranges(key: Column, ranges: Sequence[KeyRange]) -> Column:
    # text that the optimizer turns into one array, as a list of that many literals would be slow to plan
    lows = F.split(F.lit(",".join(str(r.lo) for r in ranges)), ",").cast("array<bigint>")
    place = place_in_array(key.cast("bigint"), lows, len(ranges))
    if [r.range_id for r in ranges] == list(range(len(ranges))):
        return place
    return F.get(F.split(F.lit(",".join(str(r.range_id) for r in ranges)), ",").cast("array<int>"), place)


def range_predicates(quoted_key: str, ranges: Sequence[KeyRange], open_ended: bool = False) -> list[str]:
    """One SQL predicate per range, for a reader that pushes them to the source.

    ``open_ended`` drops the outer bounds, so rows that a live source gained
    outside the profiled interval are still read, once.
    """
    out = []
    for i, r in enumerate(ranges):
        low = None if open_ended and i == 0 else f"{quoted_key} >= {r.lo}"
        high = None if open_ended and i == len(ranges) - 1 else f"{quoted_key} <= {r.hi}"
        out.append(" AND ".join(p for p in (low, high) if p) or "1 = 1")
    return out


def plan_key_predicates(
    df: DataFrame,
    keys: Sequence[str],
    n: int,
    quote: str = "`",
    profile: KeyProfile | None = None,
) -> list[str]:
    """Disjoint predicates of about equal rows over a composite key.

    Balanced ranges of the leading column, except that one value holding more than
    two shares is split by the next key column, and so on. One pass over the key columns.
    """
    profile = profile or profile_key(df, keys[:1])
    if profile.rows == 0:
        return ["1 = 1"]
    leaves = plan_leaves(df, keys, n, profile.lo, profile.hi, profile.rows, count=False)
    return leaf_predicates(leaves, [quoted(k, quote) for k in keys])


def leaf_predicates(leaves: Sequence[Leaf], quoted_keys: Sequence[str]) -> list[str]:
    """One predicate per leaf. The outer bounds of each column are open, so rows that arrive meanwhile are read, once."""

    def below(members: Sequence[Leaf], depth: int) -> list[str]:
        # a leaf of this column, or the leaves under one of its values
        parts: list[tuple[int, int, list[Leaf]]] = []
        for leaf in members:
            deeper = len(leaf.prefix) > depth
            lo, hi = (leaf.prefix[depth],) * 2 if deeper else (leaf.lo, leaf.hi)
            if deeper and parts and parts[-1][:2] == (lo, hi):
                parts[-1][2].append(leaf)
            else:
                parts.append((lo, hi, [leaf]))
        ranges = [KeyRange(i, lo, hi) for i, (lo, hi, _) in enumerate(parts)]
        out = []
        for (_, _, own), predicate in zip(parts, range_predicates(quoted_keys[depth], ranges, open_ended=True), strict=True):
            if len(own[0].prefix) > depth:
                out += [f"{predicate} AND {p}" for p in below(own, depth + 1)]
            else:
                out.append(predicate)
        return out

    return below(leaves, 0)
