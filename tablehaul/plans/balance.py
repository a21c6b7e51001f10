"""Parts of about equal rows over composite keys, and the part that a row falls in.

A plan reads the key columns twice, whatever the skew: once into a quantile summary that gives the cuts, and once to count
the rows of each part. Only the plan reaches the driver. Rows find their part in the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from tablehaul.names import column, unused
from tablehaul.plans.summary import LOWEST, plan_cuts

# Bounds that a tree of comparisons holds; more are searched in arrays, one for each branch of a tree.
TREE_BOUNDS = 64
# A plan's bounds are broadcast up to this size; beyond, Spark joins them as it sees fit.
BROADCAST_BYTES = 64 << 20


class Leaf(NamedTuple):
    """Rows whose first key columns equal ``prefix`` and whose next one lies in [lo, hi]; ``one_key``: they share one full key."""

    prefix: tuple[int, ...]
    lo: int
    hi: int
    rows: int
    one_key: bool = False


def plan_leaves(
    df: DataFrame, keys: Sequence[str], n: int, lo: int, hi: int, total: int, count: bool = True
) -> list[Leaf]:
    """Disjoint leaves in key order that cover all rows: ranges of the leading column, where one value that holds over two
    shares is split by the next column, and so on. A value that fills a share stands alone. The outer bounds below a value are open.

    Without ``count`` the second pass is left out: ``rows`` are 0 and leaves without rows may be among them.
    """
    names = [f"k{i}" for i in range(len(keys))]
    narrow = df.select(*[column(k).cast("bigint").alias(name) for k, name in zip(keys, names, strict=True)])
    leaves = [Leaf(prefix, low, high, 0) for prefix, low, high in plan_cuts(narrow, n, lo, hi, total)]
    if not count:
        return leaves
    spread = [F.max(k) == F.min(k) for k in names]
    same = spread[0]
    for s in spread[1:]:
        same = same & s
    counted = with_leaf_number(narrow, leaves, names, "leaf").groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), same.alias("one_key"))
    facts = {r.leaf: (r.n, r.one_key) for r in counted.collect()}
    return _without_empty([leaf._replace(rows=facts[i][0], one_key=facts[i][1]) if i in facts else leaf for i, leaf in enumerate(leaves)])


def _without_empty(leaves: Sequence[Leaf]) -> list[Leaf]:
    """Leaves without rows are taken over by a neighbour under the same prefix, by one that is no single key if there is a choice."""
    out: list[Leaf] = []
    low = None
    for i, leaf in enumerate(leaves):
        after = leaves[i + 1] if i + 1 < len(leaves) and leaves[i + 1].prefix == leaf.prefix else None
        before = out[-1] if out and out[-1].prefix == leaf.prefix and low is None else None
        if leaf.rows:
            out.append(leaf if low is None else leaf._replace(lo=low))
            low = None
        elif before is not None and not (before.lo == before.hi and after is not None):
            out[-1] = before._replace(hi=leaf.hi)
        elif after is not None:
            low = leaf.lo if low is None else low
        else:
            out.append(leaf if low is None else leaf._replace(lo=low))
            low = None
    return out


def lower_bounds(leaves: Sequence[Leaf], width: int) -> list[tuple[int, ...]]:
    """Least key tuple of each leaf; the first leaf under a value takes all of that value's lower rows."""
    lower = [(*leaf.prefix, leaf.lo) for leaf in leaves]
    out = []
    for i, bound in enumerate(lower):
        shared = next((d for d, (a, b) in enumerate(zip(bound, lower[i - 1], strict=False)) if a != b), 0) if i else 0
        out.append(bound[: shared + 1] + (LOWEST,) * (width - shared - 1))
    return out


def _sorts_before(keys: Sequence[Column], bound: Sequence[int]) -> Column:
    out = None
    for key, value in reversed(list(zip(keys, bound, strict=True))):
        if out is None and value == LOWEST:
            continue
        less = key < F.lit(value)
        out = less if out is None else less | ((key == F.lit(value)) & out)
    return F.lit(False) if out is None else out


def _place(keys: Sequence[Column], bounds: Sequence[tuple[int, ...]], first: int) -> Column:
    """Number of the last bound that a key does not sort before, counted from ``first``; below all of them, the first."""
    if len(bounds) == 1:
        # not a bare integer literal, which grouping would take for a column position
        return F.lit(str(first)).cast("int")
    half = len(bounds) // 2
    return F.when(_sorts_before(keys, bounds[half]), _place(keys, bounds[:half], first)).otherwise(
        _place(keys, bounds[half:], first + half)
    )


def place_in_array(key: Column, bounds: Column, most: int) -> Column:
    """Number, from 0, of the last of at most ``most`` sorted values that is not above ``key``; 0 if all are."""
    steps = [1 << i for i in reversed(range(max(most - 1, 1).bit_length()))]

    def further(at: Column, step: Column) -> Column:
        return F.when(F.get(bounds, at + step) <= key, at + step).otherwise(at)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), further)


def with_leaf_number(df: DataFrame, leaves: Sequence[Leaf], keys: Sequence[str], name: str) -> DataFrame:
    """``df`` plus the number of the leaf that each row falls in, whatever their number.

    A tree of comparisons finds the place among ``TREE_BOUNDS`` bounds. With more leaves it finds a bucket of them, whose bounds are
    joined to the row as one array, searched by halves. The join is by bucket and keeps partitions and their order.
    """
    by = [column(k).cast("bigint") for k in keys]
    bounds = lower_bounds(leaves, len(keys))
    if len(bounds) <= TREE_BOUNDS:
        return df.withColumn(name, _place(by, bounds, 0))
    size = -(-len(bounds) // TREE_BOUNDS)
    first = list(range(0, len(bounds), size))
    bucket, of, begin, inside = unused([*df.columns, name], "bucket", "of_bucket", "begin", "inside")
    fields = ", ".join(f"b{i}: bigint" for i in range(len(keys)))
    frame = df.sparkSession.createDataFrame(
        [(i, start, bounds[start : start + size]) for i, start in enumerate(first)],
        f"{of} int, {begin} int, {inside} array<struct<{fields}>>",
    )
    if 8 * len(keys) * len(bounds) <= BROADCAST_BYTES:
        frame = F.broadcast(frame)
    key = F.struct(*[k.alias(f"b{i}") for i, k in enumerate(by)])
    placed = df.withColumn(bucket, _place(by, [bounds[start] for start in first], 0)).join(frame, F.col(bucket) == F.col(of))
    return placed.withColumn(name, F.col(begin) + place_in_array(key, F.col(inside), size)).drop(bucket, of, begin, inside)
