"""A checksum tree beside an extract: what differs is found from the root down, without reading the extract again.

``<extract>/_digests`` has one row per node: key ranges of about equal rows at the bottom, groups of ``FAN_OUT`` of them above, up to
one root, each with its rows and two sums of row hashes. A later check reads the source once, compares the trees level by level and reads
keys only of the leaves that differ, on both sides, by filters on the leading key.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablehaul.names import quoted, unused
from tablehaul.operators.directory import _current
from tablehaul.operators.reconcile import _balance, _report, _tagged
from tablehaul.operators.versions import digest
from tablehaul.plans.balance import Leaf, plan_leaves, with_leaf_number
from tablehaul.plans.profile import check_keys, profile_key
from tablehaul.plans.ranges import leaf_predicates
from tablehaul.sources.files import replace_dir

DIGESTS = "_digests"
LEAF_ROWS = 100_000
FAN_OUT = 16
# Leaves that differ are read by predicates of their own up to this number; with more, both sides are compared whole.
MOST_LEAVES = 256

_SUMS = ("rows", "hash_sum", "hash_xor")


def _tree(leaves: DataFrame, levels: int) -> DataFrame:
    """(level, node, rows, hash_sum, hash_xor) of all levels, from (leaf, sums); level 0 are the leaves."""
    level = leaves.select(F.lit(0).alias("level"), F.col("leaf").cast("bigint").alias("node"), *_SUMS)
    out = level
    for i in range(1, levels):
        parent = F.call_function("div", F.col("node"), F.lit(FAN_OUT).cast("bigint")).alias("node")
        level = level.groupBy(parent).agg(F.sum("rows").alias("rows"), F.sum("hash_sum").cast("decimal(38,0)").alias("hash_sum"), F.bit_xor("hash_xor").alias("hash_xor"))
        level = level.select(F.lit(i).alias("level"), "node", *_SUMS)
        out = out.union(level)
    return out


def _levels(leaves: int) -> int:
    levels = 1
    while leaves > 1:
        leaves, levels = -(-leaves // FAN_OUT), levels + 1
    return levels


def _leaf_digests(df: DataFrame, leaves: Sequence[Leaf], keys: Sequence[str]) -> DataFrame:
    (place,) = unused(df.columns, "leaf")
    return digest(with_leaf_number(df, leaves, keys, place), [F.col(place).alias("leaf")], of=sorted(df.columns))


def write_digests(spark: SparkSession, path: str, keys: Sequence[str], leaf_rows: int = LEAF_ROWS) -> int:
    """Write the tree of an extract; returns its leaves. Columns are hashed in the order of their names."""
    data = _current(spark, path)
    check_keys(data, keys)
    profile = profile_key(data, keys)
    leaves = plan_leaves(data, keys, max(1, -(-profile.rows // leaf_rows)), profile.lo, profile.hi, profile.rows) if profile.rows else [Leaf((), 0, 0, 0)]
    bounds = spark.createDataFrame([(0, i, list(leaf.prefix), leaf.lo, leaf.hi) for i, leaf in enumerate(leaves)], "level int, node bigint, prefix array<bigint>, lo bigint, hi bigint")
    nodes = _tree(_leaf_digests(data, leaves, keys), _levels(len(leaves)))
    unfinished = f"{path}/.{uuid.uuid4().hex}"
    nodes.join(bounds, ["level", "node"], "full").sort("level", "node").write.parquet(unfinished)
    replace_dir(spark, unfinished, f"{path}/{DIGESTS}")
    return len(leaves)


def reconcile_tree(source: DataFrame, path: str, keys: Sequence[str]) -> DataFrame:
    """One row like ``reconcile(content=True)``'s, with ``leaves_read`` and ``keys_read``: how much was compared key by key.

    ``source`` must have the extract's columns and types. It is read once for its own tree; the extract is not read, but for the leaves
    that differ. Equal sums of different rows have a chance of about one in 2^64.
    """
    spark = source.sparkSession
    stored = spark.read.parquet(f"{path}/{DIGESTS}")
    extract = _current(spark, path)
    if sorted((f.name, f.dataType.simpleString()) for f in source.schema) != sorted((f.name, f.dataType.simpleString()) for f in extract.schema):
        raise ValueError("trees can only be compared over the same columns")
    check_keys(source, keys)
    # one row per leaf: the plan
    rows = stored.filter("level = 0").orderBy("node").collect()
    leaves = [Leaf(tuple(r.prefix), r.lo, r.hi, r.rows or 0) for r in rows]
    levels = _levels(len(leaves))
    own = _tree(_leaf_digests(source, leaves, keys), levels).select("level", "node", *[F.col(c).alias(f"own_{c}") for c in _SUMS])
    both = stored.select("level", "node", *_SUMS).join(own, ["level", "node"], "full")
    same = F.lit(True)
    for c in _SUMS:
        same = same & F.col(c).eqNullSafe(F.col(f"own_{c}"))
    differing = both.filter(~same | (F.col("level") == levels - 1)).collect()
    # from the root down: a node is looked at if its parent differs
    root = next((r for r in differing if r.level == levels - 1), None)
    source_rows, extracted_rows = (root.own_rows or 0, root.rows or 0) if root else (0, 0)
    wrong = {0} if root and any(root[c] != root[f"own_{c}"] for c in _SUMS) else set()
    for level in range(levels - 2, -1, -1):
        wrong = {r.node for r in differing if r.level == level and r.node // FAN_OUT in wrong}
    zero = [0, 0, 0]
    if not wrong:
        counted = (source_rows, extracted_rows, *zero, 0, 0)
    else:
        sides = [source, extract]
        if len(wrong) <= MOST_LEAVES:
            predicates = leaf_predicates(leaves, [quoted(k) for k in keys])
            condition = " OR ".join(f"({predicates[i]})" for i in sorted(wrong))
            sides = [df.filter(condition) for df in sides]
        tagged, by = _tagged(*sides, keys, True)
        found = _report(_balance(tagged, by)).first()
        read = found["source_rows"] + found["extracted_rows"]
        counted = (source_rows, extracted_rows, found["duplicate_rows"], found["missing_rows"], found["extra_rows"], len(wrong), read)
    names = ("source_rows", "extracted_rows", "duplicate_rows", "missing_rows", "extra_rows", "leaves_read", "keys_read")
    return spark.createDataFrame([counted], ", ".join(f"{n} bigint" for n in names))
