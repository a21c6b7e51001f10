"""Keys of tables that declare none: the least sets of columns whose values are unique.

Sets are searched by size. One pass of distinct-count sketches rules out single columns and, as a set has at most the product
of its columns' distinct counts, most larger sets too; sketches of the sets left rule out those with clearly fewer
values than rows. What remains is decided exactly, all sets of one size in one job: first by the keys of some hashes, where most sets
already repeat, then by all hashes, of which no two are equal in a key.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, functions as F, types as T

from tablehaul.names import column
from tablehaul.plans.sketches import DISTINCT_ERROR, LOG_BUCKETS

MAX_COLUMNS = 4
# Sets whose sketches, or exact counts, are made in one pass.
SETS_A_PASS = 64
# One hash in so many is looked at first to refute a set.
SCREEN = 64


def key_uniqueness(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row ``n, n_distinct, n_repeated, most``: rows, exact different keys, rows that repeat a key, rows of the commonest one.

    Keys are counted with partial sums before the shuffle; NULL is a value like others.
    """
    counts = df.groupBy(*(column(k) for k in keys)).agg(F.count(F.lit(1)).alias("copies"))
    facts = counts.agg(F.sum("copies").alias("n"), F.count(F.lit(1)).alias("n_distinct"), F.max("copies").alias("most"))
    zero = F.lit(0).cast("bigint")
    return facts.select(
        F.coalesce("n", zero).alias("n"), "n_distinct", (F.coalesce("n", zero) - F.col("n_distinct")).alias("n_repeated"),
        F.coalesce("most", zero).alias("most"),
    )


def _passes(sets: list[tuple[int, ...]]):
    return (sets[i : i + SETS_A_PASS] for i in range(0, len(sets), SETS_A_PASS))


def _estimates(rows: DataFrame, sets: list[tuple[int, ...]]) -> list[int]:
    """Distinct values of each set, by sketches."""
    out: list[int] = []
    for part in _passes(sets):
        measures = [
            F.hll_sketch_estimate(F.hll_sketch_agg(F.xxhash64(*(f"c{i}" for i in s)), F.lit(LOG_BUCKETS))).alias(f"e{n}")
            for n, s in enumerate(part)
        ]
        out += list(rows.agg(*measures).first())
    return out


def _repeated(rows: DataFrame, sets: list[tuple[int, ...]], share: int = 1) -> set[int]:
    """Numbers of the sets of which two rows have equal hashes, among the hashes that ``share`` divides."""
    hashes = F.array(*(F.struct(F.lit(n).alias("s"), F.xxhash64(*(f"c{i}" for i in s)).alias("h")) for n, s in enumerate(sets)))
    each = rows.select(F.inline(hashes))
    if share > 1:
        each = each.where(F.pmod("h", F.lit(share)) == 0)
    repeated = each.groupBy("s", "h").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    return {r.s for r in repeated.select("s").distinct().collect()}


def _unique(rows: DataFrame, sets: list[tuple[int, ...]]) -> list[tuple[int, ...]]:
    """The sets under which no two rows are equal, exactly.

    Rows of different hashes are different, so a set without equal hashes is unique. Most sets are refuted by the keys of one hash in
    ``SCREEN``; the hashes of the others are counted whole. Sets with equal hashes are counted by their values.
    """
    out: list[tuple[int, ...]] = []
    for part in _passes(sets):
        doubtful: list[tuple[int, ...]] = []
        screened = _repeated(rows, part, SCREEN)
        open_sets = [s for n, s in enumerate(part) if n not in screened]
        equal = _repeated(rows, open_sets) if open_sets else set()
        doubtful = [s for n, s in enumerate(part) if n in screened] + [s for n, s in enumerate(open_sets) if n in equal]
        same = {s for s in doubtful if _has_copies(rows, s, s not in open_sets)}
        out += [s for s in part if s not in same]
    return out


def _has_copies(rows: DataFrame, key: tuple[int, ...], screened: bool) -> bool:
    """Whether two rows have equal values, looked for where hashes are equal; a screened set's first in its part of the hashes."""
    columns = [F.col(f"c{i}") for i in key]
    hashed = rows.select(F.xxhash64(*columns).alias("h"), *columns)
    for share in [SCREEN, 1] if screened else [1]:
        some = hashed.where(F.pmod("h", F.lit(share)) == 0) if share > 1 else hashed
        copies = some.groupBy("h", *columns).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
        if not copies.isEmpty():
            return True
    return False


def discover_keys(df: DataFrame, candidates: Sequence[str] | None = None, max_columns: int = MAX_COLUMNS) -> list[list[str]]:
    """All least unique sets of at most ``max_columns`` of the candidate columns, in order of size, then of columns.

    Candidates are the integer columns if not named, as only those can be cut into ranges; columns with a NULL are no part of a key.
    Empty if there is none; a table of at most one row is unique by nothing in particular and has none either. Sets are
    combinations, so name candidates of very wide tables.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.IntegralType)] if candidates is None else list(candidates)
    if missing := [c for c in names if c not in types]:
        raise ValueError(f"candidate columns not in the table: {missing}")
    if not names:
        return []
    rows = df.select(*(column(c).alias(f"c{i}") for i, c in enumerate(names)))
    facts = rows.agg(F.count(F.lit(1)), *(F.count(f"c{i}") for i in range(len(names)))).first()
    n = facts[0]
    whole = [i for i in range(len(names)) if facts[i + 1] == n]
    if n < 2 or not whole:
        return []
    singles = dict(zip(whole, _estimates(rows, [(i,) for i in whole]), strict=True))
    # too few values even if the sketches are as far off as they may be
    enough = math.log(n)
    most = {i: math.log(max(e, 1) * (1 + DISTINCT_ERROR) + 1) for i, e in singles.items()}
    found: list[tuple[int, ...]] = []
    for size in range(1, min(max_columns, len(whole)) + 1):
        sets = [s for s in combinations(whole, size) if not any(set(f) <= set(s) for f in found)]
        sets = [s for s in sets if sum(most[i] for i in s) >= enough]
        if not sets:
            continue
        likely = [s for s, e in zip(sets, _estimates(rows, sets), strict=True) if e * (1 + DISTINCT_ERROR) >= n]
        found += _unique(rows, likely)
    return [[names[i] for i in s] for s in found]
