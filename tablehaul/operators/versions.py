"""Extracts with a ledger of key ranges: resumed after a failure, and brought up to date by the ranges that changed.

An extract is a folder of Parquet files and ``_versions/<n>``, a small table with one entry per key range: its bounds, rows,
highest key, a digest of its rows, and its files. A version appears by a rename, so a reader of ``read_version`` sees the one before or the
one after. While an extract is made, ``.<name>.open`` beside it holds the plan and the files that tasks have committed; a
range whose files hold all its planned rows is done. What a run that died has done is kept by the next one.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tablehaul import names
from tablehaul.functions.coerce import coerce_table
from tablehaul.operators.extract import ExtractStats, _final_path, _nothing
from tablehaul.plans.balance import Leaf, plan_leaves, with_leaf_number
from tablehaul.plans.catalog import has_text_blob as marked_text_blob
from tablehaul.plans.profile import check_keys, profile_key
from tablehaul.plans.strategy import rows_per_file, strategy_of
from tablehaul.sources.files import children, exists, remove_dir, replace_dir, total_bytes
from tablehaul.sources.parquet import write_extract
from tablehaul.sources.tables import default_partitions

VERSIONS = "_versions"
# Runs of open ranges whose bounds are pushed to the source one by one; with more, one interval spans them.
PUSHED_RUNS = 32
# Committed tasks' files stay when the job fails.
_KEEP = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}

_PLAN = "range_id int, prefix array<bigint>, lo bigint, hi bigint, rows bigint, one_key boolean, first_part int, parts int"
_ENTRY = (
    "range_id bigint, prefix array<bigint>, lo bigint, hi bigint, rows bigint, hi_key array<bigint>, "
    "one_key boolean, hash_sum decimal(38,0), hash_xor bigint, files array<string>"
)


# digests


def row_hash(columns: Sequence[str]) -> Column:
    """64 bits of a whole row; where the NULLs are counts as well."""
    nulls = F.concat(*[F.when(names.column(c).isNull(), "1").otherwise("0") for c in columns])
    return F.xxhash64(*names.columns(columns), nulls)


def digest(df: DataFrame, by: Sequence[Column], of: Sequence[str]) -> DataFrame:
    """Per group ``rows``, ``hash_sum`` and ``hash_xor`` of the columns ``of``: equal for equal rows in any order, combined
    before the shuffle."""
    (hashed,) = names.unused(df.columns, "hash")
    return df.withColumn(hashed, row_hash(of)).groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col(hashed).cast("decimal(20,0)")).cast("decimal(38,0)").alias("hash_sum"),
        F.bit_xor(hashed).alias("hash_xor"),
    )


# ranges and files


def _parts_of(leaves: Sequence[Leaf], n: int, rows: int) -> list[tuple[Leaf, int, int]]:
    """Leaves with their first partition and how many they have: copies of one full key that hold several shares are dealt out."""
    share, out, first = max(2 * rows // n, 1), [], 0
    for leaf in leaves:
        parts = -(-leaf.rows // share) if leaf.one_key and leaf.rows > share else 1
        out.append((leaf, first, parts))
        first += parts
    return out


def _laid_out(df: DataFrame, keys: Sequence[str], plan: Sequence[tuple[Leaf, int, int]], wanted: Sequence[int]) -> DataFrame:
    """Rows of the wanted ranges, each in its partitions and in key order; their bounds reach the source as filters."""
    leaves = [leaf for leaf, _, _ in plan]
    (number,) = names.unused(df.columns, "leaf")
    if len(wanted) < len(plan):
        df = df.filter(_within(leaves, wanted, keys[0]))
    placed = with_leaf_number(df, leaves, keys, number)
    if len(wanted) < len(plan):
        flags = "".join("1" if i in set(wanted) else "0" for i in range(len(plan)))
        placed = placed.filter(F.substring(F.lit(flags), F.col(number) + 1, F.lit(1)) == "1")
    part = F.col(number)
    if any(first != i or parts > 1 for i, (_, first, parts) in enumerate(plan)):
        firsts, counts = (F.split(F.lit(",".join(str(p[k]) for p in plan)), ",").cast("array<int>") for k in (1, 2))
        copy = F.pmod(F.monotonically_increasing_id(), F.get(counts, part)).cast("int")
        part = F.get(firsts, part) + copy
    total = plan[-1][1] + plan[-1][2]
    placed = placed.withColumn(number, part).repartitionById(total, F.col(number)).drop(number)
    return placed.sortWithinPartitions(*names.columns(keys))


def _within(leaves: Sequence[Leaf], wanted: Sequence[int], key: str) -> Column:
    """Bounds on the leading key that hold the wanted leaves: up to where the next leaf begins; the outermost are open."""
    runs: list[list[int]] = []
    for i in sorted(wanted):
        if runs and i == runs[-1][1] + 1:
            runs[-1][1] = i
        else:
            runs.append([i, i])
    if len(runs) > PUSHED_RUNS:
        runs = [[runs[0][0], runs[-1][1]]]

    def leading(i: int) -> int:
        return leaves[i].prefix[0] if leaves[i].prefix else leaves[i].lo

    out = F.lit(False)
    for first, last in runs:
        inside = F.lit(True)
        if first > 0:
            inside = inside & (names.column(key) >= leading(first))
        if last + 1 < len(leaves):
            inside = inside & (names.column(key) <= leading(last + 1))
        out = out | inside
    return out


def _files(spark: SparkSession, folder: str, before: set[str] = frozenset()) -> dict[str, int]:
    """Rows of each data file that was not there ``before``, from footers."""
    found = [f for f in children(spark, folder) if f.endswith(".parquet") and f not in before]
    if not found:
        return {}
    rows = spark.read.parquet(*[f"{folder}/{f}" for f in found]).groupBy(F.col("_metadata.file_name").alias("file")).count()
    return dict.fromkeys(found, 0) | dict(map(tuple, rows.collect()))


def _part_of(file: str) -> int:
    return int(file.split("-")[1])


def _done(files: Mapping[str, int], plan: Sequence[tuple[Leaf, int, int]]) -> dict[int, list[str]]:
    """Files of the ranges whose files hold all their rows."""
    of_part: dict[int, list[str]] = {}
    for file in sorted(files):
        of_part.setdefault(_part_of(file), []).append(file)
    out = {}
    for i, (leaf, first, parts) in enumerate(plan):
        mine = [f for p in range(first, first + parts) for f in of_part.get(p, [])]
        if mine and sum(files[f] for f in mine) == leaf.rows:
            out[i] = mine
    return out


def _entries(spark: SparkSession, folder: str, keys: Sequence[str], plan: Sequence[tuple[Leaf, int, int]], done: Mapping[int, list[str]], first_id: int = 0) -> DataFrame:
    """Ledger entries of written ranges, from one pass over their files."""
    rows = [(first_id + i, list(plan[i][0].prefix), plan[i][0].lo, plan[i][0].hi, files) for i, files in done.items()]
    ranges = spark.createDataFrame(rows, "range_id bigint, prefix array<bigint>, lo bigint, hi bigint, files array<string>")
    of_file = ranges.select("range_id", F.explode("files").alias("file"))
    data = spark.read.parquet(*[f"{folder}/{f}" for files in done.values() for f in files])
    file, place, hashed, *tops = names.unused(data.columns, "file_", "place_", "hash_", *(f"key_{i}" for i in range(len(keys))))
    key = [c.cast("bigint").alias(t) for c, t in zip(names.columns(keys), tops, strict=True)]
    hashes = data.select(F.col("_metadata.file_name").alias(file), F.col("_metadata.row_index").alias(place), row_hash(data.columns).alias(hashed), *key)
    # files are in key order, so their last row has the highest key; key by key, as the greatest struct would sort all rows
    spread = [F.max(t) == F.min(t) for t in tops]
    per_file = hashes.groupBy(file).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col(hashed).cast("decimal(20,0)")).cast("decimal(38,0)").alias("hash_sum"), F.bit_xor(hashed).alias("hash_xor"),
        *(F.max_by(t, place).alias(f"top_{i}") for i, t in enumerate(tops)), reduce(Column.__and__, spread).alias("one_key"),
    ).withColumn("top", F.struct(*(f"top_{i}" for i in range(len(keys)))))
    facts = per_file.join(F.broadcast(of_file), F.col(file) == F.col("file")).groupBy("range_id").agg(
        F.sum("rows").alias("rows"), F.sum("hash_sum").cast("decimal(38,0)").alias("hash_sum"), F.bit_xor("hash_xor").alias("hash_xor"), F.max("top").alias("top"),
        (F.bool_and("one_key") & (F.min("top") == F.max("top"))).alias("one_key"),
    )
    top_list = F.array(*[F.col(f"top.top_{i}") for i in range(len(keys))])
    return ranges.join(facts, "range_id").select("range_id", "prefix", "lo", "hi", "rows", top_list.alias("hi_key"), "one_key", "hash_sum", "hash_xor", "files")


# versions


def versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(v) for v in children(spark, f"{path}/{VERSIONS}") if v.isdigit()) if exists(spark, f"{path}/{VERSIONS}") else []


def ledger(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Entries of a version, by default the last."""
    known = versions(spark, path)
    if not known or version not in (None, *known):
        raise FileNotFoundError(f"{path} has no version {version or ''}")
    return spark.read.schema(_ENTRY).parquet(f"{path}/{VERSIONS}/{known[-1] if version is None else version}")


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of a version: its files and no others."""
    files = [r.file for r in ledger(spark, path, version).select(F.explode("files").alias("file")).collect()]
    return spark.read.parquet(*[f"{path}/{f}" for f in files])


def _commit(spark: SparkSession, path: str, number: int, entries: DataFrame) -> None:
    """One entry per range; the version appears when its folder gets its name."""
    unfinished = f"{path}/{VERSIONS}/.{uuid.uuid4().hex}"
    entries.coalesce(1).write.parquet(unfinished)
    if exists(spark, f"{path}/{VERSIONS}/{number}"):
        remove_dir(spark, unfinished)
        raise RuntimeError(f"{path}: version {number} was committed by another run")
    replace_dir(spark, unfinished, f"{path}/{VERSIONS}/{number}")


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete the files that the last version does not name, and the versions before it. Returns the number of files."""
    kept = {r.file for r in ledger(spark, path).select(F.explode("files").alias("file")).collect()}
    old = [f for f in children(spark, path) if f.endswith(".parquet") and f not in kept]
    for f in old:
        remove_dir(spark, f"{path}/{f}")
    for v in versions(spark, path)[:-1]:
        remove_dir(spark, f"{path}/{VERSIONS}/{v}")
    return len(old)


# extracts


def run_extract_resumable(
    source: DataFrame,
    table: str,
    out_dir: str,
    keys: Sequence[str],
    n: int | None = None,
    waves: int = 1,
    declared_schema: Mapping[str, str] | None = None,
    charset: str | None = None,
    has_text_blob: bool | None = None,
    compress: bool = False,
    overwrite: bool = False,
) -> ExtractStats:
    """An extract in key ranges that a later call goes on with if it fails, and that ``extract_delta`` can bring up to date.

    The plan is written before the first row. If a call with the same table, folder and keys finds one whose source has as
    many rows, only ranges whose files do not hold all their rows are read, by filters on the leading key, and written
    again. A source that has changed its number of rows, its columns or its keys starts anew. The finished folder is
    moved to its name as with ``run_extract``, with version 1 of the ledger inside.

    ``waves`` cuts the open ranges into so many jobs, one after the other: what a job has written outlives the loss of a later one's
    shuffle, and only a part of the table is in shuffle files at a time. Worth it where the source's files are about in key order,
    as each job's filter on the leading key then leaves its part of them.
    """
    started = time.monotonic()
    spark = source.sparkSession
    final = _final_path(spark, out_dir, table, overwrite)
    if not keys:
        raise ValueError("key ranges need a key")
    check_keys(source, keys)
    profile = profile_key(source, keys)
    if profile.rows == 0:
        return _nothing(table, started)
    blob = marked_text_blob(source) if has_text_blob is None else has_text_blob
    folder, _, name = final.rpartition("/")
    work = f"{folder}/.{name}.open"
    rows = coerce_table(source, declared_schema, charset)
    signature = "|".join([rows.schema.simpleString(), *keys, str(profile.rows)])
    plan = _open_plan(spark, work, signature)
    if plan is None:
        remove_dir(spark, work)
        parts = n or default_partitions(source, profile.rows, blob)
        plan = _parts_of(plan_leaves(source, keys, parts, profile.lo, profile.hi, profile.rows), parts, profile.rows)
        planned = [(i, list(leaf.prefix), leaf.lo, leaf.hi, leaf.rows, leaf.one_key, first, count) for i, (leaf, first, count) in enumerate(plan)]
        unfinished = f"{work}/.{uuid.uuid4().hex}"
        spark.createDataFrame([(*p, signature) for p in planned], f"{_PLAN}, signature string").coalesce(1).write.parquet(unfinished)
        replace_dir(spark, unfinished, f"{work}/plan")

    data = f"{work}/data"
    files = _files(spark, data) if exists(spark, data) else {}
    done = _done(files, plan)
    for file in set(files) - {f for mine in done.values() for f in mine}:
        remove_dir(spark, f"{data}/{file}")
    missing = [i for i in range(len(plan)) if i not in done]
    size = -(-len(missing) // max(waves, 1))
    for wave in range(0, len(missing), max(size, 1)):
        laid = coerce_table(_laid_out(source, keys, plan, missing[wave : wave + size]), declared_schema, charset)
        write_extract(laid, data, compress, rows_per_file(profile.rows, blob), mode="append", options=_KEEP)
    if missing:
        done = _done(_files(spark, data), plan)
    if len(done) < len(plan):
        lost = [i for i in range(len(plan)) if i not in done]
        raise RuntimeError(f"{table}: ranges {lost[:10]} of {len(plan)} do not hold their planned rows; the source may have changed")
    remove_dir(spark, f"{data}/_temporary")
    _commit(spark, data, 1, _entries(spark, data, keys, plan, done))
    megabytes = total_bytes(spark, data) / 2**20
    replace_dir(spark, data, final)
    remove_dir(spark, work)
    seconds = time.monotonic() - started
    return ExtractStats(table, strategy_of(profile.rows, len(keys)), profile.rows, seconds, megabytes, profile.rows / seconds, final)


def _open_plan(spark: SparkSession, work: str, signature: str) -> list[tuple[Leaf, int, int]] | None:
    """The plan of an unfinished extract of the same source."""
    if not exists(spark, f"{work}/plan"):
        return None
    rows = spark.read.parquet(f"{work}/plan").orderBy("range_id").collect()
    if not rows or rows[0].signature != signature:
        return None
    return [(Leaf(tuple(r.prefix), r.lo, r.hi, r.rows, r.one_key), r.first_part, r.parts) for r in rows]


def extract_delta(
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    declared_schema: Mapping[str, str] | None = None,
    charset: str | None = None,
    n: int | None = None,
    compress: bool = False,
) -> dict[str, int]:
    """Bring an extract with a ledger up to date: ranges that changed are written again, higher keys get ranges of their own.

    One pass over the source digests each known range and counts the rows above the ledger's highest leading key. Ranges with another
    digest are changed, deleted rows among them; only those and the new keys are read again, by filters on the leading key.
    Other files stay as they are, under their names, and the next version of the ledger names what is valid from now on; ``vacuum``
    deletes the rest. ``n``: ranges for the new keys, by default as many rows in each as the known ones have. Returns counts of ranges.
    """
    spark = source.sparkSession
    check_keys(source, keys)
    profile = profile_key(source, keys)
    number = versions(spark, path)[-1]
    known = ledger(spark, path, number).orderBy("range_id").collect()
    rows = coerce_table(source, declared_schema, charset)
    stored = spark.read.parquet(f"{path}/{known[0].files[0]}")
    if [f.dataType for f in rows.schema] != [f.dataType for f in stored.schema] or rows.columns != stored.columns:
        raise ValueError(f"{path} has other columns: {stored.schema.simpleString()}")
    known.sort(key=lambda r: (*r.prefix, r.lo))
    # keys of the highest leading value belong to the last range
    top = max(r.hi_key[0] for r in known)
    above = names.column(keys[0]) > F.lit(top)
    leaves = [Leaf(tuple(r.prefix), r.lo, r.hi, r.rows, r.one_key) for r in known]
    (place,) = names.unused(rows.columns, "leaf")
    marked = with_leaf_number(rows, leaves, keys, place).withColumn(place, F.when(~above, F.col(place)))
    now = {r.leaf: r for r in digest(marked, [F.col(place).alias("leaf")], of=rows.columns).collect()}
    same = [i for i, r in enumerate(known) if i in now and (now[i].rows, now[i].hash_sum, now[i].hash_xor) == (r.rows, r.hash_sum, r.hash_xor)]
    gone = [i for i in range(len(known)) if i not in now]
    changed = [i for i in range(len(known)) if i not in set(same) | set(gone)]
    new_rows = now[None].rows if None in now else 0
    report = {"kept": len(same), "replaced": len(changed), "removed": len(gone), "added": 0}
    if not changed and not gone and not new_rows:
        return report
    entries = [spark.createDataFrame([tuple(known[i]) for i in same], _ENTRY)] if same else []
    next_id = max(r.range_id for r in known) + 1
    if changed:
        counted = [leaf._replace(rows=now[i].rows if i in now else 0) for i, leaf in enumerate(leaves)]
        plan = _parts_of(counted, len(known), profile.rows - new_rows)
        laid = _laid_out(source.filter(~above), keys, plan, changed)
        entries.append(_written(spark, laid, path, keys, plan, changed, declared_schema, charset, compress, next_id))
        next_id += len(known)
    if new_rows:
        fresh = source.filter(above)
        parts = n or max(1, -(-new_rows * len(known) // max(sum(r.rows for r in known), 1)))
        above_profile = profile_key(fresh, keys)
        plan = _parts_of(plan_leaves(fresh, keys, parts, above_profile.lo, above_profile.hi, new_rows), parts, new_rows)
        laid = _laid_out(fresh, keys, plan, range(len(plan)))
        entries.append(_written(spark, laid, path, keys, plan, range(len(plan)), declared_schema, charset, compress, next_id))
        report["added"] = len(plan)
    together = reduce(DataFrame.union, [e.select(*[c.split()[0] for c in _ENTRY.split(", ")]) for e in entries]) if entries else spark.createDataFrame([], _ENTRY)
    held = together.agg(F.sum("rows")).first()[0] or 0
    if held != profile.rows:
        raise RuntimeError(f"{path}: {profile.rows} rows in source, {held} in the next version; the source may have changed")
    _commit(spark, path, number + 1, together)
    return report


def _written(spark, laid, path, keys, plan, wanted, declared_schema, charset, compress, first_id) -> DataFrame:
    """Write ranges into the folder of an extract; files of a run that fails are named by no version."""
    before = set(children(spark, path))
    rows = sum(leaf.rows for leaf, _, _ in plan)
    write_extract(coerce_table(laid, declared_schema, charset), path, compress, rows_per_file(max(rows, 1)), mode="append")
    done = {i: files for i, files in _done(_files(spark, path, before), plan).items() if i in set(wanted)}
    if len(done) < len(wanted):
        raise RuntimeError(f"{path}: {len(wanted) - len(done)} ranges do not hold their planned rows; the source may have changed")
    return _entries(spark, path, keys, plan, done, first_id)
