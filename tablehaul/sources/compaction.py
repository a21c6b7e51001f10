"""Compaction in place, by file sizes: files that fit stay as they are, only small and oversized ones are written again.

Sizes come from the listing and row counts from footers. Small files are packed into bins, large ones cut. New files are written beside
the folder and checked against the plan; a journal in the folder then names the old and the new files, and they are swapped by renames. A run that
dies before the journal is there has changed nothing; one that dies later is finished by the next call. While files are swapped, readers
may miss rows but see none twice.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablehaul.names import columns, unused
from tablehaul.sources.files import children, exists, move_file, remove_dir, replace_dir
from tablehaul.sources.parquet import write_extract

JOURNAL = "_compaction"
# A file with fewer of the wanted rows is small.
SMALL = 0.5


@dataclass(frozen=True)
class Compaction:
    """Files before and after, files taken over as they are, and what was written again."""

    files_before: int
    files_after: int
    files_kept: int
    rows_rewritten: int
    bytes_rewritten: int


@dataclass(frozen=True)
class SourceFile:
    name: str
    rows: int
    size: int


def plan_bins(files: Sequence[SourceFile], rows_per_file: int, keep_order: bool = False) -> list[list[SourceFile]]:
    """Files that are written together: bins of small ones by best fit, largest first; each oversized one alone.

    With ``keep_order`` only neighbours by name share a bin, so that files in key order stay so, as new files are named after
    the first one of their bin. A small file that has no partner stays.
    """
    small = [f for f in files if f.rows < SMALL * rows_per_file]
    bins: list[list[SourceFile]] = []
    if keep_order:
        held: list[SourceFile] = []
        for f in sorted(files, key=lambda f: f.name):
            if f.rows >= SMALL * rows_per_file or sum(x.rows for x in held) + f.rows > rows_per_file:
                bins.append(held)
                held = []
            if f.rows < SMALL * rows_per_file:
                held.append(f)
        bins.append(held)
    else:
        room: list[int] = []
        for f in sorted(small, key=lambda f: (-f.rows, f.name)):
            fitting = [i for i, r in enumerate(room) if r >= f.rows]
            if fitting:
                best = min(fitting, key=lambda i: (room[i], i))
                bins[best].append(f)
                room[best] -= f.rows
            else:
                bins.append([f])
                room.append(rows_per_file - f.rows)
    bins = [b for b in bins if len(b) > 1 or (b and not b[0].rows)]
    return bins + [[f] for f in files if f.rows > rows_per_file]


def source_files(spark: SparkSession, path: str) -> list[SourceFile]:
    """Data files of a folder: one row each, from the listing and the footers."""
    found = [c for c in children(spark, path) if c.endswith(".parquet")]
    if not found:
        return []
    rows = spark.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("name"), F.col("_metadata.file_size").alias("size")).count()
    counted = {r.name: SourceFile(r.name, r["count"], r.size) for r in rows.collect()}
    return [counted.get(name, SourceFile(name, 0, 0)) for name in sorted(found)]


def compact_in_place(
    spark: SparkSession, path: str, rows_per_file: int, keep_order: bool = False, compress: bool = False
) -> Compaction:
    """Bring a folder's files to at most ``rows_per_file`` rows, writing again only those that do not fit.

    Rows of a file stay together and in their order, next to those of the files in its bin. A folder with a ledger of versions is
    refused, as versions name files.
    """
    path = path.rstrip("/")
    if rows_per_file < 1:
        raise ValueError("a file needs at least one row")
    if exists(spark, f"{path}/_versions"):
        raise ValueError(f"{path} has versions; use extract_delta and vacuum")
    _finish(spark, path)
    files = source_files(spark, path)
    bins = plan_bins(files, rows_per_file, keep_order)
    rewritten = [f for b in bins for f in b]
    if not rewritten:
        return Compaction(len(files), len(files), len(files), 0, 0)
    data = [f for f in rewritten if f.rows]
    staged = f"{path}/.compaction-{uuid.uuid4().hex}"
    new: list[tuple[str, str]] = []
    try:
        if data:
            rows = sum(f.rows for f in data)
            filled = [held for held in ([f for f in b if f.rows] for b in bins) if held]
            write_extract(_packed(spark, path, filled, rows_per_file), staged, compress)
            written = source_files(spark, staged)
            if sum(f.rows for f in written) != rows or max(f.rows for f in written) > rows_per_file:
                raise RuntimeError(f"{path}: {rows} rows to write again, {sum(f.rows for f in written)} written")
            names = [f"{b[0].name.removesuffix('.parquet')}.{i:04d}.parquet" for b in filled for i in range(_parts(b, rows_per_file))]
            new = [(f.name, names[int(f.name.split("-")[1])]) for f in written if f.rows]
        journal = [("old", f.name, f.name) for f in rewritten] + [("new", *n) for n in new]
        noted = f"{staged}/_journal"
        spark.createDataFrame([(*entry, staged.rpartition("/")[2]) for entry in journal], "kind string, name string, target string, folder string").coalesce(1).write.parquet(noted)
        replace_dir(spark, noted, f"{path}/{JOURNAL}")
    except BaseException:
        if not exists(spark, f"{path}/{JOURNAL}"):
            remove_dir(spark, staged)
        raise
    _finish(spark, path)
    kept = len(files) - len(rewritten)
    return Compaction(len(files), kept + len(new), kept, sum(f.rows for f in rewritten), sum(f.size for f in rewritten))


def _parts(held: Sequence[SourceFile], rows_per_file: int) -> int:
    return -(-sum(f.rows for f in held) // rows_per_file)


def _packed(spark: SparkSession, path: str, bins: Sequence[Sequence[SourceFile]], rows_per_file: int) -> DataFrame:
    """Rows of the files to write again, each bin in partitions of equal rows, in the order of the bin."""
    targets, first = [], 0
    for b in bins:
        total, parts, before = sum(f.rows for f in b), _parts(b, rows_per_file), 0
        for f in b:
            targets.append((f.name, first, before, -(-total // parts)))
            before += f.rows
        first += parts
    data = spark.read.parquet(*[f"{path}/{t[0]}" for t in targets])
    name, place, target, number = unused(data.columns, "name", "place", "target", "number")
    # one row per file that is written again
    plan = F.broadcast(spark.createDataFrame(targets, "of_file string, first bigint, before bigint, size bigint"))
    at = data.select("*", F.col("_metadata.file_name").alias(name), F.col("_metadata.row_index").alias(place))
    joined = at.join(plan, F.col(name) == F.col("of_file")).withColumn(number, F.col("before") + F.col(place))
    joined = joined.withColumn(target, (F.col("first") + F.call_function("div", F.col(number), F.col("size"))).cast("int"))
    return joined.repartitionById(first, F.col(target)).sortWithinPartitions(number).select(*columns(data.columns))


def _finish(spark: SparkSession, path: str) -> None:
    """Swap the files of a journal: old ones away first, then new ones in. Each step can be repeated."""
    if not exists(spark, f"{path}/{JOURNAL}"):
        return
    entries = spark.read.parquet(f"{path}/{JOURNAL}").collect()
    folder = entries[0].folder
    for e in entries:
        if e.kind == "old":
            remove_dir(spark, f"{path}/{e.name}")
    for e in entries:
        if e.kind == "new" and exists(spark, f"{path}/{folder}/{e.name}"):
            move_file(spark, f"{path}/{folder}/{e.name}", f"{path}/{e.target}")
    remove_dir(spark, f"{path}/{JOURNAL}")
    remove_dir(spark, f"{path}/{folder}")
