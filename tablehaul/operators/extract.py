"""Extract one table, or many, to Parquet."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import astuple, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tablehaul.functions.coerce import coerce_table
from tablehaul.names import columns, quoted
from tablehaul.operators.reconcile import reconcile
from tablehaul.plans.catalog import Catalog, declared_schema_of, for_table, has_text_blob as marked_text_blob, keys_of, resolve_columns
from tablehaul.plans.profile import KeyProfile, profile_key
from tablehaul.plans.ranges import heaviest_range, plan_key_predicates, plan_ranges, range_predicates
from tablehaul.plans.strategy import EMPTY, UNKEYED, partitions_for, rows_per_file, strategy_of
from tablehaul.sources.files import exists, move_parts, remove_dir, replace_dir, total_bytes
from tablehaul.sources.jdbc import (
    DEFAULT_CONNECTIONS,
    check_jdbc_keys,
    count_jdbc,
    profile_jdbc,
    read_jdbc_all,
    read_jdbc_by_key_range,
)
from tablehaul.sources.parquet import write_extract
from tablehaul.sources.tables import default_partitions, enough_partitions, partitions_are_ranges, read_by_key_range

@dataclass(frozen=True)
class ExtractStats:
    table_name: str
    strategy: str
    rows: int
    seconds: float
    megabytes: float
    rows_per_second: float
    path: str | None


STATS_SCHEMA = (
    "table_name string, strategy string, rows bigint, seconds double, "
    "megabytes double, rows_per_second double, path string"
)


def _final_path(spark: SparkSession, out_dir: str, table: str, overwrite: bool) -> str:
    final = f"{out_dir.rstrip('/')}/{table.lower()}.parquet"
    if not overwrite and exists(spark, final):
        raise FileExistsError(final)
    return final


def _nothing(table: str, started: float) -> ExtractStats:
    return ExtractStats(table, EMPTY, 0, time.monotonic() - started, 0.0, 0.0, None)


def _store(
    waves: Sequence[DataFrame],
    final: str,
    compress: bool,
    file_rows: int | None,
    expected: int | None,
    verify: Callable[[DataFrame], None] | None = None,
) -> tuple[int, float]:
    """Write beside ``final``, wave after wave, check, then move; returns rows and megabytes. Files are numbered through."""
    spark = waves[0].sparkSession
    folder, _, name = final.rpartition("/")
    unfinished = f"{folder}/.{name}-{uuid.uuid4().hex}"
    try:
        written = first = 0
        for i, rows in enumerate(waves):
            counted = Observation(f"extract-{uuid.uuid4().hex}")
            target = unfinished if len(waves) == 1 else f"{unfinished}/.wave-{i}"
            write_extract(rows.observe(counted, F.count(F.lit(1)).alias("rows")), target, compress, file_rows)
            written += counted.get["rows"]
            if len(waves) > 1:
                first = move_parts(spark, target, unfinished, first)
        back = spark.read.schema(waves[0].schema).parquet(unfinished)
        stored = back.count()
        if written != stored or expected not in (None, stored):
            raise RuntimeError(f"{final}: {expected} rows in source, {written} written, {stored} stored")
        if verify:
            verify(back)
        megabytes = total_bytes(spark, unfinished) / 2**20
    except BaseException:
        remove_dir(spark, unfinished)
        raise
    replace_dir(spark, unfinished, final)
    return written, megabytes


def run_extract(
    source: DataFrame,
    table: str,
    out_dir: str,
    keys: Sequence[str] = (),
    n: int | None = None,
    strategy: str | None = None,
    declared_schema: Mapping[str, str] | None = None,
    charset: str | None = None,
    has_text_blob: bool | None = None,
    compress: bool = False,
    single_file: bool = False,
    overwrite: bool = False,
    check_keys: bool = False,
    presorted: bool = False,
) -> ExtractStats:
    """Profile, choose a strategy, read, coerce, write and count one table.

    The result is a folder ``<out_dir>/<table lower-cased>.parquet`` that appears
    only when complete: files go to a sibling folder first, their footers must
    hold as many rows as the source, and then the folder is moved. Any failure
    raises and leaves an earlier extract as it was. An empty table writes nothing.
    ``strategy='unkeyed'`` skips the shuffle where key order is not wanted, and
    ``presorted`` where the source's files are in key order already: if its scan's
    partitions turn out to be disjoint key ranges, they are kept as they are.
    ``check_keys`` also reconciles every key before the move; it does not compare other columns (``reconcile`` can).
    ``single_file`` reads and writes through one task, whatever the size: its cost is the caller's to judge.
    ``n``: ranges at least; a table whose ranges would be too large to sort in one task gets more.
    Without ``has_text_blob`` the mark in the source's schema decides.
    """
    started = time.monotonic()
    final = _final_path(source.sparkSession, out_dir, table, overwrite)
    wanted = [] if strategy == UNKEYED else list(keys)
    if has_text_blob is None:
        has_text_blob = marked_text_blob(source)

    profile = profile_key(source, wanted)
    chosen = strategy_of(profile.rows, len(wanted), strategy)
    if chosen == EMPTY:
        return _nothing(table, started)
    if chosen != UNKEYED and not wanted:
        raise ValueError(f"strategy {chosen!r} needs a key")

    rows = source
    if chosen != UNKEYED and presorted and partitions_are_ranges(source, wanted, profile):
        rows = source.sortWithinPartitions(*columns(wanted))
    elif chosen != UNKEYED:
        parts = enough_partitions(source, n, profile.rows) if n else default_partitions(source, profile.rows, has_text_blob)
        rows = read_by_key_range(source, wanted, parts, profile)
    rows = coerce_table(rows, declared_schema, charset)
    if single_file:
        rows = rows.coalesce(1)

    def same_keys(back: DataFrame) -> None:
        report = reconcile(source, back, wanted).first()
        if report["duplicate_rows"] or report["missing_rows"] or report["extra_rows"]:
            raise RuntimeError(f"{table}: extract differs from source: {report.asDict()}")

    written, megabytes = _store(
        [rows],
        final,
        compress,
        None if single_file else rows_per_file(profile.rows, has_text_blob),
        profile.rows,
        same_keys if check_keys and wanted else None,
    )
    seconds = time.monotonic() - started
    return ExtractStats(table, chosen, written, seconds, megabytes, written / seconds, final)


def run_extract_jdbc(
    spark: SparkSession,
    url: str,
    table: str | Sequence[str],
    out_dir: str,
    keys: Sequence[str] = (),
    n: int | None = None,
    balanced: bool | None = None,
    strategy: str | None = None,
    declared_schema: Mapping[str, str] | None = None,
    charset: str | None = None,
    has_text_blob: bool = False,
    compress: bool = False,
    overwrite: bool = False,
    properties: Mapping[str, str] | None = None,
    quote: str = '"',
    predicates: Sequence[str] | None = None,
    connections: int = DEFAULT_CONNECTIONS,
    quiet_source: bool = True,
) -> ExtractStats:
    """The same job from a relational source: one connection per range, no shuffle.

    The source counts and bounds the key itself; keys must be integers by the reader's schema. Without ``n`` a
    range holds about one file of rows. Each range is read, sorted and written by a task of its own, so a lost task repeats one
    range. At most ``connections`` ranges are read at a time, whatever the cluster's size: ranges are written in waves
    of that many, one job each. ``balanced`` reads the
    key columns alone first and cuts ranges of equal rows; left open, that is done where
    counts over the key column show a range with over twice its share. For an unkeyed table the
    caller may give disjoint ``predicates`` that cover it. Afterwards the source is counted again: if
    ``quiet_source`` holds, rows before, after, read and stored must be equal; else what was read must be what was stored.
    """
    started = time.monotonic()
    label = table if isinstance(table, str) else table[-1]
    final = _final_path(spark, out_dir, label, overwrite)
    wanted = [] if strategy == UNKEYED else list(keys)
    if wanted:
        check_jdbc_keys(read_jdbc_all(spark, url, table, properties, quote), wanted)
    profile = profile_jdbc(spark, url, table, wanted[0] if wanted else None, properties, quote)
    chosen = strategy_of(profile.rows, len(wanted), strategy)
    if chosen == EMPTY:
        return _nothing(label, started)
    n = n or partitions_for(profile.rows, None, has_text_blob, connections)
    if chosen != UNKEYED:
        if not wanted:
            raise ValueError(f"strategy {chosen!r} needs a key")
        if predicates is None:
            predicates = _jdbc_predicates(spark, url, table, wanted, profile, n, balanced, properties, quote, connections)
        if predicates is None:
            predicates = range_predicates(quoted(wanted[0], quote), plan_ranges(profile.lo, profile.hi, n), open_ended=True)

    def wave(part: Sequence[str] | None) -> DataFrame:
        rows = read_jdbc_all(spark, url, table, properties, quote, part)
        return coerce_table(rows.sortWithinPartitions(*columns(wanted)) if wanted else rows, declared_schema, charset)

    waves = [wave(predicates[i : i + connections]) for i in range(0, len(predicates), connections)] if predicates else [wave(None)]

    def unchanged(back: DataFrame) -> None:
        after, stored = count_jdbc(spark, url, table, properties, quote), back.count()
        if not profile.rows == after == stored:
            raise RuntimeError(f"{label}: {profile.rows} rows before, {after} after, {stored} read and stored")

    written, megabytes = _store(
        waves, final, compress, rows_per_file(profile.rows, has_text_blob), None, unchanged if quiet_source else None
    )
    seconds = time.monotonic() - started
    return ExtractStats(label, chosen, written, seconds, megabytes, written / seconds, final)


def _limited(rows: DataFrame, connections: int) -> DataFrame:
    """At most ``connections`` tasks, each reading the keys of its ranges one after the other over one connection at a time."""
    return rows.coalesce(connections)


def _jdbc_predicates(
    spark: SparkSession,
    url: str,
    table: str | Sequence[str],
    keys: Sequence[str],
    profile: KeyProfile,
    n: int,
    balanced: bool | None,
    properties: Mapping[str, str] | None,
    quote: str,
    connections: int,
) -> list[str] | None:
    """Balanced predicates where they are asked for or needed, else None for equal-width ranges."""
    if balanced is False or n == 1:
        return None
    read = read_jdbc_by_key_range(spark, url, table, keys, profile, n=n, properties=properties, quote=quote, ordered=False)
    key_rows = _limited(read.select(*columns(keys)), connections)
    if balanced is None and heaviest_range(key_rows, keys[0], n, profile) <= 2 * -(-profile.rows // min(n, profile.span)):
        return None
    return plan_key_predicates(key_rows, keys, n, quote, profile)


def extract_table_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    out_dir: str,
    catalog: Catalog,
    properties: Mapping[str, str] | None = None,
    quote: str = '"',
    charset: str | None = None,
    **options,
) -> ExtractStats:
    """From a table's name to its extract: key, types and long text come from the source's catalog (``read_catalog``).

    A name that the catalog does not have is an error. Its types only widen what the connector delivers.
    """
    found = resolve_columns(catalog)
    keys = keys_of(catalog, found, table)
    stored = for_table(found, table).select("relation_name", "is_text_blob").collect()
    name = stored[0]["relation_name"]
    delivered = read_jdbc_all(spark, url, name, properties, quote)
    declared = declared_schema_of(found, table, delivered, charset)
    return run_extract_jdbc(
        spark, url, name, out_dir, keys, declared_schema=declared, charset=charset,
        has_text_blob=any(r["is_text_blob"] for r in stored), properties=properties, quote=quote, **options,
    )


def run_extracts(jobs: Sequence[Callable[[], ExtractStats]], at_once: int = 4) -> list[ExtractStats]:
    """Several extracts with a few in flight, so small tables do not idle the cluster."""
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        return list(pool.map(lambda job: job(), jobs))


def extract_stats(spark: SparkSession, stats: Sequence[ExtractStats]) -> DataFrame:
    """One row per extracted table."""
    return spark.createDataFrame([astuple(s) for s in stats], STATS_SCHEMA)
