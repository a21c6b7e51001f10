"""Extract relational tables to Parquet in parallel, each row exactly once."""

from tablehaul.functions.coerce import coerce_column, coerce_table
from tablehaul.operators.digests import reconcile_tree, write_digests
from tablehaul.operators.directory import page_from_directory, write_directory
from tablehaul.operators.extract import (
    ExtractStats,
    extract_stats,
    extract_table_jdbc,
    run_extract,
    run_extract_jdbc,
    run_extracts,
)
from tablehaul.operators.paging import page, read_in_key_order, with_page_number, with_row_number
from tablehaul.operators.reconcile import key_balance, reconcile
from tablehaul.operators.versions import extract_delta, ledger, read_version, run_extract_resumable, vacuum, versions
from tablehaul.plans.catalog import (
    Catalog,
    declared_schema_of,
    describe_tables,
    detect_keys,
    for_table,
    keys_of,
    mark_text_blobs,
    resolve_columns,
    text_blob_tables,
)
from tablehaul.plans.balance import plan_leaves
from tablehaul.plans.discovery import discover_keys, key_uniqueness
from tablehaul.plans.profile import KeyProfile, column_stats, profile_frame, profile_key
from tablehaul.plans.ranges import (
    KeyRange,
    assign_range,
    plan_balanced_ranges,
    plan_chunks,
    plan_key_predicates,
    plan_ranges,
    range_counts,
    range_id,
    range_predicates,
    ranges_frame,
)
from tablehaul.plans.sketches import column_sketches, heavy_values, merge_sketches, read_sketches, sketch_columns
from tablehaul.plans.strategy import choose_strategy, rows_per_file, strategy_of
from tablehaul.sources.compaction import Compaction, compact_in_place
from tablehaul.sources.datasource import register_key_ranges
from tablehaul.sources.files import clear_work
from tablehaul.sources.jdbc import profile_jdbc, read_catalog, read_jdbc_all, read_jdbc_by_key_range
from tablehaul.sources.parquet import compact, write_extract
from tablehaul.sources.tables import read_all, read_by_key_range, register_source

__all__ = [name for name in dir() if not name.startswith("_")]
