"""How to read a table and how large its files should be."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

EMPTY, SINGLE_KEY, LEADING_KEY, KEY_ORDER, UNKEYED = (
    "empty",
    "single_key",
    "leading_key",
    "key_order",
    "unkeyed",
)
# what a caller may ask for; only the row count says that a table is empty
CHOICES = (SINGLE_KEY, LEADING_KEY, KEY_ORDER, UNKEYED)

# Composite keys above this many rows are read by leading key.
BIG_TABLE_ROWS = 10_000_000

# Rows per batch by table size (rows below the bound, batch), the
# batch beyond the last bound, and the floor.
BATCH_STEPS = ((200_000, 250_000), (10_000_000, 500_000), (50_000_000, 750_000))
BATCH_TOP = 1_000_000
BATCH_FLOOR = 100_000

MIN_PARTITION_ROWS = 10_000
PARTITION_BYTES = 256 * 1024 * 1024
# compressed columnar bytes, unpacked into rows
GROWTH = 4


def strategy_of(rows: int, key_columns: int, override: str | None = None) -> str:
    if override is not None:
        if override not in CHOICES:
            raise ValueError(f"unknown strategy {override!r}; use one of {CHOICES}")
        return EMPTY if rows == 0 else override
    if rows == 0:
        return EMPTY
    if key_columns == 0:
        return UNKEYED
    if key_columns == 1:
        return SINGLE_KEY
    return LEADING_KEY if rows > BIG_TABLE_ROWS else KEY_ORDER


def strategy_column(rows: Column, key_columns: Column) -> Column:
    return (
        F.when(rows == 0, EMPTY)
        .when(F.coalesce(key_columns, F.lit(0)) == 0, UNKEYED)
        .when(key_columns == 1, SINGLE_KEY)
        .when(rows > BIG_TABLE_ROWS, LEADING_KEY)
        .otherwise(KEY_ORDER)
    )


def rows_per_file(rows: int, has_text_blob: bool = False) -> int:
    """Rows of one output file, by the size of the table."""
    batch = next((size for bound, size in BATCH_STEPS if rows < bound), BATCH_TOP)
    if has_text_blob:
        batch = batch * 2 // 3
    return max(batch, BATCH_FLOOR)


def batch_rows_column(rows: Column, has_text_blob: Column) -> Column:
    step = F.lit(BATCH_TOP)
    for bound, size in reversed(BATCH_STEPS):
        step = F.when(rows < bound, F.lit(size)).otherwise(step)
    reduced = F.when(has_text_blob, F.call_function("div", step * F.lit(2), F.lit(3))).otherwise(step)
    return F.greatest(reduced, F.lit(BATCH_FLOOR).cast("bigint")).cast("bigint")


def choose_strategy(profiles: DataFrame) -> DataFrame:
    """Adds ``strategy`` and ``batch_rows`` to one row per table.

    Expects ``n``, ``key_size`` (0 or NULL for no usable key) and ``has_text_blob``.
    """
    return profiles.withColumn("strategy", strategy_column(F.col("n"), F.col("key_size"))).withColumn(
        "batch_rows", batch_rows_column(F.col("n"), F.col("has_text_blob"))
    )


def partition_rows(rows: int, source_bytes: int | None) -> int:
    """Rows of this table that suit one task: a row group at most, fewer if they are wide."""
    if not source_bytes:
        return BATCH_TOP
    return min(BATCH_TOP, max(1, rows * PARTITION_BYTES // (source_bytes * GROWTH)))


def partitions_for(rows: int, source_bytes: int | None, has_text_blob: bool, cores: int) -> int:
    """Shuffle partitions for a whole-table rewrite: sized by rows and by bytes.

    Both matter: a few million long texts fill an executor that the same number of
    narrow rows would not. Partitions aim below the file size, so that a slightly
    larger one does not spill into a second, tiny file. Smaller tables spread over the cores, but not into tiny files.
    """
    if rows == 0:
        return 1
    by_rows = -(-rows * 5 // (4 * rows_per_file(rows, has_text_blob)))
    by_bytes = -(-(source_bytes or 0) * GROWTH // PARTITION_BYTES)
    by_cores = min(cores, -(-rows // MIN_PARTITION_ROWS))
    return max(1, min(max(by_rows, by_bytes, by_cores), rows))
