"""Mergeable summaries of all columns in one pass: distinct values, frequent values, NULLs.

A sketch row holds, for one column, counts, a HyperLogLog sketch and a frequent-items sketch. Sketches of
parts of a table (files, days, key ranges) can be kept and merged later without reading the rows again.

Values are tracked as text: short text as it is, text longer than ``LONG_TEXT`` characters, bytes and nested values by
their SHA-256, so a sketch is bounded whatever the values are. ``1.0`` and ``1`` of one column do not meet, as a column has one type.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tablehaul.names import column

# Values a frequent-items sketch tracks; its table is the next power of two above 4/3 of them.
ITEMS = 1024
LOG_BUCKETS = 14
LONG_TEXT = 64

# Four standard errors of a distinct count.
DISTINCT_ERROR = 4 * 1.04 / math.sqrt(1 << LOG_BUCKETS)
# A count is off by at most this share of the rows, and values of twice this share are always listed.
COUNT_ERROR = 3.5 / (1 << math.ceil(math.log2(ITEMS / 0.75)))

# A value with this share of the rows makes a column skewed; a dictionary pays if values come so often on average.
SKEWED_SHARE = 0.1
DICTIONARY_REPEATS = 4

_STATE = ("position", "column_name", "n", "present", "distinct_state", "heavy_state")


def as_item(field: T.StructField, value: Column | None = None) -> Column:
    """A column's values as sketches track them."""
    value = column(field.name) if value is None else value
    kind = field.dataType
    if isinstance(kind, T.StringType):
        return F.when(F.length(value) <= LONG_TEXT, value).otherwise(F.concat(F.lit("sha256:"), F.sha2(value.cast("binary"), 256)))
    if isinstance(kind, T.BinaryType):
        return F.concat(F.lit("sha256:"), F.sha2(value, 256))
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return F.when(value.isNotNull(), F.concat(F.lit("sha256:"), F.sha2(F.to_json(F.struct(value.alias("v"))).cast("binary"), 256)))
    return value.cast("string")


def _groups(df: DataFrame) -> int:
    return math.isqrt(max(df.rdd.getNumPartitions() - 1, 0)) + 1


def sketch_columns(df: DataFrame) -> DataFrame:
    """One sketch row per column of ``df``, from one pass.

    Partitions are merged in two steps, in about as many groups as each group has partitions, so no task meets the
    sketches of all of them.
    """
    fields = df.schema.fields
    items = [as_item(f).alias(f"v{i}") for i, f in enumerate(fields)]
    group = F.pmod(F.spark_partition_id(), F.lit(_groups(df)))
    rows = df.select(group.alias("part"), *items)
    measures = [F.count(F.lit(1)).alias("n")]
    for i in range(len(fields)):
        measures += [
            F.count(f"v{i}").alias(f"present_{i}"),
            F.hll_sketch_agg(f"v{i}", F.lit(LOG_BUCKETS)).alias(f"distinct_{i}"),
            F.expr(f"approx_top_k_accumulate(v{i}, {ITEMS})").alias(f"heavy_{i}"),
        ]
    parts = rows.groupBy("part").agg(*measures)
    each = [
        F.struct(
            F.lit(i).alias("position"), F.lit(f.name).alias("column_name"), F.col("n"), F.col(f"present_{i}").alias("present"),
            F.col(f"distinct_{i}").alias("distinct_state"), F.col(f"heavy_{i}").alias("heavy_state"),
        )
        for i, f in enumerate(fields)
    ]
    return merge_sketches(parts.select(F.inline(F.array(*each))))


def merge_sketches(states: DataFrame) -> DataFrame:
    """One sketch row per column from those of several parts of a table; column names and positions must agree."""
    return states.groupBy("position", "column_name").agg(
        F.sum("n").alias("n"),
        F.sum("present").alias("present"),
        F.hll_union_agg("distinct_state").alias("distinct_state"),
        F.expr(f"approx_top_k_combine(heavy_state, {ITEMS})").alias("heavy_state"),
    ).select(*_STATE)


def read_sketches(states: DataFrame) -> DataFrame:
    """``position, column_name, n, n_null, n_distinct, heavy, count_error, dictionary, skewed`` of sketch rows.

    ``n_distinct`` is an estimate (``DISTINCT_ERROR``); ``heavy`` lists (value, n) by falling n, each off by at most ``count_error``
    rows, and holds every value of more than twice as many. A table without rows has zeros and empty lists.
    """
    listed = F.filter(F.expr(f"approx_top_k_estimate(heavy_state, {ITEMS})"), lambda h: h["item"].isNotNull())
    heavy = F.transform(listed, lambda h: F.struct(h["item"].alias("value"), h["count"].alias("n")))
    error = F.ceil(F.col("n") * F.lit(COUNT_ERROR)).cast("bigint")
    read = states.select(
        "position", "column_name", "n", (F.col("n") - F.col("present")).alias("n_null"), "present",
        F.hll_sketch_estimate("distinct_state").alias("n_distinct"), heavy.alias("heavy"), error.alias("count_error"),
    )
    top = F.coalesce(F.get("heavy", F.lit(0))["n"] - F.col("count_error"), F.lit(0))
    return read.select(
        "position", "column_name", "n", "n_null", "n_distinct", "heavy", "count_error",
        (F.col("n_distinct") * (1 + DISTINCT_ERROR) * DICTIONARY_REPEATS <= F.col("present")).alias("dictionary"),
        (top > SKEWED_SHARE * F.col("n")).alias("skewed"),
    )


def column_sketches(df: DataFrame) -> DataFrame:
    """Distinct counts and frequent values of all columns in one pass, see :func:`read_sketches`."""
    return read_sketches(sketch_columns(df))


def heavy_values(df: DataFrame, share: float = 0.02, states: DataFrame | None = None) -> DataFrame:
    """``position, column_name, value, n``: exactly the values that at least ``share`` of a column's rows hold, NULL left out.

    Sketches (of ``df``, or given) name the candidates, at most ``1 / (share - 2 * COUNT_ERROR)`` of a column; a second pass counts them.
    """
    if share <= 2 * COUNT_ERROR:
        raise ValueError(f"values of a share of {share} may be missing from sketches; the least is above {2 * COUNT_ERROR}")
    found = read_sketches(sketch_columns(df) if states is None else states)
    near = found.select("position", "column_name", "n", "count_error", F.explode("heavy").alias("h"))
    near = near.where(F.col("h.n") + F.col("count_error") >= share * F.col("n"))
    near = near.select("position", "column_name", F.col("n").alias("n_rows"), F.col("h.value").alias("value"))
    fields = df.schema.fields
    values = F.array(*(F.struct(F.lit(i).alias("position"), as_item(f).alias("value")) for i, f in enumerate(fields)))
    counted = df.select(F.inline(values)).join(F.broadcast(near), ["position", "value"]).groupBy("position", "column_name", "value", "n_rows")
    return counted.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= share * F.col("n_rows")).select("position", "column_name", "value", "n")
