"""One-pass facts about a table: rows, key bounds, column statistics."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T

from tablehaul.names import column, quoted


@dataclass(frozen=True)
class KeyProfile:
    """Row count, bounds of the leading key column, NULLs in the key column with the most."""

    rows: int
    lo: int | None
    hi: int | None
    null_keys: int

    @property
    def span(self) -> int:
        return 0 if self.lo is None else self.hi - self.lo + 1


def check_keys(df: DataFrame, keys: Sequence[str]) -> None:
    """Keys must name columns of the table, and all be of integer type."""
    types = {f.name: f.dataType for f in df.schema.fields}
    missing = [k for k in keys if k not in types]
    if missing:
        raise ValueError(f"key columns not in the table: {missing}")
    other = [k for k in keys if not isinstance(types[k], T.IntegralType)]
    if other:
        raise ValueError(f"key columns must be integers: {other}")


def profile_frame(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row ``n, lo, hi, null_keys``; the scan reads the key columns only.

    Plain COUNT, MIN and MAX, which sources with aggregate pushdown answer from
    their own statistics (Parquet footers, a database).
    """
    check_keys(df, keys)
    if not keys:
        nothing = F.lit(None).cast("bigint")
        return df.agg(F.count(F.lit(1)).alias("n")).select(
            "n", nothing.alias("lo"), nothing.alias("hi"), F.lit(0).cast("bigint").alias("null_keys")
        )
    present = [F.count(column(k)).alias(f"present_{i}") for i, k in enumerate(keys)]
    facts = df.agg(
        F.count(F.lit(1)).alias("n"), F.min(column(keys[0])).alias("lo"), F.max(column(keys[0])).alias("hi"), *present
    )
    nulls = [F.col("n") - F.col(f"present_{i}") for i in range(len(keys))]
    return facts.select(
        "n",
        F.col("lo").cast("bigint").alias("lo"),
        F.col("hi").cast("bigint").alias("hi"),
        (F.greatest(*nulls) if len(nulls) > 1 else nulls[0]).alias("null_keys"),
    )


def profile_key(df: DataFrame, keys: Sequence[str] = ()) -> KeyProfile:
    """Profile as a value. A NULL in the key is an error: no range would hold it."""
    row = profile_frame(df, keys).first()
    if row["null_keys"]:
        raise ValueError(f"at least {row['null_keys']} rows have a NULL in key {list(keys)}")
    return KeyProfile(row["n"], row["lo"], row["hi"], row["null_keys"])


def column_stats(df: DataFrame) -> DataFrame:
    """Per column: position, rows, share of NULLs, average text length (text columns).

    All columns are measured in one aggregate, whose single row then becomes one
    row per column.
    """
    measures, rows = ["count(1) AS n"], []
    for i, field in enumerate(df.schema.fields):
        name = quoted(field.name)
        label = field.name.replace("\\", "\\\\").replace("'", "\\'")
        length = "CAST(NULL AS DOUBLE)"
        measures.append(f"count({name}) AS present_{i}")
        if isinstance(field.dataType, T.StringType):
            measures.append(f"avg(length({name})) AS length_{i}")
            length = f"length_{i}"
        rows.append(
            f"named_struct('position', {i}, 'column_name', '{label}', 'n', n, "
            f"'null_ratio', try_divide(n - present_{i}, n), 'avg_length', {length})"
        )
    return df.selectExpr(*measures).selectExpr(f"inline(array({', '.join(rows)}))")
