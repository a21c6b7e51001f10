"""Relational sources over JDBC: one connection per key range.

The driver, URL and credentials are the caller's; ``properties`` are passed on.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, types as T

from tablehaul.names import quoted
from tablehaul.plans.catalog import Catalog
from tablehaul.plans.profile import KeyProfile
from tablehaul.plans.ranges import KeyRange, plan_ranges, range_predicates

DEFAULT_CONNECTIONS = 8
DEFAULT_FETCH_ROWS = 10_000


def table_name(table: str | Sequence[str], quote: str = '"') -> str:
    """Quoted table name; give a schema as ``("schema", "table")``."""
    parts = [table] if isinstance(table, str) else table
    return ".".join(quoted(p, quote) for p in parts)


def _settings(properties: Mapping[str, str] | None) -> dict[str, str]:
    return {"fetchsize": str(DEFAULT_FETCH_ROWS), **(properties or {})}


def profile_query(table: str | Sequence[str], key: str | None, quote: str = '"') -> str:
    """Count and key bounds as one statement that the source itself evaluates."""
    name = table_name(table, quote)
    if key is None:
        return f"SELECT COUNT(*) AS n FROM {name}"
    k = quoted(key, quote)
    return f"SELECT COUNT(*) AS n, MIN({k}) AS lo, MAX({k}) AS hi, COUNT({k}) AS keyed FROM {name}"


def profile_jdbc(
    spark: SparkSession,
    url: str,
    table: str | Sequence[str],
    key: str | None = None,
    properties: Mapping[str, str] | None = None,
    quote: str = '"',
) -> KeyProfile:
    """Table profile computed in the source, not by pulling rows."""
    reader = spark.read.format("jdbc").option("url", url).options(**_settings(properties))
    row = reader.option("query", profile_query(table, key, quote)).load().first()
    if key is None:
        return KeyProfile(int(row[0]), None, None, 0)
    n, lo, hi, keyed = row
    if keyed != n:
        raise ValueError(f"{n - keyed} rows of {table} have a NULL in key {key}")
    if any(bound is not None and bound != int(bound) for bound in (lo, hi)):
        raise ValueError(f"key {key} of {table} is not an integer: {lo} to {hi}")
    return KeyProfile(int(n), None if lo is None else int(lo), None if hi is None else int(hi), 0)


def is_integer_key(data_type: T.DataType) -> bool:
    """Integers, and decimals without a fraction, as some databases deliver their integers."""
    return isinstance(data_type, T.IntegralType) or (isinstance(data_type, T.DecimalType) and data_type.scale == 0)


def check_jdbc_keys(df: DataFrame, keys: Sequence[str]) -> None:
    """Ranges of integers leave out what lies between them, so keys must be integers by the reader's own schema."""
    types = {f.name: f.dataType for f in df.schema.fields}
    missing = [k for k in keys if k not in types]
    if missing:
        raise ValueError(f"key columns not in the table: {missing}")
    other = {k: types[k].simpleString() for k in keys if not is_integer_key(types[k])}
    if other:
        raise ValueError(f"key columns must be integers: {other}")


def count_jdbc(
    spark: SparkSession, url: str, table: str | Sequence[str], properties: Mapping[str, str] | None = None, quote: str = '"'
) -> int:
    return profile_jdbc(spark, url, table, None, properties, quote).rows


def read_catalog(
    spark: SparkSession, url: str, queries: Mapping[str, str], properties: Mapping[str, str] | None = None
) -> Catalog:
    """Catalog frames from one query each, named after the fields of :class:`Catalog`."""
    missing = [name for name in Catalog._fields if name not in queries]
    if missing:
        raise ValueError(f"no query for catalog frames: {missing}")
    reader = spark.read.format("jdbc").option("url", url).options(**_settings(properties))
    return Catalog(*[reader.option("query", queries[name]).load() for name in Catalog._fields])


def read_jdbc_by_key_range(
    spark: SparkSession,
    url: str,
    table: str | Sequence[str],
    keys: Sequence[str],
    profile: KeyProfile,
    ranges: Sequence[KeyRange] | None = None,
    n: int = DEFAULT_CONNECTIONS,
    properties: Mapping[str, str] | None = None,
    quote: str = '"',
    ordered: bool = True,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """One partition and one connection per range, each sorted by all keys if ``ordered``.

    ``ranges`` may come from any plan of the leading key; ``predicates`` replace them
    where the plan uses several key columns. The outer bounds are open, so rows
    that arrived after the profile are read as well.
    """
    if predicates is None:
        if ranges is None:
            ranges = [] if profile.lo is None else plan_ranges(profile.lo, profile.hi, n)
        predicates = range_predicates(quoted(keys[0], quote), ranges, open_ended=True)
    df = read_jdbc_all(spark, url, table, properties, quote, predicates)
    check_jdbc_keys(df, keys)
    return df.sortWithinPartitions(*keys) if ordered else df


def read_jdbc_all(
    spark: SparkSession,
    url: str,
    table: str | Sequence[str],
    properties: Mapping[str, str] | None = None,
    quote: str = '"',
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """Whole table in one scan, or one partition per caller-given disjoint predicate."""
    name = table_name(table, quote)
    if predicates:
        return spark.read.jdbc(url, name, predicates=list(predicates), properties=_settings(properties))
    return spark.read.jdbc(url, name, properties=_settings(properties))
