"""Columns, types and keys of all tables at once, from catalog tables.

The catalog frames follow the shape of a relational system catalog, one row per
column, type, index, constraint and index segment:

* ``relation_fields(relation_name, field_name, field_source, field_position)``
* ``fields(field_name, field_type, field_sub_type)``
* ``indices(index_name, relation_name)``
* ``relation_constraints(index_name, constraint_type)``
* ``index_segments(index_name, field_name, field_position)``

Names may be blank-padded. Every function is one set of joins over all tables,
not a query per table or per key column.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tablehaul.functions.coerce import trim_text
from tablehaul.functions.types import INTEGER_CODES, NATIVE, code_of_type, is_text_blob, keeps_values, target_of_code


TEXT_BLOB_FLAG = "is_text_blob"


class Catalog(NamedTuple):
    relation_fields: DataFrame
    fields: DataFrame
    indices: DataFrame
    relation_constraints: DataFrame
    index_segments: DataFrame


def describe_tables(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    keys: Mapping[str, Sequence[str]],
    text_blobs: Collection[tuple[str, str]] = (),
) -> Catalog:
    """Catalog frames for file-backed tables, whose keys are declared by the caller."""
    relation_fields, fields, segments = [], [], []
    for table, df in tables.items():
        for position, field in enumerate(df.schema.fields):
            code, sub = code_of_type(field.dataType, (table, field.name) in text_blobs)
            source = f"{table}.{field.name}"
            relation_fields.append((table, field.name, source, position))
            fields.append((source, code, sub))
    for table, columns in keys.items():
        segments += [(f"pk_{table}", column, i) for i, column in enumerate(columns)]
    return Catalog(
        spark.createDataFrame(
            relation_fields,
            "relation_name string, field_name string, field_source string, field_position int",
        ),
        spark.createDataFrame(fields, "field_name string, field_type int, field_sub_type int"),
        spark.createDataFrame([(f"pk_{t}", t) for t in keys], "index_name string, relation_name string"),
        spark.createDataFrame(
            [(f"pk_{t}", "PRIMARY KEY") for t in keys], "index_name string, constraint_type string"
        ),
        spark.createDataFrame(segments, "index_name string, field_name string, field_position int"),
    )


def _name(column: str) -> Column:
    return trim_text(F.col(column))


def resolve_columns(catalog: Catalog) -> DataFrame:
    """``relation_name, position, column_name, type_code, target_type, is_text_blob``."""
    columns = catalog.relation_fields.select(
        _name("relation_name").alias("relation_name"),
        F.col("field_position").cast("int").alias("position"),
        _name("field_name").alias("column_name"),
        _name("field_source").alias("type_name"),
    )
    types = catalog.fields.select(
        _name("field_name").alias("type_name"),
        F.col("field_type").cast("int").alias("type_code"),
        F.col("field_sub_type").cast("int").alias("sub_type"),
    )
    code, sub = F.col("type_code"), F.col("sub_type")
    return columns.join(types, "type_name", "inner").select(
        "relation_name",
        "position",
        "column_name",
        "type_code",
        target_of_code(code, sub).alias("target_type"),
        is_text_blob(code, sub).alias("is_text_blob"),
    )


def text_blob_tables(columns: DataFrame) -> DataFrame:
    """``relation_name, has_text_blob``; binary blobs do not count."""
    return columns.groupBy("relation_name").agg(F.bool_or("is_text_blob").alias("has_text_blob"))


def detect_keys(catalog: Catalog, columns: DataFrame) -> DataFrame:
    """``relation_name, key_columns, usable`` for tables that declare a primary key.

    ``columns`` is the result of :func:`resolve_columns`. Key columns come in
    segment order; the key is usable if every column is of an integer type.
    """
    primary = catalog.relation_constraints.where(_name("constraint_type") == "PRIMARY KEY").select(
        _name("index_name").alias("index_name")
    )
    keys = (
        catalog.indices.select(
            _name("index_name").alias("index_name"), _name("relation_name").alias("relation_name")
        )
        .join(primary, "index_name", "inner")
        .groupBy("relation_name")
        .agg(F.min("index_name").alias("index_name"))
    )
    segments = catalog.index_segments.select(
        _name("index_name").alias("index_name"),
        _name("field_name").alias("column_name"),
        F.col("field_position").cast("int").alias("segment"),
    )
    typed = keys.join(segments, "index_name", "inner").join(
        columns.select("relation_name", "column_name", "type_code"),
        ["relation_name", "column_name"],
        "left",
    )
    return typed.groupBy("relation_name").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("segment", "column_name"))), lambda s: s["column_name"]
        ).alias("key_columns"),
        F.bool_and(F.coalesce(F.col("type_code").isin(*INTEGER_CODES), F.lit(False))).alias("usable"),
    )


def for_table(frame: DataFrame, table: str) -> DataFrame:
    """Rows of one table; catalogs hold names in upper case, users type them as they like."""
    return frame.where(F.upper("relation_name") == table.strip().upper())


def _known(columns: DataFrame, table: str) -> DataFrame:
    rows = for_table(columns, table)
    if rows.isEmpty():
        raise ValueError(f"the catalog has no table {table!r}")
    return rows


def keys_of(catalog: Catalog, columns: DataFrame, table: str) -> list[str]:
    """Key columns of one table in key order, none if it has no usable key; an error if the catalog does not know it."""
    _known(columns, table)
    found = for_table(detect_keys(catalog, columns), table).where("usable").first()
    return list(found["key_columns"]) if found else []


def declared_schema_of(columns: DataFrame, table: str, source: DataFrame, charset: str | None = None) -> dict[str, str]:
    """Portable types of one table's columns, as :func:`coerce_table` takes them.

    The catalog may only widen what ``source``, as its connector delivers it, holds. Where a type code would lose
    values (a date under a blob code, a boolean under a float code, a scaled decimal under an integer code) the connector's type stays;
    a lossy type needs the caller's own declaration.
    """
    types = {f.name: f.dataType for f in source.schema.fields}
    rows = _known(columns, table).select("column_name", "target_type").collect()
    targets = {r["column_name"]: r["target_type"] for r in rows if r["column_name"] in types}
    return {c: t if keeps_values(types[c], t, charset) else NATIVE for c, t in targets.items()}


def mark_text_blobs(df: DataFrame, columns: Collection[str]) -> DataFrame:
    """Note in the schema which columns hold long text; extracts size their files by it."""
    return df.withColumns({c: F.col(c).alias(c, metadata={TEXT_BLOB_FLAG: True}) for c in columns})


def has_text_blob(df: DataFrame) -> bool:
    return any((f.metadata or {}).get(TEXT_BLOB_FLAG) for f in df.schema.fields)
