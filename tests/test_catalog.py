import pytest

from tablehaul.functions.coerce import coerce_table
from tablehaul.plans.catalog import (
    Catalog,
    declared_schema_of,
    describe_tables,
    detect_keys,
    has_text_blob,
    keys_of,
    mark_text_blobs,
    resolve_columns,
    text_blob_tables,
)


@pytest.fixture(scope="module")
def catalog(spark):
    def pad(name):
        return name.ljust(31)

    types = {
        "D_SMALL": (7, 0), "D_INT": (8, 0), "D_BIG": (16, 0), "D_FLOAT": (10, 0), "D_DOUBLE": (27, 0),
        "D_FLOAT2": (23, 0), "D_MEMO": (12, 1), "D_RAW": (12, 0), "D_CHAR": (14, None), "D_VAR": (37, 0),
        "D_TIME": (35, 0),
    }
    relation_fields = [("ORDERS", f"C{i}", source, i) for i, source in enumerate(types)]
    relation_fields += [("LINES", "LINE_NO", "D_SMALL", 0), ("LINES", "ORDER_ID", "D_BIG", 1), ("LINES", "RAW", "D_RAW", 2)]
    relation_fields += [("CODES", "CODE", "D_CHAR", 0), ("CODES", "N", "D_INT", 1)]
    relation_fields += [("LOGS", "N", "D_INT", 0)]
    relation_fields += [("GONE", "N", "D_NOWHERE", 0)]
    return Catalog(
        spark.createDataFrame(
            [(pad(t), pad(c), pad(s), p) for t, c, s, p in relation_fields],
            "relation_name string, field_name string, field_source string, field_position short",
        ),
        spark.createDataFrame(
            [(pad(s), c, sub) for s, (c, sub) in types.items()],
            "field_name string, field_type short, field_sub_type short",
        ),
        spark.createDataFrame(
            [(pad("PK_O"), pad("ORDERS")), (pad("PK_L"), pad("LINES")), (pad("PK_C"), pad("CODES")), (pad("UQ_G"), pad("LOGS"))],
            "index_name string, relation_name string",
        ),
        spark.createDataFrame(
            [(pad("PK_O"), "PRIMARY KEY"), (pad("PK_L"), "PRIMARY KEY "), (pad("PK_C"), "PRIMARY KEY"), (pad("UQ_G"), "UNIQUE")],
            "index_name string, constraint_type string",
        ),
        spark.createDataFrame(
            [(pad("PK_O"), pad("C1"), 0), (pad("PK_L"), pad("LINE_NO"), 1), (pad("PK_L"), pad("ORDER_ID"), 0),
             (pad("PK_C"), pad("N"), 0), (pad("PK_C"), pad("CODE"), 1), (pad("UQ_G"), pad("N"), 0)],
            "index_name string, field_name string, field_position short",
        ),
    )


def test_columns_types_and_order(catalog):
    rows = resolve_columns(catalog).where("relation_name = 'ORDERS'").orderBy("position").collect()
    assert [r["column_name"] for r in rows] == [f"C{i}" for i in range(11)]
    assert [r["target_type"] for r in rows] == [
        "int64", "int64", "int64", "float64", "float64", "float64", "utf8", "binary", "utf8", "utf8", "native"]
    assert [r["is_text_blob"] for r in rows] == [i == 6 for i in range(11)]


def test_columns_without_a_type_do_not_resolve(catalog):
    assert resolve_columns(catalog).where("relation_name = 'GONE'").count() == 0


def test_binary_blobs_are_not_text_blobs(catalog):
    flags = {r[0]: r[1] for r in text_blob_tables(resolve_columns(catalog)).collect()}
    assert flags == {"ORDERS": True, "LINES": False, "CODES": False, "LOGS": False}


def test_keys_in_segment_order(catalog):
    keys = {r["relation_name"]: r for r in detect_keys(catalog, resolve_columns(catalog)).collect()}
    assert set(keys) == {"ORDERS", "LINES", "CODES"}
    assert keys["LINES"]["key_columns"] == ["ORDER_ID", "LINE_NO"] and keys["LINES"]["usable"]
    assert keys["ORDERS"]["key_columns"] == ["C1"] and keys["ORDERS"]["usable"]
    assert keys["CODES"]["key_columns"] == ["N", "CODE"] and not keys["CODES"]["usable"]


def test_one_table_by_name_in_any_case(catalog):
    columns = resolve_columns(catalog)
    assert keys_of(catalog, columns, " lines") == ["ORDER_ID", "LINE_NO"]
    assert keys_of(catalog, columns, "Codes") == keys_of(catalog, columns, "LOGS") == []
    lines = catalog.fields.sparkSession.createDataFrame([], "LINE_NO int, ORDER_ID bigint, RAW binary")
    assert declared_schema_of(columns, "lines", lines) == {"LINE_NO": "int64", "ORDER_ID": "int64", "RAW": "binary"}
    for unknown in (lambda: keys_of(catalog, columns, "LINEITEMS"), lambda: declared_schema_of(columns, "LINEITEMS", lines)):
        with pytest.raises(ValueError, match="no table"):
            unknown()


def test_catalog_types_only_widen(catalog):
    """A date, a boolean and a scaled decimal under codes that would lose them keep their own type."""
    columns = resolve_columns(catalog)
    delivered = catalog.fields.sparkSession.createDataFrame([], "LINE_NO decimal(9,2), ORDER_ID date, RAW boolean")
    assert declared_schema_of(columns, "lines", delivered) == {"LINE_NO": "native", "ORDER_ID": "native", "RAW": "native"}


def test_described_files_resolve_like_a_catalog(spark, table):
    tables = {"orders": table("orders"), "documents": table("documents"), "embeddings": table("embeddings")}
    described = describe_tables(spark, tables, {"orders": ["o_orderkey"]}, {("documents", "text")})
    columns = resolve_columns(described)
    targets = {(r["relation_name"], r["column_name"]): r["target_type"] for r in columns.collect()}
    assert targets["orders", "o_orderdate"] == "native"
    assert targets["embeddings", "embedding"] == "native"
    assert targets["documents", "text"] == "utf8"
    declared = {c: t for (rel, c), t in targets.items() if rel == "orders"}
    assert coerce_table(tables["orders"], declared).count() == tables["orders"].count()
    assert [r["key_columns"] for r in detect_keys(described, columns).collect()] == [["o_orderkey"]]


def test_text_blob_mark(table):
    documents = table("documents")
    assert not has_text_blob(documents)
    assert has_text_blob(mark_text_blobs(documents, ["text"]))
