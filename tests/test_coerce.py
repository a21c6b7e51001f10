import datetime as dt
import decimal
import math
import struct

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from tablehaul.functions.coerce import (
    WHITE_SPACE,
    bytes_to_text,
    coerce_column,
    coerce_table,
    float_to_int64,
    float_to_text,
    text_to_bytes,
    trim_text,
)

MAX, MIN = 2**63 - 1, -(2**63)


def one_column(spark, values, kind):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def apply(spark, values, kind, expression):
    rows = one_column(spark, values, kind).select("i", expression(F.col("v")).alias("o")).orderBy("i").collect()
    return [r["o"] for r in rows]


def test_float_to_int64(spark):
    values = [math.nan, 1e30, -1e30, 2.9, -2.9, None, math.inf, -math.inf, 9.3e18, -0.5]
    want = [0, MAX, MIN, 2, -2, None, MAX, MIN, MAX, 0]
    assert apply(spark, values, "double", float_to_int64) == want


def test_trim_covers_unicode_white_space(spark):
    values = ["\t a \n", " a ", "   ", "", None, "　ç ã ", "​x", "a b"]
    want = ["a", "a", "", "", None, "ç ã", "​x", "a b"]
    assert apply(spark, values, "string", trim_text) == want
    padded = [c + "x y" + c for c in WHITE_SPACE]
    assert apply(spark, padded, "string", trim_text) == ["x y"] * 25


def test_float_to_text_known_values(spark):
    values = [1.0, 1e30, 1e-7, 0.1, -0.0, 0.0, math.nan, math.inf, -math.inf, None, 123.45, 1e7, 1e15, 2.0**53]
    want = ["1", "1" + "0" * 30, "0.0000001", "0.1", "-0", "0", "NaN", "inf", "-inf", None, "123.45",
            "10000000", "1000000000000000", "9007199254740992"]
    assert apply(spark, values, "double", float_to_text) == want


def test_float_to_text_is_shortest(spark):
    rng = np.random.default_rng(3)
    bits = rng.integers(0, 2**64, 4000, dtype=np.uint64)
    values = [struct.unpack("<d", struct.pack("<Q", int(b)))[0] for b in bits]
    values += list(rng.uniform(-1e7, 1e7, 4000)) + list(np.round(rng.uniform(0, 1e6, 2000), 2))
    values += [2.0e-3, 2.0**-44, 1.1e23, 8.41e21, 9.0e-4]
    values = [v for v in values if math.isfinite(v)]
    got = apply(spark, [float(v) for v in values], "double", float_to_text)
    want = [np.format_float_positional(v, unique=True, trim="-") for v in values]
    assert got == want
    assert all(float(g) == v for g, v in zip(got, values))


def test_text_and_bytes(spark):
    assert apply(spark, [" çã "], "string", text_to_bytes) == [bytearray(" çã ".encode())]
    assert apply(spark, [bytearray(b"\xe7\xe3\x6f")], "binary", bytes_to_text) == ["ção"]


def test_integer_and_boolean_to_text(spark):
    assert apply(spark, [1, -7, None], "bigint", lambda c: coerce_column(c, T.LongType(), "utf8")) == ["1", "-7", None]
    assert apply(spark, [True, False, None], "boolean", lambda c: coerce_column(c, T.BooleanType(), "utf8")) == [
        "true", "false", None]


def test_decimals_keep_their_fraction_unless_told(spark):
    df = spark.createDataFrame([(decimal.Decimal("12.75"),), (decimal.Decimal("-3.99"),)], "d decimal(20,2)")
    assert coerce_table(df).schema["d"].dataType == T.DecimalType(20, 2)
    assert [r["d"] for r in coerce_table(df, {"d": "int64"}).collect()] == [12, -3]
    assert [r["d"] for r in coerce_table(df, {"d": "utf8"}).collect()] == ["12.75", "-3.99"]
    big = spark.createDataFrame([(decimal.Decimal("99999999999999999999"),)], "d decimal(20,0)")
    assert coerce_table(big, {"d": "int64"}).first()["d"] == MAX


def test_default_coercion_widens_and_keeps(spark):
    schema = ("a tinyint, b smallint, c int, d bigint, e float, f double, g string, h binary, i boolean, "
              "j date, k timestamp_ntz, l array<float>")
    row = (1, 2, 3, 4, 0.5, 1.5, " x ", bytearray(b" y "), True, dt.date(2020, 1, 1), dt.datetime(2020, 1, 1), [0.25])
    out = coerce_table(spark.createDataFrame([row, (None,) * 12], schema))
    assert dict(out.dtypes) == {
        "a": "bigint", "b": "bigint", "c": "bigint", "d": "bigint", "e": "double", "f": "double", "g": "string",
        "h": "binary", "i": "boolean", "j": "date", "k": "timestamp_ntz", "l": "array<float>"}
    first, second = out.collect()
    assert first["g"] == "x" and first["h"] == bytearray(b" y ") and first["l"] == [0.25]
    assert all(v is None for v in second)


def test_incompatible_declared_types_become_null(spark):
    df = spark.createDataFrame([("12", True, dt.date(2020, 1, 1), 5)], "s string, b boolean, d date, n int")
    out = coerce_table(df, {"s": "int64", "b": "float64", "d": "utf8", "n": "binary"})
    assert dict(out.dtypes) == {"s": "bigint", "b": "double", "d": "string", "n": "binary"}
    assert list(out.first()) == [None] * 4


def test_binary_declared_text_needs_a_charset(spark):
    df = spark.createDataFrame([(bytearray(b" \xe9 "),)], "b binary")
    assert coerce_table(df, {"b": "utf8"}).first()["b"] is None
    assert coerce_table(df, {"b": "utf8"}, charset="ISO-8859-1").first()["b"] == "é"


def test_unknown_names_and_types_are_refused(spark):
    df = spark.range(1)
    with pytest.raises(ValueError, match="not in the table"):
        coerce_table(df, {"nope": "int64"})
    with pytest.raises(ValueError, match="unknown target"):
        coerce_table(df, {"id": "int32"})


def test_odd_column_names_and_metadata_survive(spark):
    df = spark.range(1).select(F.col("id").alias("a.b"), F.col("id").alias("c`d", metadata={"is_text_blob": True}))
    out = coerce_table(df)
    assert out.columns == ["a.b", "c`d"]
    assert out.schema["c`d"].metadata == {"is_text_blob": True}


@given(st.lists(st.text(alphabet="ab" + WHITE_SPACE + "​", max_size=12), min_size=1, max_size=30))
@settings(max_examples=15, deadline=None)
def test_trim_matches_strip_of_white_space(spark, texts):
    assert apply(spark, texts, "string", trim_text) == [t.strip(WHITE_SPACE) for t in texts]
