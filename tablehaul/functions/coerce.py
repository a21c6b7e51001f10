"""Value coercion as column expressions.

Everything stays JVM-side except :func:`float_to_text` for the few doubles whose
shortest digits the JVM does not print reliably.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tablehaul.functions.types import (
    BINARY,
    FLOAT64,
    INT64,
    NATIVE,
    SPARK_TYPES,
    TEXT_TYPES,
    UTF8,
    default_target,
)
from tablehaul.names import column

# The code points with the Unicode White_Space property.
WHITE_SPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

INT64_MIN, INT64_MAX = -(2**63), 2**63 - 1


def trim_text(text: Column) -> Column:
    """Strip Unicode whitespace from both ends; blank text becomes empty, not NULL.

    Text whose first and last characters are printable ASCII, which is most text,
    is told apart by two comparisons and passed on as it is.
    """
    last = F.substring(text, -1, 1)
    clean = text.between("!", "~~") & last.between("!", "~")
    return F.when(clean, text).otherwise(F.btrim(text, F.lit(WHITE_SPACE)))


def float_to_int64(value: Column) -> Column:
    """Truncate toward zero, saturate at the bigint bounds, NaN to 0."""
    value = value.cast("double")
    return (
        F.when(F.isnan(value), F.lit(0).cast("bigint"))
        .when(value >= F.lit(float(2**63)), F.lit(INT64_MAX))
        .when(value <= F.lit(float(-(2**63))), F.lit(INT64_MIN))
        .otherwise(value.cast("bigint"))
    )


def decimal_to_int64(value: Column) -> Column:
    """Truncate toward zero and saturate, without a detour through double."""
    return (
        F.when(value >= F.lit(INT64_MAX), F.lit(INT64_MAX))
        .when(value <= F.lit(INT64_MIN), F.lit(INT64_MIN))
        .otherwise(value.cast("bigint"))
    )


def text_to_bytes(text: Column) -> Column:
    """UTF-8 bytes, untrimmed."""
    return F.encode(text, "UTF-8")


def bytes_to_text(raw: Column, charset: str = "ISO-8859-1") -> Column:
    return F.decode(raw, charset)


@F.arrow_udf(T.StringType())
def _shortest_digits(values: pa.Array) -> pa.Array:
    # Arrow prints the shortest digits, but very large and small values with an exponent
    text = pc.cast(values, pa.string())
    powers = pc.fill_null(pc.match_substring(text, "e"), False)
    if not pc.any(powers).as_py():
        return text
    plain = [np.format_float_positional(x, unique=True, trim="-") for x in values.filter(powers).to_pylist()]
    return pc.replace_with_mask(text, powers, pa.array(plain, pa.string()))


def float_to_text(value: Column) -> Column:
    """Shortest digits that read back to the same double, without exponent.

    Whole numbers below 2^53 print as bigint. Of the rest, a plain JVM rendering
    of at most 15 significant digits is already the shortest, since no two
    decimals of 15 digits share a double. Only what is left goes through Arrow;
    the other rows enter that function as NULL.
    """
    value = value.cast("double")
    size = F.abs(value)
    jvm = value.cast("string")
    whole = (size < F.lit(float(2**53))) & (value == F.rint(value)) & (value != 0)
    # 15 digits and the point
    plain = (size >= F.lit(1e-3)) & (size < F.lit(1e7)) & (F.length(jvm) <= 16)
    zero_or_nan = (value == 0) | F.isnan(value)
    rest = F.when(~(zero_or_nan | whole | plain), value)
    return (
        F.when(F.isnan(value), F.lit("NaN"))
        .when(value == 0, F.regexp_replace(jvm, r"\.0$", ""))
        .when(whole, F.when(whole, value).cast("bigint").cast("string"))
        .when(plain, jvm)
        .otherwise(_shortest_digits(rest))
    )


def coerce_column(
    value: Column,
    data_type: T.DataType,
    target: str | None = None,
    charset: str | None = None,
) -> Column:
    """Expression that brings a column to ``target``.

    Without a target the column widens within its own kind and any other type is
    kept. A declared target that the type cannot satisfy yields typed NULLs.
    """
    target = target or default_target(data_type) or NATIVE
    if target == NATIVE:
        return value
    if target not in SPARK_TYPES:
        raise ValueError(f"unknown target type {target!r}; use one of {[*SPARK_TYPES, NATIVE]}")

    integral = isinstance(data_type, T.IntegralType)
    decimal = isinstance(data_type, T.DecimalType)
    floating = isinstance(data_type, T.FractionalType) and not decimal
    text = isinstance(data_type, TEXT_TYPES)
    raw = isinstance(data_type, T.BinaryType)

    if target == INT64:
        if integral:
            return value.cast("bigint")
        if floating:
            return float_to_int64(value)
        if decimal:
            return decimal_to_int64(value)
    elif target == FLOAT64:
        if integral or floating or decimal:
            return value.cast("double")
    elif target == UTF8:
        if text:
            return trim_text(value)
        if floating:
            return float_to_text(value)
        if integral or decimal or isinstance(data_type, T.BooleanType):
            return value.cast("string")
        if raw and charset:
            return trim_text(bytes_to_text(value, charset))
    elif target == BINARY:
        if raw:
            return value
        if text:
            return text_to_bytes(value)
    return F.lit(None).cast(SPARK_TYPES[target])


def coerce_table(
    df: DataFrame,
    declared_schema: Mapping[str, str] | None = None,
    charset: str | None = None,
) -> DataFrame:
    """All columns of ``df`` coerced in one projection.

    ``declared_schema`` maps column names to portable types; columns it leaves
    out follow their own type. ``charset`` decodes binary columns declared text.
    """
    declared = dict(declared_schema or {})
    unknown = sorted(set(declared) - set(df.columns))
    if unknown:
        raise ValueError(f"declared columns not in the table: {unknown}")
    return df.select(
        *[
            coerce_column(column(f.name), f.dataType, declared.get(f.name), charset).alias(
                f.name, metadata=f.metadata or {}
            )
            for f in df.schema.fields
        ]
    )
