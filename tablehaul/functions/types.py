"""The four portable column types and the catalog type codes that lead to them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

INT64, FLOAT64, UTF8, BINARY = "int64", "float64", "utf8", "binary"
NATIVE = "native"

# Catalog type codes. Code 12 is a blob, which is text only when its
# sub-type is 1. Columns of any other code (dates, times, decimals) keep the type
# their connector gives them.
INTEGER_CODES = (7, 8, 16)
FLOAT_CODES = (10, 27, 23)
BLOB_CODE = 12
TEXT_BLOB_SUBTYPE = 1
TEXT_CODES = (14, 37)

SPARK_TYPES = {
    INT64: T.LongType(),
    FLOAT64: T.DoubleType(),
    UTF8: T.StringType(),
    BINARY: T.BinaryType(),
}


TEXT_TYPES = (T.StringType, T.CharType, T.VarcharType)


def is_text_blob(code: Column, subtype: Column) -> Column:
    return F.coalesce((code == BLOB_CODE) & (subtype == TEXT_BLOB_SUBTYPE), F.lit(False))


def target_of_code(code: Column, subtype: Column) -> Column:
    """Portable type name for a catalog type code."""
    return (
        F.when(code.isin(*INTEGER_CODES), INT64)
        .when(code.isin(*FLOAT_CODES), FLOAT64)
        .when(is_text_blob(code, subtype) | code.isin(*TEXT_CODES), UTF8)
        .when(code == BLOB_CODE, BINARY)
        .otherwise(NATIVE)
    )


def code_of_type(data_type: T.DataType, text_blob: bool = False) -> tuple[int, int]:
    """Catalog type code and sub-type that describe a Spark column; 0 where none does."""
    if isinstance(data_type, TEXT_TYPES):
        return (BLOB_CODE, TEXT_BLOB_SUBTYPE) if text_blob else (37, 0)
    if isinstance(data_type, T.BinaryType):
        return BLOB_CODE, 0
    known = {"tinyint": 7, "smallint": 7, "int": 8, "bigint": 16, "float": 10, "double": 27}
    return known.get(data_type.simpleString(), 0), 0


def keeps_values(data_type: T.DataType, target: str, charset: str | None = None) -> bool:
    """Whether a column of this type reaches a portable type with all its values; text may lose outer white space."""
    if target == NATIVE or target == default_target(data_type):
        return True
    return target == UTF8 and isinstance(data_type, T.BinaryType) and charset is not None


def default_target(data_type: T.DataType) -> str | None:
    """Portable type a Spark column widens to; None keeps the native type."""
    if isinstance(data_type, T.IntegralType):
        return INT64
    if isinstance(data_type, T.FractionalType) and not isinstance(data_type, T.DecimalType):
        return FLOAT64
    if isinstance(data_type, TEXT_TYPES):
        return UTF8
    if isinstance(data_type, T.BinaryType):
        return BINARY
    return None
