"""Estimated size of a record in bytes, as an expression over its columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bytes by type; a null counts 1, a string 2 a UTF-16 unit, binary its length.
WIDTHS = {
    T.ByteType: 1, T.BooleanType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4,
    T.LongType: 8, T.DoubleType: 8, T.DateType: 8, T.TimestampType: 8, T.TimestampNTZType: 8, T.DecimalType: 16,
}


def _utf16(col: Column) -> Column:
    """UTF-16 units: code points, and one more for each outside the basic plane."""
    return F.length(col) + F.length(F.regexp_replace(col, "[^\\x{10000}-\\x{10FFFF}]", ""))


def size_of(col: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        size = 2 * _utf16(col)
    elif isinstance(kind, T.BinaryType):
        size = F.length(col)
    elif isinstance(kind, T.StructType):
        size = sum((size_of(col[f.name], f.dataType) for f in kind), F.lit(0).cast("long"))
    elif isinstance(kind, T.ArrayType):
        size = _total(col, kind.elementType)
    elif isinstance(kind, T.MapType):
        size = _total(F.map_keys(col), kind.keyType) + _total(F.map_values(col), kind.valueType)
    else:
        size = F.lit(WIDTHS.get(type(kind), 8))
    return F.when(col.isNull(), F.lit(1)).otherwise(size).cast("long")


def _total(items: Column, kind: T.DataType) -> Column:
    return F.aggregate(F.transform(items, lambda x: size_of(x, kind)), F.lit(0).cast("long"), lambda a, x: a + x)


def record_size(schema: T.StructType, prefix: str = "") -> Column:
    """The size of a row with these columns (those of struct column prefix, if given)."""
    at = (lambda n: F.col(prefix)[n]) if prefix else (lambda n: F.col(f"`{n}`"))
    return sum((size_of(at(f.name), f.dataType) for f in schema), F.lit(0).cast("long"))
