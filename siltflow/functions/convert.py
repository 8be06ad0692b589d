"""Record values as table values, by expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def timestamp_of_millis(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def date_of_millis(ms: Column) -> Column:
    """The day of a time in milliseconds, cut towards zero (so -1 is day 0)."""
    days = F.floor(F.abs(ms) / F.lit(86_400_000))
    return F.date_from_unix_date(F.when(ms < 0, -days).otherwise(days).cast("int"))


def decimal_of_base64(col: Column, scale: int) -> Column:
    """A decimal from base64 of its unscaled two's-complement bytes (at most 16); null if it doesn't fit.

    The bytes, filled up to 16, are two 64-bit halves: the upper one signed, the lower one not.
    """
    raw = F.hex(F.unbase64(col))
    full = F.lpad(raw, 32, F.when(F.substring(raw, 1, 1) >= "8", "F").otherwise("0"))
    high = F.conv(F.substring(full, 1, 16), 16, -10).cast("decimal(19,0)")
    low = F.conv(F.substring(full, 17, 16), 16, 10).cast("decimal(20,0)")
    whole = F.try_add(F.try_multiply(high, F.lit(str(2**64)).cast("decimal(20,0)")), low).cast("string")
    return F.when(F.length(raw) <= 32, F.concat(whole, F.lit(f"E-{scale}")).try_cast(T.DecimalType(38, scale)))


def json_schema(kind: T.DataType) -> T.DataType:
    """The shape in which the JSON converter writes a value of this type."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, json_schema(f.dataType)) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(json_schema(kind.elementType))
    if isinstance(kind, T.MapType):
        if isinstance(kind.keyType, T.StringType):
            return T.MapType(T.StringType(), json_schema(kind.valueType))
        return T.ArrayType(T.ArrayType(T.StringType()))  # other keys: a list of pairs
    if isinstance(kind, T.BinaryType | T.DecimalType):
        return T.StringType()
    if isinstance(kind, T.TimestampType | T.TimestampNTZType):
        return T.LongType()
    if isinstance(kind, T.DateType):
        return T.IntegerType()
    return kind


def of_json(col: Column, kind: T.DataType) -> Column:
    """A parsed JSON value as a value of this type; null values stay null, not structs of nulls."""
    if isinstance(kind, T.StructType):
        return F.when(col.isNotNull(), F.struct(*(of_json(col[f.name], f.dataType).alias(f.name) for f in kind)))
    if isinstance(kind, T.ArrayType):
        return F.transform(col, lambda x: of_json(x, kind.elementType))
    if isinstance(kind, T.MapType):
        if isinstance(kind.keyType, T.StringType):
            return F.transform_values(col, lambda _, v: of_json(v, kind.valueType))

        def value(text: Column) -> Column:
            shape = json_schema(kind.valueType)
            if isinstance(shape, T.StructType | T.ArrayType | T.MapType):
                return of_json(F.from_json(text, shape), kind.valueType)
            return of_json(text.try_cast(shape), kind.valueType)

        return F.map_from_entries(F.transform(col, lambda p: F.struct(p[0].try_cast(kind.keyType).alias("key"), value(p[1]).alias("value"))))
    if isinstance(kind, T.BinaryType):
        return F.unbase64(col)
    if isinstance(kind, T.DecimalType):
        return decimal_of_base64(col, kind.scale)
    if isinstance(kind, T.TimestampType):
        return timestamp_of_millis(col)
    if isinstance(kind, T.TimestampNTZType):
        return timestamp_of_millis(col).cast(kind)
    if isinstance(kind, T.DateType):
        return F.date_from_unix_date(col)
    return col


def to_json_value(col: Column, kind: T.DataType) -> Column:
    """The inverse of of_json, up to microseconds: for generators and tests."""
    if isinstance(kind, T.StructType):
        return F.when(col.isNotNull(), F.struct(*(to_json_value(col[f.name], f.dataType).alias(f.name) for f in kind)))
    if isinstance(kind, T.ArrayType):
        return F.transform(col, lambda x: to_json_value(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(col, lambda _, v: to_json_value(v, kind.valueType))
    if isinstance(kind, T.BinaryType):
        return F.base64(col)
    if isinstance(kind, T.TimestampType):
        return F.unix_millis(col)
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_millis(col.cast("timestamp"))
    if isinstance(kind, T.DateType):
        return F.unix_date(col)
    return col
