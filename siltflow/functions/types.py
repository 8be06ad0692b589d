"""Schemas that travel with records (the JSON converter's form), as Spark types and DDL."""

from __future__ import annotations

import json
import re

from pyspark.sql import types as T

MAX_DEPTH = 32

# Physical and logical type names of the wire format.
PHYSICAL: dict[str, T.DataType] = {
    "int8": T.ByteType(), "int16": T.ShortType(), "int32": T.IntegerType(), "int64": T.LongType(),
    "float": T.FloatType(), "float32": T.FloatType(), "double": T.DoubleType(), "float64": T.DoubleType(),
    "boolean": T.BooleanType(), "string": T.StringType(), "bytes": T.BinaryType(),
}
TIMESTAMP = "org.apache.kafka.connect.data.Timestamp"
DATE = "org.apache.kafka.connect.data.Date"
DECIMAL = "org.apache.kafka.connect.data.Decimal"


class SchemaError(ValueError):
    """A record schema that can't be mapped."""


def _decimal(schema: dict) -> T.DecimalType:
    from siltflow.functions.redact import redact

    scale = (schema.get("parameters") or {}).get("scale")
    if scale is None:
        raise SchemaError("a decimal needs a scale parameter")
    if not re.fullmatch(r"-?\d{1,9}", str(scale)):
        raise SchemaError(f"a decimal's scale must be a whole number, not {redact(str(scale))}")
    if not 0 <= int(scale) <= 38:
        raise SchemaError(f"a decimal's scale must be from 0 to 38, not {scale}")
    return T.DecimalType(38, int(scale))


def spark_type(schema: dict, depth: int = 0) -> T.DataType:
    """The Spark type of one schema; logical names go before physical types, unknown names are ignored."""
    name, kind = schema.get("name"), schema.get("type")
    if name == TIMESTAMP:
        return T.TimestampType()
    if name == DATE:
        return T.DateType()
    if name == DECIMAL:
        return _decimal(schema)
    if kind in PHYSICAL:
        return PHYSICAL[kind]
    if kind not in ("struct", "array", "map"):
        raise SchemaError(f"unsupported type {kind!r}")
    if depth >= MAX_DEPTH:
        raise SchemaError(f"a schema may nest {MAX_DEPTH} levels at most")
    if kind == "struct":
        return T.StructType([spark_field(f, depth + 1) for f in schema.get("fields", [])])
    if kind == "array":
        items = schema["items"]
        return T.ArrayType(spark_type(items, depth + 1), bool(items.get("optional")))
    keys, values = schema["keys"], schema["values"]
    return T.MapType(spark_type(keys, depth + 1), spark_type(values, depth + 1), bool(values.get("optional")))


def spark_field(field: dict, depth: int = 0) -> T.StructField:
    return T.StructField(field["field"], spark_type(field, depth), bool(field.get("optional")))


def spark_schema(schema: dict | str | None) -> T.StructType:
    """The table schema of a record schema, which must be a struct."""
    if isinstance(schema, str):
        schema = json.loads(schema)
    if not isinstance(schema, dict) or schema.get("type") != "struct":
        raise SchemaError("a record's schema must be a struct")
    return T.StructType([spark_field(f) for f in schema.get("fields", [])])


def wire_schema(schema: T.StructType) -> dict:
    """The record schema of a table schema: the inverse of spark_schema."""

    def of(kind: T.DataType, optional: bool) -> dict:
        if isinstance(kind, T.StructType):
            return {"type": "struct", "fields": [of(f.dataType, f.nullable) | {"field": f.name} for f in kind], "optional": optional}
        if isinstance(kind, T.ArrayType):
            return {"type": "array", "items": of(kind.elementType, kind.containsNull), "optional": optional}
        if isinstance(kind, T.MapType):
            return {"type": "map", "keys": of(kind.keyType, False), "values": of(kind.valueType, kind.valueContainsNull), "optional": optional}
        if isinstance(kind, T.TimestampType | T.TimestampNTZType):
            return {"type": "int64", "name": TIMESTAMP, "version": 1, "optional": optional}
        if isinstance(kind, T.DateType):
            return {"type": "int32", "name": DATE, "version": 1, "optional": optional}
        if isinstance(kind, T.DecimalType):
            return {"type": "bytes", "name": DECIMAL, "version": 1, "parameters": {"scale": str(kind.scale)}, "optional": optional}
        for name, own in PHYSICAL.items():
            if own == kind:
                return {"type": name, "optional": optional}
        raise SchemaError(f"no record type for {kind.simpleString()}")

    return of(schema, False)


def sql_type(kind: T.DataType) -> str:
    """DDL of a type; nested fields keep their NOT NULL."""
    if isinstance(kind, T.StructType):
        return f"STRUCT<{','.join(f'{f.name}:{sql_type(f.dataType)}' + ('' if f.nullable else ' NOT NULL') for f in kind)}>"
    if isinstance(kind, T.ArrayType):
        return f"ARRAY<{sql_type(kind.elementType)}>"
    if isinstance(kind, T.MapType):
        return f"MAP<{sql_type(kind.keyType)},{sql_type(kind.valueType)}>"
    return kind.simpleString().upper()


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column_defs(schema: T.StructType) -> str:
    """The column list of CREATE TABLE."""
    return ", ".join(f"{_quoted(f.name)} {sql_type(f.dataType)}" + ("" if f.nullable else " NOT NULL") for f in schema)


def added_column_defs(schema: T.StructType, names: list[str]) -> str:
    """The column list of ALTER TABLE ... ADD COLUMNS; added columns are nullable."""
    known = {f.name: f for f in schema}
    if missing := [n for n in names if n not in known]:
        raise SchemaError(f"not in the record schema: {missing}")
    return ", ".join(f"{_quoted(n)} {sql_type(known[n].dataType)}" for n in names)
