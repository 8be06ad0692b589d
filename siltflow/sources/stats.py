"""Bounds of a file's columns, and which files a condition on them leaves out.

A file's add action has stats: its rows, and of its first columns of a simple type the least and
greatest value and the nulls. Dates are days, timestamps microseconds, decimals texts; long texts have
a lower bound by their beginning and no upper one. NaN is greater than all numbers, as in Spark, so a file that holds one has no upper bound.
A bound that isn't there leaves nothing out.
"""

from __future__ import annotations

import datetime as dt
import decimal
import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PREFIX = 32
NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FLOATS = (T.FloatType, T.DoubleType)
SIMPLE = (*NUMBERS, *FLOATS, T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType, T.StringType)
STATS = "n bigint, min map<string,string>, max map<string,string>, nulls map<string,bigint>"


@dataclass(frozen=True)
class Between:
    """A range, both ends included; None: open."""

    low: object = None
    high: object = None


def columns(schema: T.StructType, most: int) -> list[T.StructField]:
    """The first columns that get bounds."""
    return [f for f in schema if isinstance(f.dataType, SIMPLE)][:most]


def _stored(c: Column, kind: T.DataType) -> Column:
    """A value as bounds have it."""
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("string")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).cast("string")
    if isinstance(kind, T.TimestampNTZType):
        seconds = F.unix_date(c.cast("date")).cast("long") * 86_400 + F.hour(c) * 3600 + F.minute(c) * 60  # the session's time zone has no say
        return (seconds * 1_000_000 + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")).cast("string")
    return c.cast("string")


def by_file(written: DataFrame, fields: list[T.StructField], file: Column) -> DataFrame:
    """For each file its path and its stats as JSON: one aggregation, merged before it is shuffled."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        short = F.substring(c, 1, PREFIX) if isinstance(f.dataType, T.StringType) else c
        high = F.max(short)
        if isinstance(f.dataType, T.StringType):
            high = F.when(F.max(F.length(c)) <= PREFIX, high)
        if isinstance(f.dataType, FLOATS):
            high = F.when(~F.isnan(high), high)
        low = F.min(short)
        if isinstance(f.dataType, FLOATS):
            low = F.when(~F.isnan(low), low)
        aggs += [_stored(low, f.dataType).alias(f"min{i}"), _stored(high, f.dataType).alias(f"max{i}"), F.count_if(c.isNull()).alias(f"nulls{i}")]
    found = written.groupBy(file.alias("file")).agg(*aggs)
    if not fields:
        return found.select("file", F.to_json(F.struct("n")).alias("stats"))
    named = lambda kind: F.map_filter(F.map_from_arrays(F.array(*(F.lit(f.name) for f in fields)), F.array(*(F.col(f"{kind}{i}") for i in range(len(fields))))), lambda k, v: v.isNotNull())
    return found.select("file", F.to_json(F.struct("n", *(named(k).alias(k) for k in ("min", "max", "nulls")))).alias("stats"))


def stored_value(value: object, kind: T.DataType) -> object:
    """A condition's value, comparable with what `_read` makes of a bound."""
    if isinstance(kind, T.DateType):
        value = dt.date.fromisoformat(value) if isinstance(value, str) else value
        return (value - dt.date(1970, 1, 1)).days
    if isinstance(kind, T.TimestampType | T.TimestampNTZType):
        value = dt.datetime.fromisoformat(value) if isinstance(value, str) else value
        value = value if value.tzinfo else value.replace(tzinfo=dt.UTC)
        return (value - dt.datetime(1970, 1, 1, tzinfo=dt.UTC)) // dt.timedelta(microseconds=1)
    return _read(str(value), kind)


def _read(text: str | None, kind: T.DataType) -> object:
    if text is None:
        return None
    if isinstance(kind, T.StringType):
        return text.encode()
    if isinstance(kind, FLOATS):
        return float(text)
    if isinstance(kind, T.DecimalType):
        return decimal.Decimal(text)
    return int(text)


def _at_most(a: object, b: object) -> bool:
    return b != b or a <= b  # NaN is greater than all numbers


def _sql_type(kind: T.DataType) -> str:
    return "string" if isinstance(kind, T.StringType) else "double" if isinstance(kind, FLOATS) else kind.simpleString() if isinstance(kind, T.DecimalType) else "bigint"


def _literal(value: object, kind: T.DataType) -> Column:
    value = stored_value(value, kind)
    return F.lit(value.decode() if isinstance(value, bytes) else value).cast(_sql_type(kind))


def row_filter(where: dict[str, object], schema: T.StructType) -> Column:
    """Whether a row meets all conditions: a Between, a value, or a list or set of values (None: null)."""
    out = F.lit(True)
    for name, w in where.items():
        c = F.col(f"`{name}`")
        if isinstance(w, Between):
            if w.low is not None:
                out = out & (c >= F.lit(w.low).cast(schema[name].dataType))
            if w.high is not None:
                out = out & (c <= F.lit(w.high).cast(schema[name].dataType))
            continue
        values = list(w) if isinstance(w, list | set | tuple) else [w]
        hit = F.lit(False)
        for v in values:
            hit = hit | (c.isNull() if v is None else c.eqNullSafe(F.lit(v).cast(schema[name].dataType)))
        out = out & hit
    return F.coalesce(out, F.lit(False))


def may_hold(add: dict, where: dict[str, object], schema: T.StructType, partitions: list[str]) -> bool:
    """Whether a file may hold rows that meet the conditions, by its add action."""
    stats = add.get("stats") or {}
    for name, w in where.items():
        if name in partitions and not isinstance(w, Between):
            values = {None if v is None else str(v) for v in (w if isinstance(w, list | set | tuple) else [w])}
            if add["partitionValues"].get(name) not in values:
                return False
            continue
        if not stats or name not in (stats.get("nulls") or {}):
            continue
        kind, n, nulls = schema[name].dataType, int(stats["n"]), int(stats["nulls"][name])
        low, high = (_read(None if (x := (stats.get(k) or {}).get(name)) is None else str(x), kind) for k in ("min", "max"))

        def meets(a, b, low=low, high=high, kind=kind, n=n, nulls=nulls) -> bool:
            if nulls == n:
                return False
            return (a is None or high is None or _at_most(stored_value(a, kind), high)) and (b is None or low is None or _at_most(low, stored_value(b, kind)))

        if isinstance(w, Between):
            hit = meets(w.low, w.high) if (w.low, w.high) != (None, None) else True
        else:
            hit = any(nulls > 0 if v is None else meets(v, v) for v in (w if isinstance(w, list | set | tuple) else [w]))
        if not hit:
            return False
    return True


def may_hold_column(where: dict[str, object], schema: T.StructType, partitions: list[str]) -> Column:
    """`may_hold` over rows of partitionValues (a map) and stats (JSON)."""
    stats, out = F.from_json("stats", STATS), F.lit(True)
    for name, w in where.items():
        values = list(w) if isinstance(w, list | set | tuple) else [w]
        if name in partitions and not isinstance(w, Between):
            own = F.try_element_at("partitionValues", F.lit(name))
            hit = F.lit(False)
            for v in values:
                hit = hit | (own.isNull() if v is None else own.eqNullSafe(F.lit(str(v))))
            out = out & hit
            continue
        kind = schema[name].dataType
        if not isinstance(kind, SIMPLE):
            continue
        nulls, n = F.try_element_at(stats["nulls"], F.lit(name)), stats["n"]
        low, high = (F.try_element_at(stats[k], F.lit(name)).cast(_sql_type(kind)) for k in ("min", "max"))

        def meets(a, b, kind=kind, nulls=nulls, n=n, low=low, high=high) -> Column:
            hit = nulls < n
            hit = hit & (F.lit(True) if a is None else F.coalesce(_literal(a, kind) <= high, F.lit(True)))
            return hit & (F.lit(True) if b is None else F.coalesce(low <= _literal(b, kind), F.lit(True)))

        if isinstance(w, Between):
            hit = meets(w.low, w.high) if (w.low, w.high) != (None, None) else F.lit(True)
        else:
            hit = F.lit(False)
            for v in values:
                hit = hit | (nulls > 0 if v is None else meets(v, v))
        out = out & F.coalesce(hit, F.lit(True))
    return out


def parsed(stats: str | None) -> dict | None:
    return json.loads(stats) if stats else None
