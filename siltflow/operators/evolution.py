"""Additive schema evolution."""

from __future__ import annotations

from dataclasses import dataclass
from enum import Enum

from pyspark.sql import types as T


class Evolution(Enum):
    NONE = "none"
    ADD = "add"
    MERGE = "merge"  # as ADD, and batches of an older schema get nulls for what they lack

    @classmethod
    def of(cls, text: str | None) -> Evolution:
        return {"add": cls.ADD, "merge": cls.MERGE}.get((text or "").strip().lower(), cls.NONE)


@dataclass(frozen=True)
class Diff:
    added: tuple[T.StructField, ...] = ()
    breaking: str | None = None

    @property
    def changed(self) -> bool:
        return bool(self.added) and self.breaking is None


def same_type(a: T.DataType, b: T.DataType) -> bool:
    """Equal up to nullability at any level."""
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return a.names == b.names and all(same_type(x.dataType, y.dataType) for x, y in zip(a, b, strict=True))
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return same_type(a.elementType, b.elementType)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return same_type(a.keyType, b.keyType) and same_type(a.valueType, b.valueType)
    return a == b


def diff(current: T.StructType, incoming: T.StructType, lacking_ok: bool = False) -> Diff:
    """What incoming adds to current, or why it can't be absorbed. Names are compared by case."""
    new = {f.name: f for f in incoming}
    for f in current:
        if f.name not in new:
            if lacking_ok and f.nullable:
                continue
            return Diff(breaking=f"column {f.name} is missing")
        if not same_type(f.dataType, new[f.name].dataType):
            return Diff(breaking=f"column {f.name} would change from {f.dataType.simpleString()} to {new[f.name].dataType.simpleString()}")
    added = tuple(f for f in incoming if f.name not in current.names)
    for f in added:
        if not f.nullable:
            return Diff(breaking=f"new column {f.name} is required")
    return Diff(added)
