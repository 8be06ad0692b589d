"""Flush planning for stored records: which rows a size- or byte-limited buffer would commit together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


#: Offsets of a range that one task numbers.
SPAN = 1 << 16


def plan(records: DataFrame, flush_size: int = 0, flush_bytes: int = 0, size: Column | None = None, keys: tuple[str, ...] = ("topic", "partition"), order: str = "offset", span: int = SPAN) -> DataFrame:
    """Adds flush: the number of the commit of each row, by rows, by bytes, or by whichever trips first in steps of each.

    By rows a commit holds flush_size rows; by bytes a row starts a new commit once the bytes
    before it have passed another multiple of flush_bytes. A dial of 0 is off.

    Prefix sums in two levels: rows and bytes of each range of offsets (span of them) are summed up, and rows are
    numbered within their range from where the ranges before it end. So a partition of any length is spread over tasks
    by its ranges, and records is read twice. keys and order mustn't be null.
    """
    if flush_size <= 0 and flush_bytes <= 0:
        return records.withColumn("flush", F.lit(0).cast("long"))
    own = [*keys, "__range"]
    rows = records.withColumns({"__range": F.floor(F.col(order) / span), "__size": F.coalesce(size, F.lit(0)).cast("long") if flush_bytes > 0 else F.lit(0).cast("long")})
    earlier = W.partitionBy(*keys).orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    ranges = rows.groupBy(*own).agg(F.count("*").alias("__rows"), F.sum("__size").alias("__bytes"))
    ranges = ranges.select(*own, *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c) for c in ("__rows", "__bytes")))
    within = W.partitionBy(*own).orderBy(order)
    out = F.lit(0).cast("long")
    rows = rows.join(ranges, own)
    if flush_size > 0:
        out = F.floor((F.col("__rows") + F.row_number().over(within) - 1) / flush_size).cast("long")
    if flush_bytes > 0:
        before = F.col("__bytes") + F.coalesce(F.sum("__size").over(within.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        steps = F.floor(before / flush_bytes).cast("long")
        out = steps if flush_size <= 0 else F.greatest(out, steps)
    return rows.withColumn("flush", out).select(*records.columns, "flush")
