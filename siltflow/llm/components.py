"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltflow.llm._common import cut, discard


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links neighbours (large: greater ones; else smaller ones and the vertex itself) to each vertex's least neighbour."""
    if large:
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m")).withColumn("m", F.least("w", "m"))
    joined = both.join(least, F.col("u") == F.col("w"))
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select(F.col("w").alias("u"), F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, root) for every vertex of edges (u, v: longs) but the roots; root: the least id reachable."""
    spark = edges.sparkSession
    now, path = cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "edges")
    seen = None
    for _ in range(max_rounds):
        then, old = cut(_star(_star(now, True), False), "edges")
        discard(spark, path)
        now, path = then, old
        mark = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if mark == seen:
            return now.select(F.col("u").alias("id"), F.col("v").alias("root"))
        seen = mark
    raise RuntimeError(f"components aren't settled after {max_rounds} rounds")
