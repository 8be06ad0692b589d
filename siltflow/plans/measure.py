"""Generators of change rows, and summaries of runs."""

from __future__ import annotations

import threading
import time
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

POOL = 10_000


def _op(i: Column) -> Column:
    return F.when(i % 13 == 0, "d").when(i % 7 == 0, "u").otherwise("c")


def flat_rows(spark: SparkSession, n: int, pool: int = POOL) -> DataFrame:
    """Flattened change rows: id, name, email, op, source_ts_ms, lsn."""
    i = F.col("id") % pool
    return spark.range(n).select(i.cast("int").alias("id"), F.concat(F.lit("name-"), i).alias("name"), F.concat(F.lit("user"), i, F.lit("@example.com")).alias("email"), _op(i).alias("op"), (F.lit(1_700_000_000_000) + i).alias("source_ts_ms"), i.alias("lsn"))


def envelope_rows(spark: SparkSession, n: int, pool: int = POOL) -> DataFrame:
    """Change envelopes: before (null for creates), after (null for deletes), op, ts_ms, source."""
    i = F.col("id") % pool
    row = F.struct(i.cast("int").alias("id"), F.concat(F.lit("name-"), i).alias("name"), F.concat(F.lit("user"), i, F.lit("@example.com")).alias("email"))
    op = _op(i)
    return spark.range(n).select(F.when(op != "c", row).alias("before"), F.when(op != "d", row).alias("after"), op.alias("op"), (F.lit(1_700_000_000_000) + i).alias("ts_ms"), F.struct(F.lit("shop").alias("db"), F.lit("customers").alias("table_name"), i.alias("lsn")).alias("source"))


def summary(rows: int, latencies_s: list[float], total_s: float) -> dict[str, float]:
    """Rows a second, and the commits' 50th and 99th percentile, least and greatest seconds."""
    s = sorted(latencies_s)
    n = len(s)
    return {"rows_per_s": rows / total_s if total_s > 0 else 0.0, "commits": n} | ({"p50_s": s[int(0.5 * n)], "p99_s": s[min(n - 1, int(0.99 * n))], "min_s": s[0], "max_s": s[-1]} if n else {})


@contextmanager
def sampled(every_s: float = 0.2):
    """A dict that has, at the end, the peak memory, mean and peak CPU share and peak threads of this process and its children."""
    import psutil

    out: dict[str, float] = {}
    stop = threading.Event()
    me = psutil.Process()
    cpu: list[float] = []

    def look():
        for p in (me, *me.children(recursive=True)):
            p.cpu_percent()
        while not stop.wait(every_s):
            try:
                all_ = (me, *me.children(recursive=True))
                out["peak_mb"] = max(out.get("peak_mb", 0), sum(p.memory_info().rss for p in all_) / 1e6)
                out["peak_threads"] = max(out.get("peak_threads", 0), sum(p.num_threads() for p in all_))
                cpu.append(sum(p.cpu_percent() for p in all_) / psutil.cpu_count())
            except psutil.Error:
                continue

    worker = threading.Thread(target=look, daemon=True)
    worker.start()
    try:
        yield out
    finally:
        stop.set()
        worker.join()
        if cpu:
            out |= {"mean_cpu": sum(cpu) / len(cpu), "peak_cpu": max(cpu)}


def append_many(tables: dict[str, object], rows: DataFrame, commits: int) -> dict[str, dict[str, float]]:
    """Appends rows to each table `commits` times, all tables at once; each table's summary."""
    n = rows.count()

    def one(table) -> dict[str, float]:
        began, took = time.perf_counter(), []
        for k in range(commits):
            t = time.perf_counter()
            table.append(rows, {"bench": k})
            took.append(time.perf_counter() - t)
        return summary(n * commits, took, time.perf_counter() - began)

    with ThreadPoolExecutor(len(tables)) as pool:
        return dict(zip(tables, pool.map(one, tables.values()), strict=True))
