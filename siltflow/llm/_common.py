"""What the text operators share: scratch tables, worker imports, Arrow maps."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

_OWN_DIRS: dict[str, str] = {}
_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


def ready(spark: SparkSession) -> None:
    """Lets Python workers import this package (a cluster may ship it with --py-files instead)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(x for x in (root, env.get("PYTHONPATH", "")) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder that spark.checkpoint.dir names; where it is unset one of our own, but on a single machine only."""
    base, app = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.applicationId
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        if app not in _OWN_DIRS:
            _OWN_DIRS[app] = tempfile.mkdtemp(prefix="siltflow-")
        base = f"file://{_OWN_DIRS[app]}"
    return f"{base.rstrip('/')}/siltflow-llm-{app}"


def clear_scratch(spark: SparkSession) -> None:
    """Removes this application's scratch tables; call it once all results are written."""
    discard(spark, scratch_dir(spark))


def cut(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Writes df to the shared folder and reads it back: lineage ends there and survives lost executors."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    for made in _SCOPES.get():
        made.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


@contextmanager
def scoped() -> Iterator[list[str]]:
    """The list of the scratch tables that are made inside, for whoever knows when they aren't read any more."""
    made: list[str] = []
    token = _SCOPES.set((*_SCOPES.get(), made))
    try:
        yield made
    finally:
        _SCOPES.reset(token)


def discard(spark: SparkSession, path: str) -> None:
    """Removes a scratch table that no later plan reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def give_back() -> None:
    """Returns freed memory to the machine: workers outlive their tasks, and the next one's needs come on top."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def arrow_map(df: DataFrame, make: Callable[[], Callable[..., dict]], schema: str) -> DataFrame:
    """mapInArrow with state per task.

    make() runs once in each task and gives a function from the batch's columns, as lists in
    df's order, to a dict of output columns (or None). If it gives two functions, the second is
    called without arguments after the last batch.
    """
    ready(df.sparkSession)
    spark_schema = T.StructType.fromDDL(schema)
    out_schema = to_arrow_schema(spark_schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from mapped(batches)
        finally:
            give_back()

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn, end = made if isinstance(made := make(), tuple) else (made, None)
        build = lambda out: pa.RecordBatch.from_pydict({f.name: pa.array(out[f.name], f.type) for f in out_schema}, schema=out_schema)
        for batch in batches:
            step = max(1, batch.num_rows // max(1, batch.nbytes // 16_000_000 + 1))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                out = fn(*(c.to_pylist() for c in part.columns))
                if out is not None:
                    yield build(out)
        if end is not None:
            yield build(end())

    return df.mapInArrow(run, spark_schema)
