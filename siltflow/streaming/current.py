"""Current rows kept by a stream: state by key says which change was the last, and only newer ones go to the table.

The state of a key is the sequence of its last change, not its row. What the stream emits in a micro-batch is at most one change a
key, so changes that come late or again rewrite nothing; the table's own rule (see `apply_changes`) holds beside it, as state of
deleted keys may be given up after a time.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from siltflow.operators import cdc
from siltflow.sources.table import TxnTable

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers needn't have this package

OP, PROVIDER = "__op", "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class LastChange(StatefulProcessor):
    """Lets a key's newest change of a micro-batch through, if it is newer than all before."""

    def __init__(self, names: list[str], sequence_by: list[str], state: T.StructType, keep_deletes_ms: int):
        self.names, self.sequence_by, self.state, self.keep = names, sequence_by, state, keep_deletes_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.last = handle, handle.getValueState("last", self.state)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        rank = lambda values: tuple((v is not None, v) for v in values)  # noqa: E731  nulls first, as in Spark
        best = known = self.last.get() if self.last.exists() else None
        found = None
        for row in rows:
            own = tuple(row[c] for c in self.sequence_by)
            if best is None or rank(own) > rank(best):
                best, found = own, row
        if found is not None:
            self.last.update(best)
            if self.keep > 0:
                for at in list(self.handle.listTimers()) if known is not None else []:
                    self.handle.deleteTimer(at)
                if found[OP] == "d":
                    self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.keep)
            yield Row(**{c: found[c] for c in self.names})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.last.clear()
        yield from ()

    def close(self) -> None:
        pass


def changes(stream: DataFrame, keys: list[str], sequence_by: list[str], columns: list[str], apply_as_deletes: Column | None = None, keep_deletes_ms: int = 0) -> DataFrame:
    """The changes that alter a current row, as a stream: columns, sequence_by and __op ('d' or 'u').

    Of changes with one sequence the first stays. keep_deletes_ms: how long the state of a deleted key is kept (0: always); the
    stream then runs micro-batches without data as well, to see to its timers.
    """
    op = F.when(F.coalesce(apply_as_deletes if apply_as_deletes is not None else F.col("op") == "d", F.lit(False)), "d").otherwise("u")
    names = list(dict.fromkeys([*keys, *columns, *sequence_by]))
    rows = stream.select(*names, op.alias(OP))
    state = T.StructType([T.StructField(f"s{k}", rows.schema[c].dataType) for k, c in enumerate(sequence_by)])
    out = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])
    return rows.groupBy(*keys).transformWithState(LastChange(out.names, sequence_by, state, keep_deletes_ms), out, "Update", "ProcessingTime" if keep_deletes_ms > 0 else "None")


def start_current(stream: DataFrame, target: TxnTable, keys: list[str], sequence_by: list[str], columns: list[str], checkpoint: str, name: str = "current", apply_as_deletes: Column | None = None, keep_deletes_ms: int = 0, available_now: bool = False, **settings) -> StreamingQuery:
    """Keeps target (see `cdc.current`) up to date with a stream of changes. A micro-batch is a commit, whose stamp makes a repetition nothing."""
    spark = stream.sparkSession

    def take(batch: DataFrame, batch_id: int) -> None:
        stamp = f"stream:{name}"
        if not target.exists() or target.snapshot().txns.get(stamp, -1) < batch_id:
            cdc.apply_changes(batch, target, keys, sequence_by, columns, F.col(OP) == "d", txns={stamp: batch_id}, **settings)

    writer = changes(stream, keys, sequence_by, columns, apply_as_deletes, keep_deletes_ms).writeStream.foreachBatch(take).outputMode("update").option("checkpointLocation", checkpoint)
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)  # a query keeps the settings that it was started with
    try:
        return (writer.trigger(availableNow=True) if available_now else writer).start()
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)
