"""Streaming ingestion: each micro-batch is one batch of `Ingest`.

The streaming checkpoint holds what was read; the tables' own stamps hold what was applied, so a
micro-batch that is delivered again after a crash adds nothing twice, whichever of its tables
were committed before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from siltflow.plans.config import IngestConfig
from siltflow.plans.ingest import Ingest, Outcome
from siltflow.sources.admission import StoredRecords, between
from siltflow.sources.records import kafka_records


class StreamSink:
    def __init__(self, ingest: Ingest):
        self.ingest = ingest
        self.outcomes: list[Outcome] = []

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.outcomes = [*self.outcomes[-99:], self.ingest.batch(batch)]

    def buffers(self, batch: DataFrame) -> None:
        """A batch whose flush says which buffer each row is of."""
        self.outcomes = [*self.outcomes, *self.ingest.buffers(batch)][-100:]


#: Buffers of a topic and partition in a micro-batch of stored records.
BUFFERS = 200


def start(records: DataFrame, ingest: Ingest, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Starts ingesting a streaming DataFrame of records; flush_interval_ms is the trigger's interval."""
    writer = records.writeStream.foreachBatch(StreamSink(ingest)).option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True).start()
    interval = ingest.config.flush_interval_ms
    return (writer.trigger(processingTime=f"{interval} milliseconds") if interval > 0 else writer).start()


def start_topics(spark: SparkSession, servers: str, ingest: Ingest, checkpoint: str, topics: list[str] | None = None, pattern: str | None = None, reader: Callable[..., DataFrame] = kafka_records, available_now: bool = False, **options: str) -> StreamingQuery:
    """Starts ingesting a subscription, with the dials as options of its source."""
    return start(reader(spark, servers, topics, pattern, True, **(admission_options(ingest.config) | options)), ingest, checkpoint, available_now)


def start_stored(spark: SparkSession, path: str, ingest: Ingest, checkpoint: str, **options: str) -> StreamingQuery:
    """Starts ingesting records that `admission.store` keeps, as buffers with the dials by rows, bytes and time would.

    A commit of each table has of each topic and partition what makes a dial trip; the others wait. With
    wait_ms="0" what is left under the dials goes at once, for a run to the end (`processAllAvailable`). A micro-batch has
    all buffers that are full by then, up to BUFFERS of a topic and partition (option buffers): they are read and written
    together, and committed one after the other.
    """
    spark.dataSource.register(StoredRecords)
    c = ingest.config
    dials = {"rows": max(c.flush_size, 0), "bytes": max(c.flush_bytes, 0), "wait_ms": max(c.flush_interval_ms, 0), "most": max(c.max_buffered, 0), "buffers": BUFFERS}
    ranges = spark.readStream.format(StoredRecords.name()).options(path=path, **{k: str(v) for k, v in dials.items()} | options).load()
    sink = StreamSink(ingest)

    def take(batch: DataFrame, batch_id: int) -> None:
        own = batch.collect()  # a row a buffer
        if own:
            sink.buffers(between(batch.sparkSession, path, own))

    return ranges.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).start()


def admission_options(config: IngestConfig) -> dict[str, str]:
    """Options of the Kafka source that stand for the row dial, its longest wait, and back-pressure."""
    out = {"maxOffsetsPerTrigger": str(config.max_buffered)}
    if config.flush_size > 0:
        out["minOffsetsPerTrigger"] = str(config.flush_size)
        if config.flush_interval_ms > 0:
            out["maxTriggerDelay"] = f"{config.flush_interval_ms}ms"
    return out
