"""One batch of change records into tables: split, evolve, append, dead letters.

Batch and stream share `Ingest.batch`. Data stays in DataFrame expressions; the driver sees one
row a topic and partition, and one schema text for each distinct schema.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltflow.functions.redact import is_auth_failure, redact_error
from siltflow.functions.types import SchemaError, spark_schema
from siltflow.operators import quality
from siltflow.operators.evolution import Evolution, diff
from siltflow.operators.routing import Catalog, RoutingError, table_name
from siltflow.plans import flush
from siltflow.plans.config import IngestConfig
from siltflow.sources.records import decode
from siltflow.sources.storage import discard
from siltflow.sources.table import Result, TxnTable

STALE_AFTER_S = 40 * 60
RECORD = ("topic", "partition", "offset", "value")
FLUSH = (*quality.PART, "flush")
DEAD_LETTERS = T.StructType([T.StructField(*f) for f in (("topic", T.StringType()), ("partition", T.IntegerType()), ("offset", T.LongType()), ("value", T.StringType()), ("error", T.StringType()))])


class BackPressure(RuntimeError):
    """Too many records at once: nothing was taken; try again with fewer."""


class UnusableRecord(ValueError):
    """A record that no table takes, where there are no dead letters for it."""


@dataclass
class Outcome:
    """What a batch did: each table's results, and the next offset of each topic and partition."""

    tables: dict[str, list[Result]] = field(default_factory=dict)
    next_offsets: dict[tuple[str, int], int] = field(default_factory=dict)
    dead: int = 0
    errors: list[str] = field(default_factory=list)


class Ingest:
    def __init__(self, spark: SparkSession, config: IngestConfig, clock: Callable[[], float] = time.monotonic, catalog: Catalog | None = None, coordinator: Callable | None = None):
        """catalog: where tables are (by default below config.root); coordinator: who ratifies commits (by default nobody: the first to create a version's file has it)."""
        self.spark, self.config, self.clock, self.coordinator = spark, config, clock, coordinator
        self.catalog = catalog or Catalog(config.root, config.partition_columns)
        self._tables: dict[str, tuple[TxnTable, float]] = {}
        self._lock = threading.Lock()
        self._upkeep = ThreadPoolExecutor(1, thread_name_prefix="upkeep")
        self.dead_letters = TxnTable(spark, f"{config.root}/_dead_letters")

    # tables

    def table(self, name: str, schema: T.StructType | None = None) -> TxnTable:
        """The table of that name, resolved anew after 40 minutes; with a schema, a catalog may make it."""
        with self._lock:
            kept = self._tables.get(name)
            if kept is None or self.clock() - kept[1] >= STALE_AFTER_S:
                target = self.catalog.resolve(name, schema)
                conf = self.spark.sparkContext._jsc.hadoopConfiguration()
                for k, v in target.storage_conf.items():
                    conf.set(k, v)
                kept = self._tables[name] = (TxnTable(self.spark, target.path, coordinator=self.coordinator), self.clock())
            return kept[0]

    def forget(self, name: str) -> None:
        with self._lock:
            self._tables.pop(name, None)

    # a batch

    def batch(self, records: DataFrame) -> Outcome:
        """Ingests records (topic, partition, offset, value). Replays, in whatever cut, add nothing twice.

        records is read twice, however many tables there are: once for the schemas and offsets that
        it has, once for its rows. Rows that come in between the two are left.
        """
        rows = records.select("topic", "partition", "offset", "value", F.lit(0).cast("long").alias("flush"))
        outs = self._take(rows)
        return outs[0] if outs else Outcome()

    def buffers(self, records: DataFrame) -> list[Outcome]:
        """Ingests records with a number, flush, that goes up with the offsets of a partition: one commit a table for each, as `backlog` does.
        records is read twice, as in `batch`."""
        return self._take(records.select(*RECORD, "flush"))

    def backlog(self, records: DataFrame) -> list[Outcome]:
        """Ingests stored records as buffers with the dials flush_size and flush_bytes would have: one commit a table for each flush of theirs.

        records is read twice to number its rows by flush; these are stored until all is done. The flushes of a table in one schema are written
        by one job and committed in order.
        """
        planned = flush.plan(records.select("topic", "partition", "offset", "value"), max(self.config.flush_size, 0), max(self.config.flush_bytes, 0), F.octet_length("value"))
        folder = f"{self.config.root}/_dealt/{uuid.uuid4().hex}"
        try:
            planned.write.parquet(folder)
            return self._take(self.spark.read.schema(planned.schema).parquet(folder))
        finally:
            discard(self.spark, folder)

    def _take(self, rows: DataFrame) -> list[Outcome]:
        """Ingests rows by flush; an outcome each. Rows of a flush and more than one schema of a table are several commits."""
        parts = quality.reference_schemas(rows, FLUSH).collect()  # a row for each topic, partition and flush
        flushes = sorted({p.flush for p in parts})
        outs = {k: Outcome() for k in flushes}
        for k in flushes:
            if (n := sum(p.n for p in parts if p.flush == k)) > self.config.max_buffered > 0:
                raise BackPressure(f"{n} records; at most {self.config.max_buffered} are taken at once")
        by_table: dict[str, list] = {}
        for p in sorted(parts, key=lambda p: (p.flush, p.topic, p.partition)):
            by_table.setdefault(table_name(self.config.table_name_format, self.config.topic_to_table, p.topic), []).append(p)
        runs = {name: self._runs(own) for name, own in sorted(by_table.items())}
        with self._dealt(rows, [own for each in runs.values() for own in each]) as dealt, ThreadPoolExecutor(max(1, min(self.config.flush_concurrency, len(by_table) or 1))) as pool:
            jobs = {name: pool.submit(self._flush, dealt, name, own, outs) for name, own in runs.items()}
        failed = [j.exception() for j in jobs.values() if j.exception()]
        if failed:  # the other tables are done, and a replay skips them
            raise failed[0]
        return [outs[k] for k in flushes]

    def _runs(self, parts: list) -> list[list]:
        """The parts of one table, in order of their flushes, as runs that are written together: of one schema (and partition, if each commits by
        itself). A run goes on over flushes until the table's schema changes."""
        key = lambda p: (p.reference, p.topic, p.partition) if self.config.commit_per_partition else (p.reference,)
        one, runs, last = len({p.reference for p in parts}) == 1, {}, {}
        for p in parts:
            k = key(p)
            if k not in last or not (one or last[k][1] == p.flush or last[k][0] == len(runs) - 1):
                last[k] = (len(runs), p.flush)
            runs.setdefault(last[k][0], []).append(p)
            last[k] = (last[k][0], p.flush)
        return list(runs.values())

    @contextmanager
    def _dealt(self, rows: DataFrame, groups: list[list]) -> Iterator[Callable[[list], DataFrame]]:
        """Gives each group (partitions of one table and schema) its rows.

        Several groups are dealt to folders in one job before any is read, so the source isn't
        scanned for each. The rebalancing splits large groups over files and puts small ones into few.
        """
        if len(groups) < 2:
            yield lambda own: rows
            return
        number = {(p.topic, p.partition, p.flush): k for k, own in enumerate(groups) for p in own}
        places = self.spark.createDataFrame([(p.topic, p.partition, p.flush, p.last_offset, number[p.topic, p.partition, p.flush]) for own in groups for p in own], "topic string, `partition` int, flush long, last long, `group` int")
        folder = f"{self.config.root}/_dealt/{uuid.uuid4().hex}"
        mine = rows.join(F.broadcast(places), [*FLUSH]).filter("offset <= last").drop("last")
        try:
            mine.hint("rebalance", "group").write.partitionBy("group").parquet(folder)
            yield lambda own: self.spark.read.schema(rows.schema).parquet(f"{folder}/group={number[own[0].topic, own[0].partition, own[0].flush]}")
        finally:
            discard(self.spark, folder)

    def _flush(self, dealt: Callable[[list], DataFrame], name: str, runs: list[list], outs: dict[int, Outcome]) -> None:
        for own in runs:
            self._flush_schema(dealt(own), name, own[0].reference, own, outs)
            with self._lock:
                for p in own:
                    outs[p.flush].next_offsets[p.topic, p.partition] = p.last_offset + 1

    def _flush_schema(self, rows: DataFrame, name: str, reference: str | None, parts: list, outs: dict[int, Outcome]) -> None:
        """The partitions of one table whose reference schema is the same: one write, and one commit for each flush. What is set aside counts in the last one."""
        own = self.spark.createDataFrame([(p.topic, p.partition, p.flush, p.last_offset, p.heads) for p in parts], "topic string, `partition` int, flush long, last long, heads array<long>")
        topics = sorted({p.topic for p in parts})
        mine = rows.filter(F.col("topic").isin(topics)).join(F.broadcast(own), [*FLUSH]).filter("offset <= last").drop("last")
        stamps: dict[int, dict[str, int]] = {}
        for p in parts:
            stamps.setdefault(p.flush, {})[f"{self.config.name}:{p.topic}-{p.partition}"] = p.last_offset
        txns = {k: v for f in sorted(stamps) for k, v in stamps[f].items()}
        out = outs[max(stamps)]
        if reference is None:
            self._dead(mine, "no record of the partition has a usable schema", txns, name, out)
            return
        try:
            schema = spark_schema(reference)
            parsed = decode(quality.envelopes(mine), schema).withColumn("ok", F.col("ok") & quality.fits(F.col("heads")))
        except SchemaError as error:
            self._dead(mine, redact_error(error), txns, name, out)
            return
        set_aside = lambda: self._dead(parsed.filter("not ok").select(*RECORD), "not a record of the partition's schema", txns, name, out)
        try:
            table = self.table(name, schema if self.config.auto_create_tables else None)
            exists = table.exists()
            if exists and self.config.schema_evolution is not Evolution.NONE:
                change = diff(table.snapshot().schema, schema, self.config.schema_evolution is Evolution.MERGE)
                if change.breaking:
                    set_aside()
                    self._dead(parsed.filter("ok").select(*RECORD), f"schema change: {change.breaking}", txns, f"{name}/schema", out)
                    return
                if change.changed:
                    self.catalog.add_columns(name, schema, [f.name for f in change.added])
                    table.add_columns(list(change.added))
            elif not exists and not self.config.auto_create_tables:
                raise RoutingError(f"there is no table {name}, and auto_create_tables is off")
            if any(p.fit < p.n for p in parts) and not self.config.dead_letters:
                set_aside()
            seen = Observation()
            counted = parsed.select("topic", "partition", "offset", "flush", "ok", *(F.col("record")[f.name].alias(f"v{i}") for i, f in enumerate(schema))).observe(seen, F.count_if(~F.col("ok")).alias("bad"))
            values = counted.filter("ok")
            fresh = lambda df, applied: quality.not_applied(df, applied, self.config.name)
            named = lambda df, *more: df.select(*(F.col(f"v{i}").alias(f.name) for i, f in enumerate(schema)), *more)
            applied = table.snapshot().txns if exists else {}
            known = {k: applied[k] for k in txns if k in applied}

            def written() -> None:  # what can't be used is set aside before the rest is committed
                if _observed(seen, "bad") != 0:
                    set_aside()

            settings = {"partition_columns": list(self.config.partition_columns), "schema": schema, "written": written}
            if len(stamps) == 1:
                done = {max(stamps): table.append(named(fresh(values, known)), txns, fresh=_same_base(named, fresh, values, known), **settings)}
            else:
                done = table.append_each(named(fresh(values, known), "flush"), "flush", stamps, lambda k, applied: named(fresh(values.filter(F.col("flush") == k), applied)), **settings)
            with self._lock:
                for k, result in done.items():
                    outs[k].tables.setdefault(name, []).append(result)
            if any(r.applied for r in done.values()):
                self._upkeep.submit(_quietly, table.maintain)
        except (RoutingError, UnusableRecord):
            raise
        except Exception as error:
            self.forget(name)
            if is_auth_failure(error):  # not the records' fault, and no table takes them until it is mended
                raise PermissionError(f"table {name}: {redact_error(error)}") from None
            if not self.config.dead_letters:
                raise RuntimeError(f"table {name}: {redact_error(error)}") from None
            with self._lock:
                out.errors.append(redact_error(error))
            set_aside()
            self._dead(parsed.filter("ok").select(*RECORD), redact_error(error), txns, f"{name}/write", out)

    def _dead(self, records: DataFrame, error: str, txns: dict[str, int], kind: str, out: Outcome) -> None:
        """Sets records aside, once however often they are replayed; without dead letters they end the batch."""
        if not self.config.dead_letters:
            first = records.select("topic", "partition", "offset").first()
            if first is not None:
                raise UnusableRecord(f"unusable record at {first.topic}-{first.partition}@{first.offset}: {error}")
            return
        own = {f"dead:{kind}:{k}": v for k, v in txns.items()}
        rows = records.select("topic", "partition", "offset", "value", F.lit(error).alias("error"))
        key = F.concat(F.lit(f"dead:{kind}:"), quality.app_id(self.config.name))
        seen = self.dead_letters.snapshot().txns
        known = {k: seen[k] for k in own if k in seen}
        n = quality.not_applied(rows, known, self.config.name, key).count()
        if n:
            self.dead_letters.append(rows, own, fresh=lambda df, applied: quality.not_applied(df, applied, self.config.name, key), schema=DEAD_LETTERS)
            with self._lock:
                out.dead += n

    def close(self) -> None:
        """Waits for upkeep. Nothing is buffered, so nothing is lost: what isn't committed is replayed."""
        self._upkeep.shutdown(wait=True)


def _observed(seen: Observation, name: str) -> int | None:
    """An observed number; None where the plan lost it, as an adaptive one may when nothing is left to write."""
    try:
        return seen.get[name]
    except Py4JJavaError:
        return None


def _same_base(named, fresh, values, known):
    """For append: rows beyond what is applied, from the values again if another writer got on meanwhile."""
    return lambda df, applied: df if applied == known else named(fresh(values, applied))


def _quietly(work: Callable[[], object]) -> None:
    try:
        work()
    except Exception as error:  # the commit holds without it
        print(f"upkeep: {redact_error(error)}")
