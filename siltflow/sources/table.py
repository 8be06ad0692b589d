"""A versioned Parquet table with a JSON action log.

`<path>/_txn_log/<version>.json` holds one commit's actions: protocol and metaData (schema and
partition columns; the schema's nullability counts, Parquet's doesn't), add and remove (files),
txn (an application's latest applied version) and commitInfo. A version belongs to whoever
creates its file first. Data files are written before, so a failed commit leaves files that no
reader sees.

The state of a table is the last action of each path. Only the actions since the last checkpoint are
kept by the driver, and no more than `MAX_TAIL` of them; the rest is a DataFrame, replayed by an
aggregation over the checkpoint's parts and the log's files, and filtered before any path comes to the driver.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Protocol
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltflow.sources import stats as bounds
from siltflow.sources.storage import Storage, dumps, storage_for

LOG = "_txn_log"
POINTER = ".checkpoint.json"
CHECKPOINT_EVERY = 10
MAX_TRIES = 20
#: Actions, and bytes of log, that the driver replays by itself.
MAX_TAIL = 20_000
MAX_LOG_BYTES = 16 << 20
STATS_COLUMNS = 32
FILES_COLUMNS = ("path", "size", "partitionValues", "stats")
FILES = "path string, size bigint, partitionValues map<string,string>, stats string"
ACTIONS = f"add struct<{FILES.replace(' string', ':string').replace(' bigint', ':bigint').replace(' map', ':map')}>, remove struct<path:string>, metaData struct<schemaString:string,partitionColumns:array<string>>, txn struct<appId:string,version:bigint>, commitInfo string"


class CommitConflict(RuntimeError):
    """Another writer took the version, again and again, or changed what this commit rests on."""


class _Moved(Exception):
    """The table isn't as it was when files for it were written."""


def relaxed(kind: T.DataType) -> T.DataType:
    """The type with everything nullable, as Parquet gives it back."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, relaxed(f.dataType), True) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(relaxed(kind.elementType), True)
    if isinstance(kind, T.MapType):
        return T.MapType(kind.keyType, relaxed(kind.valueType), True)
    return kind


class Coordinator(Protocol):
    """Decides which staged commit gets a version; see StagedCommits."""

    def stage(self, version: int, text: str, tag: str) -> str: ...
    def ratify(self, version: int, name: str) -> bool: ...
    def publish(self) -> list[int]: ...


@dataclass
class Snapshot:
    """A version's schema and stamps, and its files: those of base but for what tail (path: add action, or None if removed) says."""

    version: int = -1
    schema: T.StructType | None = None
    partition_columns: list[str] = field(default_factory=list)
    txns: dict[str, int] = field(default_factory=dict)
    tail: dict[str, dict | None] = field(default_factory=dict)
    base: DataFrame | None = None

    def apply(self, version: int, actions: list[dict]) -> None:
        for a in actions:
            if m := a.get("metaData"):
                self.schema = T.StructType.fromJson(json.loads(m["schemaString"]))
                self.partition_columns = m.get("partitionColumns", [])
            elif m := a.get("add"):
                self.tail[m["path"]] = m
            elif m := a.get("remove"):
                if self.base is None:
                    self.tail.pop(m["path"], None)
                else:
                    self.tail[m["path"]] = None
            elif m := a.get("txn"):
                self.txns[m["appId"]] = max(m["version"], self.txns.get(m["appId"], m["version"]))
        self.version = version

    def copy(self) -> Snapshot:
        return Snapshot(self.version, self.schema, list(self.partition_columns), dict(self.txns), dict(self.tail), self.base)

    def adds(self, spark: SparkSession) -> DataFrame:
        """The files, a row each."""
        own = [(p, a["size"], a["partitionValues"], json.dumps(a["stats"]) if a.get("stats") else None) for p, a in self.tail.items() if a]
        out = spark.createDataFrame(own, FILES)
        if self.base is None:
            return out
        base = self.base
        if self.tail:  # MAX_TAIL paths at most
            base = base.join(F.broadcast(spark.createDataFrame([(p,) for p in self.tail], "path string")), "path", "left_anti")
        return base.select(out.columns).unionAll(out)

    @property
    def files(self) -> dict[str, dict]:
        """All files, on the driver: for small tables."""
        out = {} if self.base is None else {r.path: _add(r) for r in self.base.collect() if r.path not in self.tail}
        return out | {p: a for p, a in self.tail.items() if a}


def _add(row) -> dict:
    return {"path": row.path, "size": row.size, "partitionValues": row.partitionValues, "dataChange": True} | ({"stats": bounds.parsed(row.stats)} if row.stats else {})


@dataclass(frozen=True)
class Result:
    version: int
    applied: bool
    rows: int = 0
    files: int = 0
    bytes: int = 0


class TxnTable:
    """One table. Snapshots are kept between calls and brought up to date from newer versions only."""

    def __init__(self, spark: SparkSession, path: str, storage: Storage | None = None, coordinator: Callable[[Storage, str], Coordinator] | None = None, stats_columns: int = STATS_COLUMNS, max_tail: int = MAX_TAIL):
        """stats_columns: how many of a file's columns get bounds; max_tail: how many actions the driver keeps."""
        self.spark, self.path, self.stats_columns, self.max_tail = spark, path.rstrip("/"), stats_columns, max_tail
        self.storage = storage or storage_for(spark, path)
        self.coordinator = coordinator(self.storage, f"{self.path}/{LOG}") if coordinator else None
        self._kept: Snapshot | None = None
        self._lock = threading.RLock()

    # reading

    def _log(self, name: str) -> str:
        return f"{self.path}/{LOG}/{name}"

    def _versions(self) -> list[int]:
        return sorted(int(n[:20]) for n in self.storage.list(f"{self.path}/{LOG}") if len(n) == 25 and n.endswith(".json"))

    def _actions(self, version: int) -> list[dict]:
        """A commit's actions; none if the file is only in part there (a commit always ends with its commitInfo)."""
        try:
            actions = [json.loads(x) for x in self.storage.read(self._log(f"{version:020d}.json")).splitlines()]
        except ValueError:
            return []
        return actions if actions and "commitInfo" in actions[-1] else []

    def exists(self) -> bool:
        return self.snapshot().version >= 0

    def snapshot(self, version: int | None = None) -> Snapshot:
        """The table as of a version (the latest by default)."""
        with self._lock:
            if self.coordinator:
                self.coordinator.publish()  # what is ratified counts, whoever's turn it was to publish it
            sizes = dict(self.storage.sizes(f"{self.path}/{LOG}"))
            all_ = sorted(int(n[:20]) for n in sizes if len(n) == 25 and n.endswith(".json"))
            until = all_[-1] if all_ and version is None else -1 if version is None else version
            if version is not None and version not in all_:
                raise ValueError(f"there is no version {version} of {self.path}")
            base = self._kept.copy() if self._kept is not None and self._kept.version <= until else Snapshot()
            points = [int(n[:20]) for n in sizes if n.endswith(POINTER)]
            point = max((p for p in points if base.version < p <= until), default=None)
            if point is not None and point > base.version + 1:
                base = self._from_checkpoint(point)
            new = [v for v in all_ if base.version < v <= until]
            if sum(sizes[f"{v:020d}.json"] for v in new) > MAX_LOG_BYTES:
                base = self._replayed(until, max((p for p in points if p <= until), default=None), all_)
            for v in new:
                if base.version < v:
                    if not (actions := self._actions(v)):
                        break  # its writer isn't done, or died: the table is as it was before
                    base.apply(v, actions)
            if len(base.tail) > self.max_tail:
                base = self._replayed(base.version, max((p for p in points if p <= base.version), default=None), all_)
            if version is None:
                self._kept = base.copy()
            elif base.version != version:
                raise ValueError(f"version {version} of {self.path} isn't whole")
            return base

    def _replayed(self, until: int, point: int | None, versions: list[int]) -> Snapshot:
        """A snapshot whose files are a DataFrame: the last action of each path in a checkpoint and the log's files after it."""
        since = self._from_checkpoint(point) if point is not None else Snapshot()
        new = [v for v in versions if since.version < v <= until]
        if not new:
            return since
        log = self.spark.read.text([self._log(f"{v:020d}.json") for v in new]).select(F.from_json("value", ACTIONS).alias("a"), F.substring(F.col("_metadata.file_name"), 1, 20).cast("long").alias("v")).select("a.*", "v")
        # what isn't about files is small: a row a version, and one a stamp
        whole = {r.v for r in log.filter("commitInfo is not null").select("v").distinct().collect()}
        last = since.version
        for v in new:
            if v not in whole:
                break
            last = v
        log = log.filter(F.col("v") <= last)
        meta = log.filter("metaData is not null").agg(F.max_by("metaData", "v").alias("m")).first().m
        stamps = log.filter("txn is not null").groupBy("txn.appId").agg(F.max("txn.version").alias("version")).collect()
        out = Snapshot(last, since.schema, since.partition_columns, dict(since.txns))
        if meta:
            out.schema, out.partition_columns = T.StructType.fromJson(json.loads(meta.schemaString)), list(meta.partitionColumns or [])
        out.txns |= {r.appId: max(r.version, out.txns.get(r.appId, r.version)) for r in stamps}
        own = log.filter("add is not null or remove is not null").select(F.coalesce("add.path", "remove.path").alias("path"), "add", F.struct("v", F.col("add").isNotNull()).alias("at"))
        if since.base is not None:
            old = since.base.select("path", F.struct(*FILES_COLUMNS).alias("add"), F.struct(F.lit(-1).cast("long").alias("v"), F.lit(True)).alias("at"))
            own = old.unionAll(own)
        out.base = own.groupBy("path").agg(F.max_by(F.struct("add"), "at").alias("x")).filter("x.add is not null").select("x.add.*")
        return out

    def read(self, version: int | None = None, where: dict[str, object] | None = None) -> DataFrame:
        """The table's rows that meet conditions on columns: a value, a list or set of values, or `Between`.

        Files that can't hold such rows, by their partition's values or their columns' bounds, are left out unread.
        """
        snap = self.snapshot(version)
        if snap.schema is None:
            raise ValueError(f"there is no table at {self.path}")
        where = where or {}
        df = self._scan(self.plan(snap, where), snap.schema)
        rest = {k: w for k, w in where.items() if k not in snap.partition_columns or isinstance(w, bounds.Between)}
        return df.filter(bounds.row_filter(rest, snap.schema)) if rest else df

    def plan(self, snap: Snapshot, where: dict[str, object] | None = None) -> list[str]:
        """The paths to read for conditions: folders of which all files may hold such rows, and single files."""
        where = where or {}
        by_folder: dict[str, list[tuple[str, bool]]] = {}
        for p, a in snap.tail.items():
            if a:
                by_folder.setdefault(p.rpartition("/")[0], []).append((p, bounds.may_hold(a, where, snap.schema, snap.partition_columns)))
        paths = [x for folder, own in by_folder.items() for x in ([folder] if all(hit for _, hit in own) else [p for p, hit in own if hit])]
        if snap.base is not None:
            files = Snapshot(tail={p: None for p in snap.tail}, base=snap.base).adds(self.spark)
            hit = bounds.may_hold_column(where, snap.schema, snap.partition_columns)
            folders = files.select("path", F.regexp_replace("path", "/[^/]*$", "").alias("folder"), hit.alias("hit"))
            folders = folders.groupBy("folder").agg(F.every("hit").alias("whole"), F.collect_list(F.when(F.col("hit"), F.col("path"))).alias("hits"))
            wanted = F.when(F.col("whole"), F.array("folder")).otherwise(F.col("hits"))
            paths += [r[0] for r in folders.select(F.explode(wanted)).toLocalIterator()]
        return paths

    def skipped(self, where: dict[str, object], version: int | None = None) -> tuple[int, int]:
        """How many files a read with these conditions leaves out, and how many there are."""
        snap = self.snapshot(version)
        own = [bounds.may_hold(a, where, snap.schema, snap.partition_columns) for a in snap.tail.values() if a]
        n, hits = len(own), sum(own)
        if snap.base is not None:
            files = Snapshot(tail={p: None for p in snap.tail}, base=snap.base).adds(self.spark)
            got = files.agg(F.count("*").alias("n"), F.count_if(bounds.may_hold_column(where, snap.schema, snap.partition_columns)).alias("hits")).first()
            n, hits = n + got.n, hits + got.hits
        return n - hits, n

    def rows_by(self, column: str, version: int | None = None) -> dict[str, int]:
        """The rows of each value of a partition column, by the log alone."""
        snap = self.snapshot(version)
        out: dict[str, int] = {}
        for a in snap.tail.values():
            if a:
                value = a["partitionValues"].get(column)
                out[value] = out.get(value, 0) + a.get("stats", {}).get("n", 0)
        if snap.base is not None:
            files = Snapshot(tail={p: None for p in snap.tail}, base=snap.base).adds(self.spark)
            own = files.groupBy(F.try_element_at("partitionValues", F.lit(column)).alias("value")).agg(F.sum(F.get_json_object("stats", "$.n").cast("long")).alias("n"))
            for r in own.collect():  # a row a value
                out[r.value] = out.get(r.value, 0) + (r.n or 0)
        return out

    def read_since(self, version: int, until: int | None = None) -> DataFrame:
        """The rows that appends after a version, up to another (the latest by default), have added."""
        snap = self.snapshot(until)
        files = [a["add"]["path"] for v in self._versions() if version < v <= snap.version for a in self._actions(v) if "add" in a]
        gone = {a["remove"]["path"] for v in self._versions() if version < v <= snap.version for a in self._actions(v) if "remove" in a}
        return self._scan(_folders([p for p in files if p not in gone]), snap.schema)

    def _scan(self, paths: list[str], schema: T.StructType) -> DataFrame:
        nullable = relaxed(schema)
        if not paths:
            return self.spark.createDataFrame([], nullable)
        return self.spark.read.schema(nullable).option("recursiveFileLookup", True).parquet(*(f"{self.path}/{p}" for p in paths))

    def history(self) -> DataFrame:
        """One row a version: operation, mode, whether a blind append, rows, files and bytes written."""
        info = "struct<commitInfo:struct<timestamp:bigint,operation:string,isBlindAppend:boolean,operationParameters:struct<mode:string>,operationMetrics:map<string,string>>>"
        log = self.spark.read.text([self._log(f"{v:020d}.json") for v in self._versions()]).filter(F.col("value").startswith('{"commitInfo"'))
        rows = log.select(F.substring(F.col("_metadata.file_name"), 1, 20).cast("long").alias("version"), F.from_json("value", info)["commitInfo"].alias("i")).filter("i is not null")
        metrics = [F.try_element_at("i.operationMetrics", F.lit(k)).cast("long").alias(n) for k, n in (("numOutputRows", "num_output_rows"), ("numFiles", "num_files"), ("numOutputBytes", "num_output_bytes"))]
        return rows.select("version", "i.timestamp", "i.operation", F.col("i.operationParameters.mode").alias("mode"), F.col("i.isBlindAppend").alias("is_blind_append"), *metrics)

    # writing

    def _write_files(self, df: DataFrame, schema: T.StructType, partition_columns: list[str], each: str | None = None, tasks: int = 0) -> tuple[list[dict], int, int]:
        """Writes df's rows; add actions, rows and bytes. Required columns are checked on the way.

        each: a whole number of df, not stored, by which files are kept apart; their add actions have it, and their rows.
        tasks: by how many tasks the rows are written, dealt by the first partition column; 0: as df has them.
        """
        cols = []
        for f in schema:
            c = F.col(f"`{f.name}`")
            if not f.nullable:
                c = F.when(c.isNull(), F.raise_error(F.lit(f"required column {f.name} is null")).cast(relaxed(f.dataType))).otherwise(c)
            cols.append(c.cast(relaxed(f.dataType)).alias(f.name))
        seen = Observation()
        apart = [F.col(each).alias("_each")] if each else []
        df = df.select(*cols, *apart)
        if tasks:
            df = df.repartition(tasks, f"`{partition_columns[0]}`")
        if not each:
            df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        # partition columns stay in the files too, under their own names, so files can be read one by one
        by = [f"_by_{c}" for c in partition_columns]
        for c, name in zip(partition_columns, by, strict=True):
            df = df.withColumn(name, F.col(f"`{c}`"))
        folder = f"data/{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        if each:
            df = df.hint("rebalance", "_each")  # else each task would write a file for each
        writer, by = df.write.mode("errorifexists"), ["_each"] * bool(each) + by
        if tasks:  # tasks move their files themselves. One that is tried again has the same rows, so the same names: nothing is left of the first try
            writer = writer.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
        (writer.partitionBy(*by) if by else writer).parquet(f"{self.path}/{folder}")
        adds, size = [], 0
        for name, n in self.storage.files(f"{self.path}/{folder}"):
            values = {}
            for part in name.split("/")[:-1]:
                k, _, v = part.partition("=")
                values[k.removeprefix("_by_")] = None if v == "__HIVE_DEFAULT_PARTITION__" else unquote(v)
            number = values.pop("_each", None)
            adds.append({"add": {"path": f"{folder}/{name}", "size": n, "partitionValues": values, "dataChange": True}} | ({"each": int(number)} if each else {}))
            size += n
        fields = bounds.columns(schema, self.stats_columns)
        if adds and (fields or each):
            again = self.spark.read.schema(relaxed(schema)).option("recursiveFileLookup", True).parquet(f"{self.path}/{folder}")
            found = bounds.by_file(again, fields, F.col("_metadata.file_path")).collect()  # a row a file of this write
            by_path = {unquote(r.file).rpartition(f"/{folder}/")[2]: bounds.parsed(r.stats) for r in found}
            for a in adds:
                if (own := by_path.get(a["add"]["path"].removeprefix(f"{folder}/"))) is not None:
                    a["add"]["stats"] = own
        return adds, sum(a["add"]["stats"]["n"] for a in adds) if each else int(seen.get["rows"]), size

    @staticmethod
    def _meta(schema: T.StructType, partition_columns: list[str]) -> dict:
        return {"metaData": {"schemaString": schema.json(), "partitionColumns": partition_columns}}

    def commit(self, build: Callable[[Snapshot], list[dict] | None], after: int | None = None) -> Result:
        """Puts build(snapshot)'s actions at the next version; after a lost race builds anew. None: nothing to do.

        after: the version of this table's own last commit, where build may try on that first without a look at the log. If another
        has gone on, the next version is taken, and build gets the latest snapshot."""
        for k in range(MAX_TRIES):
            with self._lock:
                own = not k and after is not None and not self.coordinator and self._kept is not None and self._kept.version == after
                snap = self._kept if own else self.snapshot()
            actions = build(snap)
            if actions is None:
                return Result(snap.version, False)
            version = snap.version + 1
            if self._put(version, dumps(actions)):
                with self._lock:
                    snap.apply(version, actions)
                    self._kept = snap
                info = next((a["commitInfo"]["operationMetrics"] for a in actions if "commitInfo" in a), {})
                return Result(version, True, *(int(info.get(k, 0)) for k in ("numOutputRows", "numFiles", "numOutputBytes")))
        raise CommitConflict(f"no free version of {self.path} after {MAX_TRIES} tries")

    def _put(self, version: int, text: str) -> bool:
        """Takes a version: by creating its file, or, with a coordinator, by staging the commit, having it ratified and publishing it."""
        if not self.coordinator:
            return self.storage.create(self._log(f"{version:020d}.json"), text)
        name = self.coordinator.stage(version, text, uuid.uuid4().hex)
        won = self.coordinator.ratify(version, name)
        self.coordinator.publish()
        return won

    def create(self, schema: T.StructType, partition_columns: list[str] | None = None) -> Result:
        """Makes an empty table unless there is one."""
        return self.commit(lambda s: None if s.version >= 0 else [{"protocol": {"minReaderVersion": 1, "minWriterVersion": 1}}, self._meta(schema, partition_columns or []), self._info("CREATE TABLE", 0, 0, 0, mode=None)])

    def add_columns(self, fields: list[T.StructField]) -> Result:
        """Adds nullable columns that aren't there yet; old rows read as null."""

        def build(s: Snapshot):
            new = [f for f in fields if f.name not in s.schema.names]
            if not new:
                return None
            schema = T.StructType([*s.schema.fields, *(T.StructField(f.name, f.dataType, True) for f in new)])
            return [self._meta(schema, s.partition_columns), self._info("ADD COLUMNS", 0, 0, 0, mode=None)]

        return self.commit(build)

    @staticmethod
    def _info(operation: str, rows: int, files: int, size: int, mode: str | None = "Append") -> dict:
        info = {"timestamp": int(time.time() * 1000), "operation": operation, "isBlindAppend": mode == "Append", "operationMetrics": {"numOutputRows": str(rows), "numFiles": str(files), "numOutputBytes": str(size)}}
        return {"commitInfo": info | ({"operationParameters": {"mode": mode}} if mode else {})}

    def append(self, df: DataFrame, txns: dict[str, int] | None = None, fresh: Callable[[DataFrame, dict[str, int]], DataFrame] | None = None, partition_columns: list[str] | None = None, schema: T.StructType | None = None, written: Callable[[], None] | None = None) -> Result:
        """Adds df's rows in one commit that stamps txns; makes the table if there is none.

        Rows already applied are left out: without fresh, the append is skipped as a whole if every
        stamp is applied; fresh(df, applied versions) filters rows where stamps cover them in part.
        written: called once the files are there, before they are committed.
        """
        txns = dict(txns or {})
        schema = schema or df.schema
        wrote: dict[str, object] = {}

        def build(s: Snapshot):
            if txns and all(s.txns.get(k, -1) >= v for k, v in txns.items()):
                return None
            own = s.schema or schema
            if s.schema is not None and (problem := _mismatch(s.schema, schema)):
                raise ValueError(f"rows don't fit the table: {problem}")
            applied = {k: s.txns[k] for k in txns if k in s.txns}
            key = (json.dumps(applied, sort_keys=True), own.json())
            if wrote.get("key") != key:  # not yet written, or the race was lost to one who changed its base
                rows = fresh(df, applied) if fresh and applied else df
                missing = [f for f in own if f.name not in schema.names]
                rows = rows.withColumns({f.name: F.lit(None).cast(relaxed(f.dataType)) for f in missing}) if missing else rows
                wrote.update(key=key, files=self._write_files(rows, own, s.partition_columns if s.version >= 0 else partition_columns or []))
                if written:
                    written()
            adds, n, size = wrote["files"]
            head = [] if s.version >= 0 else [{"protocol": {"minReaderVersion": 1, "minWriterVersion": 1}}, self._meta(schema, partition_columns or [])]
            stamps = [{"txn": {"appId": k, "version": v}} for k, v in sorted(txns.items()) if s.txns.get(k, -1) < v]
            return [*head, *stamps, *adds, self._info("WRITE", n, len(adds), size)]

        return self.commit(build)

    def append_each(self, df: DataFrame, each: str, stamps: dict[int, dict[str, int]], fresh: Callable[[int, dict[str, int]], DataFrame], partition_columns: list[str] | None = None, schema: T.StructType | None = None, written: Callable[[], None] | None = None) -> dict[int, Result]:
        """Adds df's rows in one job, and commits them in order of the whole number each, with the stamps of each.

        df holds what isn't applied by now. If another writer gets on meanwhile, or changes the schema, what is left is written anew from
        fresh(number, applied versions), one by one. written as in append.
        """
        schema, snap = schema or T.StructType([f for f in df.schema if f.name != each]), self.snapshot()
        if snap.schema is not None and (problem := _mismatch(snap.schema, schema)):
            raise ValueError(f"rows don't fit the table: {problem}")
        own = snap.schema or schema
        live = {k: txns for k, txns in stamps.items() if any(snap.txns.get(a, -1) < v for a, v in txns.items())}
        out = {k: Result(snap.version, False) for k in stamps if k not in live}
        if not live:
            return out
        df = df.filter(F.col(each).isin(*live)) if out else df
        expected = {k: snap.txns.get(k, -1) for txns in stamps.values() for k in txns}
        missing = [f for f in own if f.name not in schema.names]
        rows = df.withColumns({f.name: F.lit(None).cast(relaxed(f.dataType)) for f in missing}) if missing else df
        adds, _, _ = self._write_files(rows, own, snap.partition_columns if snap.version >= 0 else partition_columns or [], each)
        if written:
            written()
        by_number, last = {}, None
        for a in adds:
            by_number.setdefault(a["each"], []).append({"add": a["add"]})
        for number, txns in sorted(live.items()):
            files = by_number.get(number, [])
            n, size = sum(a["add"]["stats"]["n"] for a in files), sum(a["add"]["size"] for a in files)

            def build(s: Snapshot, txns=txns, files=files, n=n, size=size):
                if all(s.txns.get(k, -1) >= v for k, v in txns.items()):
                    return None
                if (s.schema or schema) != own or any(s.txns.get(k, -1) != expected[k] for k in txns):
                    raise _Moved
                head = [] if s.version >= 0 else [{"protocol": {"minReaderVersion": 1, "minWriterVersion": 1}}, self._meta(schema, partition_columns or [])]
                return [*head, *({"txn": {"appId": k, "version": v}} for k, v in sorted(txns.items()) if s.txns.get(k, -1) < v), *files, self._info("WRITE", n, len(files), size)]

            try:
                out[number] = self.commit(build, last)
            except _Moved:
                applied = {k: v for k, v in self.snapshot().txns.items() if k in txns}
                out[number] = self.append(fresh(number, applied), txns, fresh=lambda _, now, k=number: fresh(k, now), partition_columns=partition_columns, schema=schema)
            expected |= {k: max(v, expected[k]) for k, v in txns.items()}
            last = out[number].version if out[number].applied else None
        return out

    def overwrite(self, df: DataFrame, txns: dict[str, int] | None = None, schema: T.StructType | None = None, partition_columns: list[str] | None = None, where: dict[str, set[str]] | None = None, read_version: int | None = None, touches: Callable[[dict[str, str]], bool] | None = None, tasks: int = 0) -> Result:
        """Replaces rows: one commit that removes files and adds new ones.

        where: of some partition columns the values whose files go; all files go by default.
        read_version: the version that df was made from (the latest now, by default). Commits since then are
        no conflict unless they added or removed files of these values or changed the schema.
        touches: whether files of some partition values are a conflict, where those in where don't say so.
        tasks: by how many tasks rows are written, dealt by the first partition column (0: as df has them).
        """
        schema, txns = schema or df.schema, dict(txns or {})
        wrote: list = []
        base: list[int] = []

        def build(s: Snapshot):
            if txns and all(s.txns.get(k, -1) >= v for k, v in txns.items()):
                return None
            base.append(s.version if read_version is None else read_version)
            if problem := self._overlap(base[0], s.version, where or {}, touches):
                raise CommitConflict(f"{self.path} changed while it was rewritten: {problem}")
            by = s.partition_columns if s.version >= 0 else partition_columns or []
            if not wrote:
                wrote.append(self._write_files(df, schema, by, tasks=tasks if by else 0))
            adds, n, size = wrote[0]
            head = [] if s.version >= 0 and s.schema == schema else [{"protocol": {"minReaderVersion": 1, "minWriterVersion": 1}}, self._meta(schema, by)]
            gone = [{"remove": {"path": r.path, "partitionValues": r.partitionValues, "dataChange": True}} for r in self._met(s, where or {})]
            return [*head, *({"txn": {"appId": k, "version": v}} for k, v in sorted(txns.items())), *gone, *adds, self._info("WRITE", n, len(adds), size, mode="Overwrite")]

        return self.commit(build)

    def _met(self, s: Snapshot, where: dict[str, set[str]]) -> list:
        """The files of some partition values."""
        values = {k: list(v) for k, v in where.items()}
        own = [Row(path=p, partitionValues=a["partitionValues"]) for p, a in s.tail.items() if a and all(a["partitionValues"].get(k) in v for k, v in values.items())]
        if s.base is not None:
            files = Snapshot(tail={p: None for p in s.tail}, base=s.base).adds(self.spark)
            own += files.filter(bounds.may_hold_column(values, s.schema, list(values))).select("path", "partitionValues").collect()
        return own

    def _overlap(self, base: int, now: int, where: dict[str, set[str]], touches: Callable[[dict[str, str]], bool] | None = None) -> str | None:
        """What commits after base have done to the rows that a rewrite of some partition values has read."""
        touches = touches or (lambda own: all(own.get(k) in values for k, values in where.items()))
        for v in range(base + 1, now + 1):
            for a in self._actions(v):
                if "metaData" in a:
                    return f"version {v} has another schema"
                m = a.get("add") or a.get("remove")
                if m and touches(m.get("partitionValues", {})):
                    return f"version {v} has changed the same rows"
        return None

    # upkeep

    def maintain(self, every: int = CHECKPOINT_EVERY) -> int | None:
        """Writes a checkpoint of the latest version that is a multiple of every; the version, if it is new.

        A checkpoint's files lie in a folder of their own; only once they are complete a pointer
        file says so, and readers go by pointers alone.
        """
        latest = max(self._versions(), default=-1)
        point = latest - latest % every
        if point <= 0 or f"{point:020d}{POINTER}" in self.storage.list(f"{self.path}/{LOG}"):
            return None
        snap = self.snapshot(point)
        none = [F.lit(None).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(FILES)]
        head = [("metaData", json.dumps(self._meta(snap.schema, snap.partition_columns)["metaData"]))]
        head += [("txn", json.dumps({"appId": k, "version": v})) for k, v in snap.txns.items()]
        folder = f"_checkpoints/{point:020d}-{uuid.uuid4().hex[:8]}"
        files = snap.adds(self.spark).select(F.lit("add").alias("kind"), F.lit(None).cast("string").alias("action"), *FILES_COLUMNS)
        if snap.base is None:
            files = files.coalesce(1)  # MAX_TAIL rows at most
        seen = Observation()
        files.unionAll(self.spark.createDataFrame(head, "kind string, action string").coalesce(1).select("kind", "action", *none)).observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(self._log(folder))
        return point if self.storage.create(self._log(f"{point:020d}{POINTER}"), dumps([{"folder": folder, "actions": int(seen.get["n"])}])) else None

    def _from_checkpoint(self, version: int) -> Snapshot:
        """A snapshot whose files are a checkpoint's; only schema and stamps come to the driver."""
        out = Snapshot()
        folder = json.loads(self.storage.read(self._log(f"{version:020d}{POINTER}")))["folder"]
        rows = self.spark.read.schema(f"kind string, action string, {FILES}").parquet(self._log(folder))
        out.apply(version, ({r.kind: json.loads(r.action)} for r in rows.filter("kind <> 'add'").select("kind", "action").collect()))
        out.base = rows.filter("kind = 'add'").select(*FILES_COLUMNS)
        return out


def _folders(files: list[str]) -> list[str]:
    """The innermost folders of files. One write fills such a folder and commits add or remove it as a whole, so it can be read as one path."""
    return list(dict.fromkeys(f.rpartition("/")[0] for f in files))


def _mismatch(table: T.StructType, rows: T.StructType) -> str | None:
    from siltflow.operators.evolution import same_type

    known = {f.name: f for f in table}
    if extra := [f.name for f in rows if f.name not in known]:
        return f"columns {extra} aren't in it"
    for f in rows:
        if not same_type(known[f.name].dataType, f.dataType):
            return f"column {f.name} is {known[f.name].dataType.simpleString()}, not {f.dataType.simpleString()}"
    if lacking := [f.name for f in table if f.name not in rows.names and not f.nullable]:
        return f"required columns {lacking} are missing"
    return None
