"""Stored records as a stream whose micro-batches are cut by rows and bytes of each topic and partition.

`store` appends records to a folder: the records below `data/<append>`, and below `index/<append>` a row for
each range of `span` offsets of a topic and partition, with its rows, bytes, last offset and the size at each offset. An
append counts once its index is complete. Appends go up in offsets, as a log does: what comes later with an
offset that the stream has passed isn't read.

The stream's source reads the index alone. Its rows are ranges of offsets, one for each buffer that a dial lets
through, and `between` reads their records with Spark, numbered by buffer. It looks at the ranges from the next offset
on, at as many as the dial's rows of a batch's buffers take up, so its work and memory go with the batch and not with the backlog.
"""

from __future__ import annotations

import json
import sys
import time
import uuid
from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.fs as fs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the source's process needn't have this package

#: Offsets of an index row.
SPAN = 4096
#: Bytes of a row group of the index, and index rows whose sizes are read at once.
GROUP_BYTES, AHEAD = 8 << 20, 64
RECORDS = "topic string, `partition` int, offset long, value string"
RANGES = "topic string, `partition` int, low long, high long, appends string"


def store(records: DataFrame, path: str, span: int = SPAN) -> str:
    """Appends records (topic, partition, offset: not null; value) and their index; the append's name."""
    name = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    by = ["topic", "partition", "offset"]
    rows = records.selectExpr("topic", "cast(`partition` as int) as `partition`", "cast(offset as long) as offset", "value")
    rows.repartitionByRange(*by).sortWithinPartitions(*by).write.parquet(f"{path}/data/{name}")
    stored = records.sparkSession.read.schema(RECORDS).parquet(f"{path}/data/{name}")
    # an offset that comes again counts with all its rows, so a range has no more than span entries
    each = stored.groupBy(*by).agg(F.count("*").alias("n"), F.sum(F.coalesce(F.octet_length("value"), F.lit(0))).cast("long").alias("size"))
    each = each.withColumn("chunk", F.floor(F.col("offset") / span))
    index = each.groupBy("topic", "partition", "chunk").agg(
        F.sum("n").alias("rows"), F.sum("size").alias("bytes"), F.max("offset").alias("last"), F.collect_list(F.struct("offset", "n", "size")).alias("sizes")
    )
    index.hint("rebalance", "topic", "partition").sortWithinPartitions("topic", "partition", "chunk").write.option("parquet.block.size", GROUP_BYTES).partitionBy("topic", "partition").parquet(f"{path}/index/{name}")
    return name


def between(spark: SparkSession, path: str, ranges: list[Row]) -> DataFrame:
    """The records of ranges, by their bounds of offsets, and in flush which range of their topic and partition it is, from 0."""
    appends = sorted({a for r in ranges for a in r.appends.split(",") if a})
    if not appends:
        return spark.createDataFrame([], f"{RECORDS}, flush long")
    numbered, seen = [], {}
    for r in sorted(ranges, key=lambda r: (r.topic, r.partition, r.low)):
        k = seen[r.topic, r.partition] = seen.get((r.topic, r.partition), -1) + 1
        numbered.append((r.topic, r.partition, r.low, r.high, k))
    own = spark.createDataFrame(numbered, "topic string, `partition` int, low long, high long, flush long")
    rows = spark.read.schema(RECORDS).parquet(*(f"{path}/data/{a}" for a in appends))
    rows = rows.filter(F.col("topic").isin(sorted({r.topic for r in ranges})) & (F.col("offset") >= min(r.low for r in ranges)) & (F.col("offset") < max(r.high for r in ranges)))
    return rows.join(F.broadcast(own), ["topic", "partition"]).filter("offset >= low and offset < high").select("topic", "partition", "offset", "value", "flush")


class StoredRecords(DataSource):
    """Options: path; rows and bytes (a topic and partition is let through once it has as many, 0: off), wait_ms (or once its
    first record has waited so long), most (rows of a batch over all, 0: off), buffers (of a topic and partition in a batch, at most),
    span as it was stored."""

    @classmethod
    def name(cls) -> str:
        return "stored_records"

    def schema(self) -> str:
        return RANGES

    def simpleStreamReader(self, schema):
        return Admission(dict(self.options))


class Admission(SimpleDataSourceStreamReader):
    """Offsets are the next offset of each topic and partition, so a stream that starts again goes on where its checkpoint says."""

    def __init__(self, options: dict[str, str], clock=time.monotonic):
        number = lambda k, default: int(options.get(k, default))
        self.rows, self.bytes, self.wait, self.most, self.span = number("rows", 0), number("bytes", 0), number("wait_ms", 0) / 1000, number("most", 0), number("span", SPAN)
        self.rows, self.buffers = min((x for x in (self.rows, self.most) if x > 0), default=0), max(1, number("buffers", 1))
        self.path, self.clock, self.turn = options["path"].rstrip("/"), clock, ""
        self.files: dict[str, list[tuple[str, int, int, list[str]]]] = {}  # by topic and partition: append, first and last range, files
        self.known: set[str] = set()
        self.since: dict[str, float] = {}
        self.idle: dict[str, tuple[int, int]] = {}  # where a topic and partition had nothing more, and among how many appends

    def _storage(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path) if ":" in self.path else (fs.LocalFileSystem(), self.path)

    def _discover(self) -> None:
        """Takes in the indexes that have been completed since."""
        storage, root = self._storage()
        folders = storage.get_file_info(fs.FileSelector(f"{root}/index", allow_not_found=True))
        for folder in sorted(f.path for f in folders if f.type == fs.FileType.Directory):
            name = folder.rpartition("/")[2]
            if name in self.known or storage.get_file_info(f"{folder}/_SUCCESS").type != fs.FileType.File:
                continue
            by_key: dict[str, list[str]] = {}
            for f in storage.get_file_info(fs.FileSelector(folder, recursive=True)):
                if f.path.endswith(".parquet"):
                    topic, partition = (unquote(x.partition("=")[2]) for x in f.path.split("/")[-3:-1])
                    by_key.setdefault(json.dumps([topic, int(partition)]), []).append(f.path)
            for key, files in by_key.items():
                low, high = [], []
                for f in files:
                    meta = pq.read_metadata(f, filesystem=storage)
                    at = meta.schema.names.index("chunk")
                    stats = [meta.row_group(k).column(at).statistics for k in range(meta.num_row_groups)]
                    low += [s.min for s in stats]
                    high += [s.max for s in stats]
                if low:
                    self.files.setdefault(key, []).append((name, min(low), max(high), files))
            self.known.add(name)

    def _ranges_of(self, key: str, low: int, high: int, columns: list[str]) -> list[dict]:
        """The index rows of a topic and partition from one range to another, in order."""
        files = [f for _, first, last, own in self.files.get(key, []) if first <= high and last >= low for f in own]
        if not files:
            return []
        storage, _ = self._storage()
        found = ds.dataset(files, filesystem=storage, format="parquet").to_table(columns=columns, filter=(pc.field("chunk") >= low) & (pc.field("chunk") <= high))
        out = found.drop_columns([c for c in columns if c == "sizes"]).to_pylist()
        if "sizes" in columns:  # a range's entries as arrays
            lists = pa.chunked_array(found["sizes"], found["sizes"].type).combine_chunks()
            ends = np.concatenate(([0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)))).astype(int)
            entries = lists.flatten()
            arrays = [entries.field(c).to_numpy(zero_copy_only=False) for c in ("offset", "n", "size")]
            for k, r in enumerate(out):
                r["sizes"] = [x[ends[k] : ends[k + 1]] for x in arrays]
        return sorted(out, key=lambda r: r["chunk"])

    def _sizes(self, key: str, low: int, high: int) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The offsets, rows and bytes of ranges, by offset."""
        found: dict[int, list] = {}
        for r in self._ranges_of(key, low, high, ["chunk", "sizes"]):
            found.setdefault(r["chunk"], []).append(r["sizes"])
        out = {}
        for chunk, own in found.items():
            offsets, n, size = (np.concatenate(x) for x in zip(*own, strict=True))
            order = np.argsort(offsets, kind="stable")
            out[chunk] = offsets[order], n[order], size[order]
        return out

    def _cuts(self, key: str, start: int, most: float, until: float = float("inf")) -> list[tuple[int, int, bool]]:
        """Buffers from start on (and below until), most of them at most: the offset after each one's last record, its rows, and whether a dial
        has tripped, which is so for all but the last."""
        out: list[tuple[int, int, bool]] = []
        if self.idle.get(key) == (start, len(self.files[key])):
            return out
        rows = size = 0
        last = max(x for _, _, x, _ in self.files[key])
        at, end, width = start // self.span, start, max(2, int(min(most, AHEAD)) * self.rows // self.span + 2)
        sizes: dict[int, tuple] = {}
        while at <= last and at * self.span < until:
            found: dict[int, list[int]] = {}
            for r in self._ranges_of(key, at, at + width - 1, ["chunk", "rows", "bytes", "last"]):
                own = found.setdefault(r["chunk"], [0, 0, 0])  # appends may meet inside a range
                found[r["chunk"]] = [own[0] + r["rows"], own[1] + r["bytes"], max(own[2], r["last"])]
            for chunk, (n, b, upto) in sorted(found.items()):
                if chunk * self.span >= until:
                    break
                if chunk * self.span >= start and upto < until and not (0 < self.rows <= rows + n or 0 < self.bytes <= size + b):
                    rows, size, end = rows + n, size + b, upto + 1
                    sizes.pop(chunk, None)
                    continue
                if chunk not in sizes:
                    ahead = min(most - len(out), AHEAD)  # as many ranges as the buffers to come may take
                    sizes = self._sizes(key, chunk, chunk + (0 if ahead <= 1 else min(AHEAD, int(ahead) * self.rows // self.span) if self.rows else AHEAD))
                offsets, each_n, each_size = sizes.pop(chunk)
                inside = (offsets >= start) & (offsets < until)
                offsets, each_n, each_size = offsets[inside], np.cumsum(each_n[inside]), np.cumsum(each_size[inside])
                i = base_n = base_size = 0
                while i < len(offsets):
                    by_rows = np.searchsorted(each_n, self.rows - rows + base_n) if self.rows > 0 else len(offsets)
                    by_bytes = np.searchsorted(each_size, self.bytes - size + base_size) if self.bytes > 0 else len(offsets)
                    j = max(i, min(int(by_rows), int(by_bytes)))
                    upto = min(j, len(offsets) - 1)
                    rows, size, end = rows + int(each_n[upto]) - base_n, size + int(each_size[upto]) - base_size, int(offsets[upto]) + 1
                    i, base_n, base_size = upto + 1, int(each_n[upto]), int(each_size[upto])
                    if j == upto:
                        out.append((end, rows, True))
                        if len(out) >= most:
                            return out
                        rows = size = 0
            at, width = at + width, min(width * 2, 1 << 16)
        if rows:
            out.append((end, rows, False))
        elif not out:
            self.idle[key] = (start, len(self.files[key]))
        return out

    def _admitted(self, start: dict, end: dict) -> Iterator[tuple]:
        """A row for each buffer between two offsets."""
        out = []
        for key in sorted(end):
            low, high = start.get(key, 0), end[key]
            if high > low:
                topic, partition = json.loads(key)
                ends = [x for x, _, _ in self._cuts(key, low, float("inf"), high)] if self.buffers > 1 and key in self.files else []
                for upto in [*ends[:-1], high]:
                    names = [name for name, first, last, _ in self.files.get(key, []) if first * self.span < upto and (last + 1) * self.span > low]
                    out.append((topic, partition, low, upto, ",".join(names)))
                    low = upto
        return iter(out)

    def initialOffset(self) -> dict:
        return {}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        self._discover()
        end, total, now, held = dict(start), 0, self.clock(), False
        keys = sorted(self.files)
        for key in [k for k in keys if k > self.turn] + [k for k in keys if k <= self.turn]:  # whoever is held back is first next time
            cuts = self._cuts(key, start.get(key, 0), self.buffers)
            if not cuts or cuts[-1][2]:
                self.since.pop(key, None)
            elif len(cuts) > 1:
                self.since[key] = now  # the last one only waits since the others are full
            for upto, rows, full in cuts:
                if not full and now - self.since.setdefault(key, now) < self.wait:
                    break
                if total and 0 < self.most < total + rows:
                    held = True
                    break
                end[key], total, self.turn = upto, total + rows, key
                if not full:
                    self.since.pop(key, None)
            if held:
                break
        return self._admitted(start, end), dict(sorted(end.items()))

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        self._discover()
        return self._admitted(start, end)
