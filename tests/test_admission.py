import json
import random
import time

import pytest
from pyspark.sql import functions as F

from siltflow.plans.config import IngestConfig
from siltflow.plans.ingest import Ingest
from siltflow.sources import admission
from siltflow.sources.records import encode
from siltflow.streaming import sink


def key(topic, partition):
    return json.dumps([topic, partition])


def stored(spark, path, rows, span=8):
    return admission.store(spark.createDataFrame(rows, "topic string, `partition` int, offset long, value string"), path, span)


def buffers(rows, rows_dial, bytes_dial):
    """What one buffer after the other would hold, by hand: [(first offset, offset after the last, rows)]."""
    out, n, size, low = [], 0, 0, 0
    by_offset = {}
    for o, v in rows:
        by_offset.setdefault(o, []).append(v)
    for o in sorted(by_offset):
        n, size = n + len(by_offset[o]), size + sum(len((v or "").encode()) for v in by_offset[o])
        if 0 < rows_dial <= n or 0 < bytes_dial <= size:
            out.append((low, o + 1, n))
            n, size, low = 0, 0, o + 1
    return out + ([(low, max(by_offset) + 1, n)] if n else [])


@pytest.mark.parametrize("rows_dial,bytes_dial", [(7, 0), (0, 40), (25, 60), (8, 0), (1, 1), (500, 0), (0, 0)])
def test_cuts_are_those_of_a_buffer(spark, tmp_path, rows_dial, bytes_dial):
    rng = random.Random(3)
    offsets = sorted(rng.sample(range(400), 150)) + [900, 901, 5_000]  # gaps of many ranges
    own = [(o, rng.choice([None, "", "x", "é" * rng.randint(1, 9), "y" * 70])) for o in offsets]
    own += [own[20], own[20]]  # an offset that comes again
    for part in (own[:60], own[60:]):  # the appends meet inside a range
        stored(spark, f"{tmp_path}/in", [("t/a b=%", 3, o, v) for o, v in part])
    reader = admission.Admission({"path": f"{tmp_path}/in", "rows": str(rows_dial), "bytes": str(bytes_dial), "span": "8"})
    at, got = {}, []
    while True:
        ranges, end = reader.read(at)
        if end == at:
            assert list(ranges) == []
            break
        ((topic, partition, low, high, appends),) = ranges
        assert (topic, partition) == ("t/a b=%", 3) and list(reader.readBetweenOffsets(at, end)) == [(topic, partition, low, high, appends)]
        n = admission.between(spark, f"{tmp_path}/in", [type("R", (), {"topic": topic, "partition": partition, "low": low, "high": high, "appends": appends})()]).count() if len(got) < 3 else None
        got.append((low, high, n))
        at = end
    want = buffers(sorted(own, key=lambda r: r[0]), rows_dial, bytes_dial)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got[:3]] == [w[2] for w in want[:3]]


def test_waiting_and_turns(spark, tmp_path):
    clock = [0.0]
    path = f"{tmp_path}/in"
    assert admission.Admission({"path": path}).read({})[1] == {}  # nothing is stored yet
    stored(spark, path, [("a", p, o, "v") for p in (0, 1, 2) for o in range(10 + p)])
    reader = admission.Admission({"path": path, "rows": "10", "most": "20", "wait_ms": "5000", "span": "8"}, clock=lambda: clock[0])
    _, first = reader.read({})
    assert first == {key("a", 0): 10, key("a", 1): 10}  # no more than 20 rows at once
    _, second = reader.read(first)
    assert second == first | {key("a", 2): 10}  # what was held back is first; one row of partition 1 waits
    assert reader.read(second)[1] == second
    clock[0] = 6.0
    _, third = reader.read(second)
    assert third[key("a", 1)] == 11 and key("a", 2) in third
    (tmp_path / "in/index" / "99-torn").mkdir()  # an append that isn't complete
    assert reader.read(third | {key("a", 2): 12})[1] == third | {key("a", 2): 12}


def test_a_cut_reads_no_more_than_its_rows(spark, tmp_path, monkeypatch):
    admission.store(spark.range(40_000).selectExpr("'a' AS topic", "0 AS `partition`", "id AS offset", "'v' AS value"), f"{tmp_path}/in", 64)
    reader = admission.Admission({"path": f"{tmp_path}/in", "rows": "1000", "span": "64"})
    read, own = [], reader._ranges_of
    monkeypatch.setattr(reader, "_ranges_of", lambda *a: (read.append(found := own(*a)), found)[1])
    at = {}
    for k in range(3):
        at = reader.read(at)[1]
        assert at == {key("a", 0): 1000 * (k + 1)}
    assert sum(map(len, read)) < 3 * 2 * (1000 // 64 + 4)  # of 625


def test_a_stream_stops_and_starts_again(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id", "id % 3 AS p", "id div 3 AS o")
    records = encode(rows, F.lit("shop.app.events"), F.col("p"), F.col("o"))
    settings = dict(root=f"{tmp_path}/tables", table_name_format="bronze.${topic[1]}.${topic[2]}", flush_size=100, flush_interval_ms=60_000)
    for part, wait in ((records.filter("offset < 250"), {}), (records.filter("offset >= 250"), {}), (records.limit(0), {"wait_ms": "0"})):
        admission.store(part, f"{tmp_path}/in")
        ingest = Ingest(spark, IngestConfig(**settings))
        q = sink.start_stored(spark, f"{tmp_path}/in", ingest, f"{tmp_path}/checkpoint", **wait)
        q.processAllAvailable()
        q.stop()
        ingest.close()
    table = ingest.table("bronze.app.events")
    assert [r.num_output_rows for r in table.history().filter("num_output_rows > 0").orderBy("version").collect()] == [300, 300, 300, 100]
    assert sorted(r.id for r in table.read().collect()) == list(range(1000))


def test_the_interval_commits_what_waits(spark, tmp_path):
    """The time dial alone, with a stream that goes on: what is under the row dial is committed once it has waited."""
    records = encode(spark.range(50), F.lit("shop.app.events"), F.lit(0), F.col("id"))
    admission.store(records, f"{tmp_path}/in")
    ingest = Ingest(spark, IngestConfig(root=f"{tmp_path}/tables", table_name_format="bronze.${topic[1]}.${topic[2]}", flush_size=1000, flush_interval_ms=4000))
    q = sink.start_stored(spark, f"{tmp_path}/in", ingest, f"{tmp_path}/checkpoint")
    try:
        begun = time.monotonic()
        while not ingest.table("bronze.app.events").exists() and time.monotonic() - begun < 90:
            time.sleep(0.2)
        assert time.monotonic() - begun >= 4 and ingest.table("bronze.app.events").read().count() == 50
    finally:
        q.stop()
        ingest.close()


@pytest.mark.parametrize("rows_dial,bytes_dial", [(7, 0), (0, 40), (25, 60), (1, 1), (500, 0), (0, 0)])
def test_a_batch_has_many_buffers(spark, tmp_path, rows_dial, bytes_dial):
    rng = random.Random(5)
    own = [(o, rng.choice([None, "x", "\u00e9" * rng.randint(1, 9), "y" * 70])) for o in sorted(rng.sample(range(400), 150)) + [900, 901, 5_000]]
    for part in (own[:60], own[60:]):
        stored(spark, f"{tmp_path}/in", [("t", 3, o, v) for o, v in part])
    options = {"path": f"{tmp_path}/in", "rows": str(rows_dial), "bytes": str(bytes_dial), "span": "8", "buffers": "6"}
    reader, at, got, most = admission.Admission(options), {}, [], 0
    while True:
        ranges, end = reader.read(at)
        ranges = list(ranges)
        assert list(admission.Admission(options).readBetweenOffsets(at, end)) == ranges  # after a crash
        if end == at:
            break
        got, at, most = got + [r[2:4] for r in ranges], end, max(most, len(ranges))
    want = [w[:2] for w in buffers(own, rows_dial, bytes_dial)]
    assert got == want and most == min(6, len(want))


def test_a_backlog_takes_few_micro_batches(spark, tmp_path, monkeypatch):
    """Sixty buffers of three partitions are read and written together, and each number's are a commit; the log isn't listed for each."""
    records = encode(spark.range(3000).selectExpr("id", "id % 3 AS p", "id div 3 AS o"), F.lit("shop.app.events"), F.col("p"), F.col("o"))
    admission.store(records, f"{tmp_path}/in")
    ingest = Ingest(spark, IngestConfig(root=f"{tmp_path}/tables", table_name_format="bronze.${topic[1]}.${topic[2]}", flush_size=50))
    table, listed = ingest.table("bronze.app.events"), []
    sizes = table.storage.sizes
    monkeypatch.setattr(table.storage, "sizes", lambda path: (listed.append(path), sizes(path))[1])
    q = sink.start_stored(spark, f"{tmp_path}/in", ingest, f"{tmp_path}/checkpoint", wait_ms="0")
    q.processAllAvailable()
    q.stop()
    ingest.close()
    assert len([x for x in (tmp_path / "checkpoint/commits").iterdir() if x.name.isdigit()]) <= 2
    assert len(listed) < 15
    assert [r.num_output_rows for r in table.history().filter("num_output_rows > 0").orderBy("version").collect()] == [150] * 20
    assert sorted(r.id for r in table.read().collect()) == list(range(3000))
