import threading
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltflow.operators.quality import not_applied
from siltflow.plans.catalog import CatalogClient, CatalogError, NotFound, StagedCommits
from siltflow.sources.storage import HadoopStorage, LocalStorage
from siltflow.sources.stats import Between
from siltflow.sources.table import CommitConflict, TxnTable


def rows(spark, n, start=0):
    return spark.range(start, start + n).select(F.col("id").cast("int").alias("id"), F.concat(F.lit("n"), "id").alias("name"), (F.col("id") * 1.5).alias("amount"))


@pytest.mark.parametrize("kind", ["local", "hadoop"])
def test_create_append_replay(spark, tmp_path, kind):
    t = TxnTable(spark, f"file://{tmp_path}/t", LocalStorage() if kind == "local" else HadoopStorage(spark))
    assert not t.exists()
    first = t.append(rows(spark, 3), {"app:orders-0": 10})
    assert (first.version, first.applied, first.rows) == (0, True, 3) and first.files > 0 and first.bytes > 0
    second = t.append(rows(spark, 2, 3), {"app:orders-0": 11})
    assert second.version == 1 and t.read().count() == 5
    again = t.append(rows(spark, 2, 3), {"app:orders-0": 11})
    assert not again.applied and t.read().count() == 5
    assert not t.append(rows(spark, 2, 3), {"app:orders-0": 10}).applied
    assert t.read(version=0).count() == 3 and sorted(r.id for r in t.read().collect()) == [0, 1, 2, 3, 4]
    assert TxnTable(spark, f"file://{tmp_path}/t", t.storage).snapshot().txns == {"app:orders-0": 11}
    with pytest.raises(ValueError):
        t.snapshot(9)


def test_required_columns(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.IntegerType(), False), T.StructField("s", T.StringType())])
    t = TxnTable(spark, f"{tmp_path}/t")
    t.create(schema)
    t.append(spark.createDataFrame([(1, None)], "id int, s string"), schema=schema)
    with pytest.raises(Exception, match="required column id"):
        t.append(spark.createDataFrame([(None, "x")], "id int, s string"), schema=schema)
    assert t.read().count() == 1 and t.snapshot().schema == schema


def test_two_writers_of_one_version(spark, tmp_path):
    path = f"{tmp_path}/t"
    TxnTable(spark, path).create(rows(spark, 1).schema)
    tables = [TxnTable(spark, path) for _ in range(4)]
    work = [threading.Thread(target=lambda k=k, t=t: t.append(rows(spark, 10, 10 * k), {f"w{k}": 1})) for k, t in enumerate(tables)]
    for w in work:
        w.start()
    for w in work:
        w.join()
    assert TxnTable(spark, path).read().select("id").distinct().count() == 40 and TxnTable(spark, path).snapshot().version == 4


def test_exclusive_create(tmp_path):
    s, won = LocalStorage(), []
    work = [threading.Thread(target=lambda k=k: won.append(s.create(f"{tmp_path}/log/1.json", str(k)))) for k in range(16)]
    for w in work:
        w.start()
    for w in work:
        w.join()
    assert won.count(True) == 1 and s.list(f"{tmp_path}/log") == ["1.json"]


def test_added_columns_read_as_null(spark, tmp_path):
    t = TxnTable(spark, f"{tmp_path}/t")
    t.append(rows(spark, 2))
    t.add_columns([T.StructField("email", T.StringType())])
    assert not t.add_columns([T.StructField("email", T.StringType())]).applied
    t.append(rows(spark, 1, 2).withColumn("email", F.lit("e")))
    t.append(rows(spark, 1, 3))  # of the older schema
    assert [r.email for r in t.read().orderBy("id").collect()] == [None, None, "e", None]
    with pytest.raises(ValueError, match="don't fit"):
        t.append(rows(spark, 1).withColumn("id", F.lit("x")))


def test_partitions(spark, tmp_path):
    t = TxnTable(spark, f"{tmp_path}/t")
    t.append(spark.sql("select * from values (1, 'a b/c'), (2, null), (3, 'x') v(id, k)"), partition_columns=["k"])
    assert t.read(where={"k": "a b/c"}).collect() == [(1, "a b/c")] and t.read(where={"k": None}).collect() == [(2, None)]
    assert t.read().count() == 3


def test_history_overwrite_and_checkpoint(spark, tmp_path):
    t = TxnTable(spark, f"{tmp_path}/t")
    for k in range(11):
        t.append(rows(spark, 1, k).coalesce(1), {"a": k})
    assert t.maintain() == 10 and t.maintain() is None
    again = TxnTable(spark, f"{tmp_path}/t")
    assert again.read().count() == 11 and again.snapshot().txns == {"a": 10}
    again.overwrite(rows(spark, 2))
    h = {r.version: r for r in again.history().collect()}
    assert h[3].num_output_rows == 1 and h[3].is_blind_append and h[3].mode == "Append" and h[11].mode == "Overwrite" and not h[11].is_blind_append
    assert again.read().count() == 2 and again.read(version=10).count() == 11


def test_empty_table(spark, tmp_path):
    t = TxnTable(spark, f"{tmp_path}/t")
    with pytest.raises(ValueError):
        t.read()
    t.create(rows(spark, 1).schema)
    assert t.read().collect() == [] and t.append(rows(spark, 0), {"a": 1}).rows == 0


def test_offsets_beyond_what_is_applied(spark):
    df = spark.createDataFrame([("t", 0, k) for k in range(5)] + [("u", 0, 1)], "topic string, `partition` int, `offset` long")
    assert not_applied(df, {"n:t-0": 2}, "n").count() == 3 and not_applied(df, {}, "n").count() == 6


def test_staged_commits(tmp_path):
    s = LocalStorage()
    c = StagedCommits(s, f"{tmp_path}/log")
    for v in (2, 1, 0):
        assert c.ratify(v, c.stage(v, f"v{v}", "mine"))
    assert not c.ratify(1, c.stage(1, "late", "other"))
    s.create(f"{tmp_path}/log/{0:020d}.json", "v0")
    assert [v for v, _ in c.pending()] == [1, 2] and c.publish() == [1, 2] and c.publish() == [] and c.highest_published == 2
    assert s.read(f"{tmp_path}/log/{1:020d}.json") == "v1"


def test_catalog_client():
    answers = iter([(200, {"status": {"state": "PENDING"}, "statement_id": "s"}), (200, {"status": {"state": "SUCCEEDED"}}), (404, {}), (403, {"secret": "LEAK"}), (200, {"status": {"state": "FAILED"}})])
    c = CatalogClient(lambda *a: next(answers), wait=lambda s: None)
    c.execute("w", "CREATE TABLE x")
    with pytest.raises(NotFound):
        c.get_table("a.b.c")
    with pytest.raises(CatalogError) as error:
        c.credentials("id")
    assert "LEAK" not in str(error.value)
    with pytest.raises(CatalogError):
        c.execute("w", "x")


def test_versions_are_quick_to_find(spark, tmp_path):
    t = TxnTable(spark, f"{tmp_path}/t")
    t.append(rows(spark, 1))
    began = time.time()
    for _ in range(50):
        t.snapshot()
    assert time.time() - began < 2


def test_half_written_checkpoint_and_version(spark, tmp_path):
    path = f"{tmp_path}/t"
    t = TxnTable(spark, path)
    for k in range(12):
        t.append(rows(spark, 2, 2 * k).coalesce(1), {"a": k})
    log = tmp_path / "t" / "_txn_log"
    (log / "_checkpoints" / "00000000000000000010-aaaa").mkdir(parents=True)  # still in writing
    (log / "00000000000000000010.checkpoint.parquet").mkdir()
    assert TxnTable(spark, path).read().count() == 24
    assert t.maintain() == 10 and t.maintain() is None
    assert TxnTable(spark, path).read().count() == 24 and TxnTable(spark, path).snapshot().txns == {"a": 11}
    whole = (log / "00000000000000000011.json").read_text()
    for cut in (0, 10, len(whole.splitlines()[0]) + 1, len(whole) - 5):  # a version still in writing
        (log / "00000000000000000012.json").write_text(whole[:cut])
        again = TxnTable(spark, path)
        assert again.read().count() == 24 and again.snapshot().version == 11 and again.history().count() == 12


@pytest.mark.parametrize("prefix", ["", "file:", "file://"])
def test_local_urls(spark, tmp_path, prefix):
    t = TxnTable(spark, f"{prefix}{tmp_path}/u")
    t.append(rows(spark, 3))
    assert t.read().count() == 3 and (tmp_path / "u" / "_txn_log").is_dir()


def test_hadoop_create_once(spark, tmp_path):
    s, path = HadoopStorage(spark), f"file://{tmp_path}/log/1.json"
    assert s.create(path, "a\n") and not s.create(path, "b\n") and s.read(path) == "a\n" and [n for n in s.list(f"file://{tmp_path}/log") if not n.endswith(".crc")] == ["1.json"]


def test_rewrite_of_some_partitions(spark, tmp_path):
    t = TxnTable(spark, f"{tmp_path}/t")
    df = rows(spark, 12).withColumn("k", F.col("id") % 3)
    t.overwrite(df, partition_columns=["k"])
    kept = {p for p, a in t.snapshot().files.items() if a["partitionValues"]["k"] != "1"}
    t.overwrite(df.filter("k = 1 and id > 4"), where={"k": {"1"}})
    assert kept <= set(t.snapshot().files) and sorted(r.id for r in t.read().collect()) == [0, 2, 3, 5, 6, 7, 8, 9, 10, 11]
    assert sorted(r.id for r in t.read(where={"k": ["1", "2"]}).collect()) == [2, 5, 7, 8, 10, 11]


def test_stale_replays_of_deleted_keys(spark, tmp_path):
    from siltflow.operators import cdc

    change = lambda *x: spark.createDataFrame(list(x), "id int, name string, op string, seq long")
    t = TxnTable(spark, f"{tmp_path}/t")
    apply = lambda df: cdc.apply_changes(df, t, ["id"], ["seq"], ["id", "name"])
    apply(change((1, "a", "c", 10), (2, "b", "c", 11)))
    apply(change((1, None, "d", 20)))
    apply(change((1, "a", "c", 10), (3, None, "d", 5)))  # stale, and a delete before its create
    apply(change((3, "c", "c", 4)))
    assert [tuple(r)[:2] for r in cdc.current(t).collect()] == [(2, "b")]
    apply(change((1, "again", "c", 30), (3, "c", "c", 6), (2, "old", "u", 1)))
    assert sorted(tuple(r)[:2] for r in cdc.current(t).collect()) == [(1, "again"), (2, "b"), (3, "c")]
    assert apply(change()) is None and t.read().count() == 3


def test_only_met_buckets_are_rewritten(spark, tmp_path):
    from siltflow.operators import cdc

    bronze, t = TxnTable(spark, f"{tmp_path}/b"), TxnTable(spark, f"{tmp_path}/t")
    change = lambda low, high, seq: spark.range(low, high).selectExpr("id", "'u' AS op", f"{seq}L AS seq")
    bronze.append(change(0, 200, 1))
    cdc.apply_new(bronze, t, ["id"], ["seq"], ["id"])
    before = set(t.snapshot().files)
    bronze.append(change(7, 8, 2))
    cdc.apply_new(bronze, t, ["id"], ["seq"], ["id"])
    assert len(before - set(t.snapshot().files)) == 1 and cdc.current(t).filter("seq = 2").count() == 1 and cdc.current(t).count() == 200
    assert cdc.apply_new(bronze, t, ["id"], ["seq"], ["id"]) is None


ODD = "id int, d double, s string, t timestamp_ntz, u timestamp, day date, m decimal(20,3), f float, l array<int>"


def odd_rows(spark, n=60):
    return spark.range(n).selectExpr(
        "cast(id as int) as id", "case when id % 20 > 15 then double('NaN') when id % 7 = 0 then null when id = 3 then -0.0D else id / 3 end as d",
        "case when id < 20 then null when id < 40 then concat('\u00e9', id) else concat(repeat('z', 40), id) end as s", "timestamp_ntz'1969-12-31 23:59:59.999999' + make_dt_interval(id) as t",
        "timestamp'2024-03-31 01:00:00' + make_dt_interval(0, id) as u", "date'1970-01-05' - cast(id as int) as day", "cast((id - 30) / 8 as decimal(20,3)) as m", "case when id > 50 then float('inf') else cast(-id as float) end as f", "array(cast(id as int)) as l",
    )


CONDITIONS = [
    {"id": Between(10, 12)}, {"id": Between(high=-1)}, {"id": Between()}, {"id": [5, 41, None]}, {"d": Between(low=18.0)}, {"d": None}, {"d": Between(high=0.0)}, {"d": [0.0]}, {"d": float("nan")}, {"s": None}, {"s": "\u00e921"}, {"s": Between("a", "y")},
    {"s": Between(low="z" * 40 + "5")}, {"s": "zz"}, {"t": Between("1970-01-01", "1970-01-03 12:00:00")}, {"u": Between(high="2024-03-31T04:00:00+00:00")}, {"day": "1969-12-30"}, {"m": Between("-1.125", "0")}, {"f": Between(low=0.0)}, {"id": Between(3, 50), "d": Between(1.0, 2.0), "s": [None]}, {"k": "1"}, {"k": Between(2, 3), "id": Between(30, 31)},
]


@pytest.mark.parametrize("tail", [100, 0])
def test_bounds_leave_out_no_row(spark, tmp_path, tail):
    """By the driver's actions and by the replayed ones."""
    t = TxnTable(spark, f"{tmp_path}/t", max_tail=tail)
    df = odd_rows(spark).withColumn("k", F.expr("cast(id div 15 as int)"))
    t.append(df.repartitionByRange(6, "id"), partition_columns=["k"])
    t.append(df.limit(0).coalesce(1), {"none": 1})
    whole, left_out = t.read().collect(), 0
    assert len(whole) == 60
    from siltflow.sources.stats import row_filter

    for where in CONDITIONS:
        got = t.read(where=where)
        want = t.read().filter(row_filter(where, t.snapshot().schema))
        assert sorted(r.id for r in got.collect()) == sorted(r.id for r in want.collect()), where
        n, files = t.skipped(where)
        assert 0 <= n <= files
        left_out += n
    assert left_out > 50 and t.skipped({"id": Between(10, 12)})[0] >= t.skipped({})[1] - 2


def test_every_file_has_its_own_bounds(spark, tmp_path):
    """Also where one task writes files of several partitions under one name, and names need escapes."""
    t = TxnTable(spark, f"{tmp_path}/a b/t")
    t.append(rows(spark, 8).withColumn("k", F.concat(F.lit("x y/%"), F.col("id") % 4)).coalesce(1), partition_columns=["k"])
    assert {tuple(sorted((a["stats"]["min"]["id"], a["stats"]["max"]["id"]))) for a in t.snapshot().files.values()} == {("0", "4"), ("1", "5"), ("2", "6"), ("3", "7")}
    assert t.skipped({"id": 5}) == (1, 4) and t.skipped({"id": [0, 7]}) == (2, 4) and t.read(where={"id": 5}).count() == 1


def test_a_table_without_bounds(spark, tmp_path):
    t = TxnTable(spark, f"{tmp_path}/t", stats_columns=0)
    t.append(odd_rows(spark))
    assert t.read(where={"id": Between(10, 12)}).count() == 3 and t.skipped({"id": Between(10, 12)})[0] == 0


def test_replay_by_aggregation(spark, tmp_path):
    """Random appends and rewrites: what the driver replays and what an aggregation replays are the same, with and without checkpoints."""
    import random

    rng = random.Random(3)
    t = TxnTable(spark, f"{tmp_path}/t")
    want: dict[int, list[int]] = {}
    for k in range(9):
        p, n = rng.randrange(3), rng.randrange(1, 5)
        df = rows(spark, n, 10 * k).withColumn("p", F.lit(p))
        if k % 3 == 2:
            t.overwrite(df, where={"p": {str(p)}})
            want[p] = []
        else:
            t.append(df, {"w": k}, partition_columns=["p"])
        want.setdefault(p, []).extend(range(10 * k, 10 * k + n))
    t.add_columns([T.StructField("more", T.StringType())])
    for every in (None, 4, 5):
        if every:
            assert TxnTable(spark, t.path, max_tail=1).maintain(every) == 9 - 9 % every
        for tail in (0, 3, 1000):
            again = TxnTable(spark, t.path, max_tail=tail).snapshot()
            assert again.files == t.snapshot().files and again.txns == {"w": 7} and again.version == 9 and again.schema == t.snapshot().schema
            other = TxnTable(spark, t.path, max_tail=tail)
            assert sorted(r.id for r in other.read().collect()) == sorted(x for v in want.values() for x in v)
            assert sorted(r.id for r in other.read(where={"p": ["1"]}).collect()) == sorted(want.get(1, []))
            assert other.read(version=3).count() == t.read(version=3).count()


def test_a_million_actions(spark, tmp_path):
    """The driver's Python holds none of them, and a read by partition plans its own files only."""
    import json
    import tracemalloc

    t = TxnTable(spark, f"{tmp_path}/t")
    t.append(rows(spark, 4).withColumn("p", F.lit("real")), {"w": 0}, partition_columns=["p"])
    t.snapshot()
    log = tmp_path / "t" / "_txn_log"
    for v in range(1, 21):
        with open(log / f"{v:020d}.json", "w") as f:
            for k in range(50_000):
                f.write(json.dumps({"add": {"path": f"data/{v}/{k}.parquet", "size": 1, "partitionValues": {"p": str(k % 1000)}, "dataChange": True}}) + "\n")
            f.write(json.dumps({"txn": {"appId": "w", "version": v}}) + "\n" + json.dumps({"commitInfo": {"operation": "WRITE", "isBlindAppend": True}}) + "\n")
    tracemalloc.start()
    again = TxnTable(spark, f"{tmp_path}/t")
    s = again.snapshot()
    assert (s.version, s.txns) == (20, {"w": 20})
    assert again.maintain() == 20
    other = TxnTable(spark, f"{tmp_path}/t")
    assert other.read(where={"p": "real"}).count() == 4
    assert other.skipped({"p": ["7", "real"]}) == (999_000, 1_000_000 + len(t.snapshot(0).tail))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64e6


def test_rewrites_of_other_rows_dont_conflict(spark, tmp_path):
    t = TxnTable(spark, f"{tmp_path}/t")
    df = rows(spark, 12).withColumn("k", F.col("id") % 3)
    read = t.append(df, partition_columns=["k"]).version
    t.overwrite(df.filter("k = 1 and id > 4"), where={"k": {"1"}}, read_version=read)
    t.overwrite(df.filter("k = 2 and id > 5"), where={"k": {"2"}}, read_version=read)
    with pytest.raises(CommitConflict):
        t.overwrite(df.filter("k = 1"), where={"k": {"1", "0"}}, read_version=read)
    with pytest.raises(CommitConflict):
        t.overwrite(df, read_version=read)
    later = t.snapshot().version
    t.append(df.filter("id = 0"))
    t.overwrite(df.filter("k = 2 and id > 9"), where={"k": {"2"}}, read_version=later)
    with pytest.raises(CommitConflict):
        t.overwrite(df.filter("k = 0"), where={"k": {"0"}}, read_version=later)
    assert sorted(r.id for r in t.read().collect()) == [0, 0, 3, 6, 7, 9, 10, 11]


HISTORY = ["id", "name", "seq", "at", "__start_at", "__end_at"]


def changes_of(spark, rows_):
    return spark.createDataFrame(rows_, "id int, name string, op string, seq long, at long")


def expected_history(changes):
    """The history of changes, by hand: a key and its sequence are one change."""
    by_key = {}
    for id_, name, op, seq, at in changes:
        by_key.setdefault(id_, {}).setdefault(seq, (name, op, at))
    out = []
    for id_, own in by_key.items():
        order = sorted(own, key=lambda s: (s is not None, s or 0))
        for k, seq in enumerate(order):
            name, op, at = own[seq]
            if op != "d":
                out.append((id_, name, seq, at, at, own[order[k + 1]][2] if k + 1 < len(order) else None))
    return sorted(out, key=repr)


def test_history_by_splicing(spark, tmp_path):
    import random

    from siltflow.operators import cdc

    rng, t, seen = random.Random(5), TxnTable(spark, f"{tmp_path}/t"), []
    every = [(rng.choice([None, *range(30)]), rng.choice(["a", "b", None]), rng.choice("cuud"), s, rng.choice([None, s * 10, s * 10])) for s in range(240)]
    every[7] = (*every[7][:3], None, 5)
    rng.shuffle(every)
    apply = lambda part: cdc.apply_changes(changes_of(spark, part), t, ["id"], ["seq"], ["id", "name", "seq"], stored_as_scd_type=2, valid="at", buckets=4, bucket_rows=40)
    for k, part in enumerate((every[:90], every[90:100], every[80:150], every[150:] + every[200:])):  # with repeats, across calls and within one
        apply(part)
        seen += part
        assert sorted((tuple(r) for r in cdc.history(t).select(*HISTORY).collect()), key=repr) == expected_history(seen), k
    assert apply([]) is None
    again = t.read().count()
    apply(every)
    assert t.read().count() == again == len({(r[0], r[3]) for r in every})


def test_history_rewrites_only_what_changes_meet(spark, tmp_path):
    from siltflow.operators import cdc

    t = TxnTable(spark, f"{tmp_path}/t")
    apply = lambda *part: cdc.apply_changes(changes_of(spark, list(part)), t, ["id"], ["seq"], ["id", "name"], stored_as_scd_type=2, valid="at")
    apply(*((k, "x", "u", s, s) for k in range(100) for s in (10, 20)))
    part = lambda p: int(t.snapshot().files[p]["partitionValues"][cdc.PART])
    before = {p: part(p) for p in t.snapshot().files}
    apply((7, "y", "u", 30, 30))  # newer than the key's last version: the versions before it stay as they are
    gone = {before[p] for p in set(before) - set(t.snapshot().files)}
    assert len(gone) == 1 and not gone.pop() % 2
    before = {p: part(p) for p in t.snapshot().files}
    apply((7, "z", "d", 15, 15))  # splits an interval
    gone = {before[p] for p in set(before) - set(t.snapshot().files)}
    assert len({g // 2 for g in gone}) == 1 and len(gone) == 2
    assert sorted(map(tuple, cdc.history(t).filter("id = 7").select("name", "__start_at", "__end_at").collect())) == [("x", 10, 15), ("x", 20, 30), ("y", 30, None)]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 11, 16, 31])
def test_linear_hashing(spark, n):
    from siltflow.operators.cdc import address, parent

    got = spark.range(-500, 500).select(address(F.col("id").cast("int"), n).alias("a"), address(F.col("id").cast("int"), n + 1).alias("b"), address(F.col("id").cast("int"), 3 * n).alias("c")).collect()
    assert {r.a for r in got} == set(range(n))
    assert all(r.b == r.a or r.b == n and r.a == parent(n, n) for r in got)
    assert all(parent(r.c, n) == r.a for r in got)


def test_buckets_grow_with_the_table(spark, tmp_path):
    from siltflow.operators import cdc

    t = TxnTable(spark, f"{tmp_path}/t")
    change = lambda low, high, seq: spark.range(low, high).selectExpr("id", "'u' AS op", f"{seq}L AS seq")
    apply = lambda df: cdc.apply_changes(df, t, ["id"], ["seq"], ["id"], buckets=2, bucket_rows=100)
    for k, high in enumerate((200, 600, 5_000, 20_000)):
        apply(change(0, high, k))
        own = t.rows_by(cdc.BUCKET)
        assert sum(own.values()) == high == t.read().count() and max(own.values()) < 500
    n = max(map(int, own)) + 1
    assert n >= 200 and t.read().filter(F.col(cdc.BUCKET) != cdc.address(F.hash("id"), n)).count() == 0
    assert cdc.current(t).agg(F.min("seq"), F.max("seq"), F.count_distinct("id")).first() == (3, 3, 20_000)
    before = set(t.snapshot().files)
    apply(change(20_000, 20_001, 9))
    after = set(t.snapshot().files)
    assert len(before & after) > 0.5 * len(before) and cdc.current(t).count() == 20_001
    met = {int(a["partitionValues"][cdc.BUCKET]) for p, a in t.snapshot().files.items() if p not in before}
    now = max(int(x) for x in t.rows_by(cdc.BUCKET)) + 1
    assert len(met) <= 2 * (now - n) + 2


def test_a_split_beside_another_writer(spark, tmp_path):
    from siltflow.operators import cdc

    t = TxnTable(spark, f"{tmp_path}/t")
    change = lambda ids, seq: spark.createDataFrame([(i, "u", seq) for i in ids], "id long, op string, seq long")
    apply = lambda df, **at: cdc.apply_changes(df, t, ["id"], ["seq"], ["id"], buckets=4, bucket_rows=20, **at)
    read = apply(change(range(80), 1)).version
    assert max(map(int, t.rows_by(cdc.BUCKET))) == 3
    apply(change(range(80, 130), 2), read_version=read)
    n = max(map(int, t.rows_by(cdc.BUCKET))) + 1
    assert n > 4
    apply(change(range(60, 180), 3), read_version=read)  # from the old buckets: it starts anew
    n = max(map(int, t.rows_by(cdc.BUCKET))) + 1
    assert t.read().filter(F.col(cdc.BUCKET) != cdc.address(F.hash("id"), n)).count() == 0
    assert sorted((r.id, r.seq) for r in cdc.current(t).collect()) == [(k, 1 if k < 60 else 3) for k in range(180)]


def test_rows_by_value_come_from_the_log(spark, tmp_path):
    t = TxnTable(spark, f"{tmp_path}/t", max_tail=2)
    for k in range(5):
        t.append(rows(spark, 10 + k).withColumn("k", F.col("id") % 2), partition_columns=["k"])
    assert t.snapshot().base is not None
    assert t.rows_by("k") == {str(r.k): r.n for r in t.read().groupBy("k").agg(F.count("*").alias("n")).collect()}


@pytest.mark.parametrize("scd_type", [1, 2])
def test_many_small_buckets_are_written_by_many_tasks(spark, tmp_path, scd_type):
    """By their number, however few bytes they have; a bucket's live and deleted keys are one file."""
    from siltflow.operators import cdc

    t = TxnTable(spark, f"{tmp_path}/t")
    changes = spark.range(1600).selectExpr("id", "if(id % 5 = 0, 'd', 'u') AS op", "1L AS seq")
    for part in (changes.filter("id < 400"), changes):
        cdc.apply_changes(part, t, ["id"], ["seq"], ["id"], stored_as_scd_type=scd_type, buckets=2, bucket_rows=8)
    live = sorted(r.id for r in (cdc.current(t) if scd_type == 1 else cdc.history(t)).collect())
    assert live == [k for k in range(1600) if k % 5]
    files = list(t.snapshot().files)
    assert len({f.rpartition("/")[2].split("-")[1] for f in files}) > 3  # the number of the task that wrote it
    column, parts = (cdc.BUCKET, 1) if scd_type == 1 else (cdc.PART, 2)
    own = {int(v) // parts for v in t.rows_by(column)}
    assert len(files) == len(own) > 150
    if scd_type == 1:
        cdc.apply_changes(spark.range(5).selectExpr("id", "'u' AS op", "2L AS seq"), t, ["id"], ["seq"], ["id"], buckets=2, bucket_rows=8)
        assert cdc.current(t).count() == 1281  # key 0 is there again
