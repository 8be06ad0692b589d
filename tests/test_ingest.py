import json

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltflow.operators import cdc
from siltflow.operators.evolution import Evolution, diff
from siltflow.operators.routing import RoutingError, parse_overrides, render, table_name
from siltflow.plans import flush
from siltflow.plans.config import ConfigError, IngestConfig
from siltflow.plans.credentials import EntraMinter, Refreshing, ScopedSecrets, Token, WorkspaceMinter, storage_conf
from siltflow.plans.ingest import BackPressure, Ingest
from siltflow.plans.measure import summary
from siltflow.sources.records import decode, encode, subscribe
from siltflow.streaming import sink

V1 = {"type": "struct", "fields": [{"field": "id", "type": "int32", "optional": False}, {"field": "name", "type": "string", "optional": True}]}
V2 = {"type": "struct", "fields": [*V1["fields"], {"field": "email", "type": "string", "optional": True}]}


def value(schema, **payload):
    return json.dumps({"schema": schema, "payload": payload})


def records(spark, *rows):
    return spark.createDataFrame([(t, p, o, v) for t, p, o, v in rows], "topic string, `partition` int, `offset` long, value string")


def engine(spark, tmp_path, **more):
    return Ingest(spark, IngestConfig(**{"root": str(tmp_path), "table_name_format": "main.s.${topic}"} | more))


def test_split_and_dead_letters(spark, tmp_path):
    batch = records(spark, ("t", 0, 0, None), ("t", 0, 1, value(V1, id=1, name="a")), ("t", 0, 2, '"just-a-string"'), ("t", 0, 3, value(V2, id=2, name="b", email="e")), ("t", 0, 4, value(V1, id=3, name=None)), ("t", 0, 5, value(V1, name="no id")), ("t", 0, 6, value(V1, id="text", name="x")), ("t", 1, 0, None), ("t", 1, 1, "{}"))
    ingest = engine(spark, tmp_path)
    out = ingest.batch(batch)
    assert sorted(map(tuple, ingest.table("main.s.t").read().collect())) == [(1, "a"), (3, None)]
    assert out.dead == 7 and out.next_offsets == {("t", 0): 7, ("t", 1): 2}
    dead = {(r.partition, r.offset) for r in ingest.dead_letters.read().collect()}
    assert dead == {(0, 0), (0, 2), (0, 3), (0, 5), (0, 6), (1, 0), (1, 1)}
    assert ingest.batch(batch).dead == 0 and ingest.dead_letters.read().count() == 7 and ingest.table("main.s.t").read().count() == 2


@pytest.mark.parametrize("topics", [1, 2, 9])
def test_a_batch_is_read_twice(spark, tmp_path, topics):
    """However many tables, schemas and unusable records it has."""
    rows = [(f"t{k % topics}", p, k, value(V2 if k % 2 and p else V1, id=k, name="a")) for p in (0, 1) for k in range(36)] + [("t0", 0, 99, "garbage")]
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            read.add(len(b))
            yield b

    records(spark, *rows).write.parquet(f"{tmp_path}/in")
    source = spark.read.parquet(f"{tmp_path}/in").mapInPandas(count, "topic string, `partition` int, `offset` long, value string")
    ingest = engine(spark, f"{tmp_path}/out", commit_per_partition=True, schema_evolution=Evolution.MERGE, flush_concurrency=3)
    out = ingest.batch(source)
    if topics > 1:
        assert read.value == 2 * len(rows) and not list((tmp_path / "out" / "_dealt").iterdir())
    assert sum(ingest.table(f"main.s.t{k}").read().count() for k in range(topics)) + out.dead == len(rows)


def test_schemas_are_parsed_by_head_alone(spark, tmp_path):
    from siltflow.operators import quality

    spaced = json.dumps({"schema": V1, "payload": {"id": 4, "name": "d"}}, indent=1)
    tight = lambda schema, **x: json.dumps({"schema": schema, "payload": x}, separators=(",", ":"))
    rows = [("t", 0, 0, None), ("t", 0, 1, "x"), ("t", 0, 2, tight(V1, id=1, name="a")), ("t", 0, 3, tight(V2, id=1, name="a", email="e")), ("t", 0, 4, spaced), ("t", 1, 7, None), ("u", 0, 5, tight(V2, id=1, name="a", email="e")), ("u", 0, 4, tight(V1, id=1, name="a"))]
    records(spark, *rows).write.parquet(f"{tmp_path}/in")
    df = quality.reference_schemas(spark.read.parquet(f"{tmp_path}/in"))
    got = {(r.topic, r.partition): (r.reference and len(json.loads(r.reference)["fields"]), r.last_offset, r.n, r.fit, len(r.heads)) for r in df.collect()}
    assert got == {("t", 0): (2, 4, 5, 2, 1), ("t", 1): (None, 7, 1, 0, 0), ("u", 0): (2, 5, 2, 1, 1)}
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and "Join" not in plan
    below = plan[plan.rindex("Aggregate") :]  # what is done for each record: a parse only where the fixed text isn't found
    assert not [x for x in below.splitlines() if "Filter" in x] and "$.type" not in below.split("CASE WHEN")[0]


def test_without_dead_letters_the_batch_fails(spark, tmp_path):
    with pytest.raises(ValueError, match="t-0@0"):
        engine(spark, tmp_path, dead_letters=False).batch(records(spark, ("t", 0, 0, None), ("t", 0, 1, value(V1, id=1, name="a"))))


def test_back_pressure(spark, tmp_path):
    batch = records(spark, *(("t", 0, k, value(V1, id=k, name="a")) for k in range(4)))
    with pytest.raises(BackPressure):
        engine(spark, tmp_path, max_buffered=3).batch(batch)
    assert engine(spark, tmp_path, max_buffered=4).batch(batch).next_offsets == {("t", 0): 4}


@pytest.mark.parametrize(("mode", "n", "dead"), [("none", 1, 2), ("add", 2, 1), ("merge", 3, 0)])
def test_evolution(spark, tmp_path, mode, n, dead):
    ingest = engine(spark, tmp_path, schema_evolution=Evolution.of(mode))
    ingest.batch(records(spark, ("t", 0, 0, value(V1, id=1, name="a"))))
    ingest.batch(records(spark, ("t", 0, 1, value(V2, id=2, name="b", email="e"))))
    if mode == "none":  # rows of one schema more fail as a write
        assert ingest.dead_letters.read().count() == 1
    ingest.batch(records(spark, ("t", 0, 2, value(V1, id=3, name="c"))))
    rows = ingest.table("main.s.t").read()
    if mode != "none":
        assert rows.count() == n and rows.filter("id = 1").first().email is None
        seen = ingest.dead_letters.read().count() if ingest.dead_letters.exists() else 0
        assert seen == dead


def test_routes_and_failing_tables(spark, tmp_path):
    ingest = engine(spark, tmp_path, topic_to_table=parse_overrides(["odd-topic:main.s.odd"]), flush_concurrency=2)
    out = ingest.batch(records(spark, ("a", 0, 0, value(V1, id=1, name="a")), ("odd-topic", 0, 0, value(V1, id=1, name="a"))))
    assert set(out.tables) == {"main.s.a", "main.s.odd"}
    with pytest.raises(RoutingError):
        ingest.batch(records(spark, ("orders-eu", 0, 0, value(V1, id=1, name="a"))))
    with pytest.raises(RoutingError):
        engine(spark, tmp_path, auto_create_tables=False).batch(records(spark, ("new", 0, 0, value(V1, id=1, name="a"))))


@pytest.mark.parametrize("topic", ["orders-eu", "orders/eu", "orders.eu", "orders eu", "a$b", "a" * 300, ""])
def test_rejected_topics(topic):
    with pytest.raises(RoutingError):
        table_name("main.s.${topic}", {}, topic)


@pytest.mark.parametrize("template", ["only.two", "a.b.${topic[5]}", "a.b.${topic[99999999999]}", ".a.${topic}", "main..${topic}", "a.b.c.${topic}"])
def test_rejected_templates(template):
    with pytest.raises(RoutingError):
        table_name(template, {}, "orders")


def test_accepted_routes():
    assert table_name("main.s.${topic}", {}, "orders_v2") == "main.s.orders_v2"
    assert table_name("bronze.${topic[1]}.${topic[3]}", {}, "shop.sales.dbo.customers") == "bronze.sales.customers"
    assert table_name("a.b.c", {}, "any topic") == "a.b.c"
    for bad in (["a"], ["a:b.c"], ["a:b.c.d", "a:e.f.g"]):
        with pytest.raises(ValueError):
            parse_overrides(bad)


@given(st.text(max_size=12), st.text(max_size=12))
def test_routing_is_injective(a, b):
    try:
        names = render("m.s.${topic}", a), render("m.s.${topic}", b)
    except RoutingError:
        return
    assert (names[0] == names[1]) == (a == b)


FIELDS = st.lists(st.tuples(st.sampled_from("abcdef"), st.sampled_from([T.IntegerType(), T.StringType()]), st.booleans()), max_size=5, unique_by=lambda f: f[0])


@given(FIELDS, FIELDS)
def test_diff(current, incoming):
    a, b = (T.StructType([T.StructField(*f) for f in x]) for x in (current, incoming))
    d = diff(a, b)
    kept = all(f.name in b.names and b[f.name].dataType == f.dataType for f in a)
    new = [f for f in b if f.name not in a.names]
    assert (d.breaking is None) == (kept and all(f.nullable for f in new))
    if d.breaking is None:
        assert list(d.added) == new and d.changed == bool(new)


def test_config():
    c = IngestConfig.of({"flush.size": "7", "topic.to.table": "a:b.c.d, e:f.g.h", "schema.evolution": "add", "partition.columns": "x, y"})
    assert c.flush_size == 7 and c.topic_to_table["e"] == "f.g.h" and c.schema_evolution is Evolution.ADD and c.partition_columns == ("x", "y")
    assert "hunter2" not in repr(IngestConfig(auth_token="hunter2")) and c.for_tasks(3) == [c, c, c]
    for bad in ({"flush_size": 0, "flush_interval_ms": 0}, {"flush_concurrency": 0}, {"auth_type": "x"}, {"catalog_url": "http://h"}, {"catalog_url": "https://h"}, {"catalog_url": "https://h", "auth_type": "oauth-m2m", "auth_client_id": "a"}):
        with pytest.raises(ConfigError):
            IngestConfig(**bad)
    for bad in ({"nope": "1"}, {"schema.evolution": "all"}, {"flush.size": "x"}):
        with pytest.raises(ConfigError):
            IngestConfig.of(bad)


DDL = "i8 tinyint, i16 smallint, i32 int, i64 bigint, f float, d double, b boolean, s string, y binary, ts timestamp, dt date, st struct<id:int,name:string>, arr array<string>, m map<string,int>, am array<map<string,int>>, ma map<string,array<int>>, sa array<struct<id:int>>"


def test_decode_inverts_encode(spark):
    ALL = T.StructType.fromDDL(DDL)  # noqa: N806
    rows = spark.sql("""select 1Y as i8, 2S as i16, 3 as i32, 4L as i64, cast(1.5 as float) as f, 2.5D as d, true as b, 'x"y' as s, X'00ff' as y, timestamp'2024-01-02 03:04:05.678' as ts, date'1969-12-30' as dt,
      named_struct('id', 1, 'name', cast(null as string)) as st, array('a', null) as arr, map('k', 1) as m, array(map('z', 2)) as am, map('q', array(1, 2)) as ma, array(named_struct('id', 5)) as sa""")
    nulls = spark.createDataFrame([tuple([None] * len(ALL))], ALL)
    empty = nulls.withColumn("arr", F.array().cast("array<string>")).withColumn("m", F.create_map().cast("map<string,int>"))
    both = rows.select(*(F.col(f.name).cast(f.dataType) for f in ALL)).unionAll(nulls).unionAll(empty)
    both = spark.createDataFrame(both.collect(), ALL)
    enc = encode(both, F.lit("t"), F.lit(0), F.lit(0), ALL)
    back = decode(enc, ALL)
    assert back.filter("not ok").count() == 0
    assert sorted(map(str, back.select("record.*").collect())) == sorted(map(str, both.collect()))


def test_maps_with_other_keys(spark):
    kind = T.StructType([T.StructField("m", T.MapType(T.IntegerType(), T.StructType([T.StructField("x", T.IntegerType())])))])
    v = '{"schema":{"type":"struct"},"payload":{"m":[[1,{"x":2}],[3,null]]}}'
    got = decode(records(spark, ("t", 0, 0, v)), kind).first()
    assert got.record.m[1].x == 2 and got.record.m[3] is None and got.ok


def test_subscribe(spark):
    r = records(spark, ("a.b", 0, 0, None), ("a.c", 0, 0, None), ("xa.b", 0, 0, None))
    assert subscribe(r, ["a.b"]).count() == 1 and subscribe(r, pattern=r"a\..*").count() == 2 and subscribe(r).count() == 3


def test_envelopes(spark):
    env = spark.sql("select * from values ('c', null, named_struct('id', 1)), ('u', named_struct('id', 1), named_struct('id', 2)), ('d', named_struct('id', 2), null), (null, null, null) v(op, before, after)")
    got = cdc.flatten_envelope(env)
    assert [tuple(r) for r in got.collect()] == [(1, "c", "false"), (2, "u", "false"), (2, "d", "true"), (None, None, "false")]
    assert cdc.flatten_envelope(env, rewrite_deletes=False).count() == 3


def test_scd1_clauses(spark):
    t = spark.sql("select * from values (1, 'a', 10L), (2, 'b', 10L), (3, 'c', 10L), (6, 'f', 10L), (7, 'g', 10L), (8, 'h', 10L) v(k, x, seq)")
    s = spark.sql("select * from values (1, 'A', 11L, 'u'), (2, 'B', 11L, 'd'), (4, 'D', 11L, 'c'), (5, 'E', 11L, 'd'), (6, 'F', 9L, 'u'), (7, 'G', null, 'u'), (8, 'H', 9L, 'd'), (9, 'I', 11L, null) v(k, x, seq, op)")
    want = [(1, "A", 11), (3, "c", 10), (4, "D", 11), (6, "f", 10), (7, "g", 10), (8, "h", 10)]
    assert sorted(map(tuple, cdc.scd1(t, s, ["k"], "seq").collect())) == want
    assert sorted(map(tuple, cdc.scd1(t, s, ["k"], "seq", guard_deletes=False).collect())) == want[:-1]


def test_latest_and_intervals(spark):
    df = spark.sql("select * from values (1, 10L, 0L, 'c'), (1, 10L, 1L, 'u'), (1, 12L, 2L, 'd'), (2, null, 3L, 'c') v(k, seq, off, op)")
    assert sorted((r.k, r.off) for r in cdc.latest_per_key(df, ["k"], ["seq", "off"]).collect()) == [(1, 2), (2, 3)]
    h = cdc.scd2(df, ["k"], ["seq", "off"], valid="seq").orderBy("off").collect()
    assert [(r.k, r["__start_at"], r["__end_at"]) for r in h] == [(1, 10, 10), (1, 10, 12), (2, None, None)]


def test_plan(spark):
    rows = records(spark, *(("t", 0, k, "xx") for k in range(5)))
    assert [r.flush for r in flush.plan(rows, flush_size=2).orderBy("offset").collect()] == [0, 0, 1, 1, 2]
    assert [r.flush for r in flush.plan(rows, flush_bytes=4, size=F.length("value")).orderBy("offset").collect()] == [0, 0, 1, 1, 2]


class Clock:
    now = 0.0

    def __call__(self):
        return self.now


def test_tables_are_resolved_anew(spark, tmp_path):
    clock = Clock()
    ingest = Ingest(spark, IngestConfig(root=str(tmp_path)), clock)
    first = ingest.table("a.b.c")
    clock.now = 40 * 60 - 0.001
    assert ingest.table("a.b.c") is first
    clock.now = 40 * 60
    assert ingest.table("a.b.c") is not first


def test_refreshing_token():
    clock, minted = Clock(), []

    class Minter:
        fail = False

        def mint(self):
            if self.fail:
                raise OSError("sig=LEAK")
            minted.append(1)
            return Token(f"t{len(minted)}", 1000)

    m = Minter()
    token = Refreshing(m, clock)
    assert token() == "t1"
    clock.now = 799
    assert token() == "t1"
    clock.now, m.fail = 801, True
    assert token() == "t1"
    clock.now = 1001
    with pytest.raises(PermissionError) as error:
        token()
    assert "LEAK" not in str(error.value)
    m.fail = False
    assert token() == "t2"


def test_minters():
    asked = []
    post = lambda url, headers, form: asked.append((url, headers, form)) or {"access_token": "x"}
    assert WorkspaceMinter("https://w/", "id", "s", post).mint() == Token("x", 3600) and asked[0][0] == "https://w/oidc/v1/token" and asked[0][1]["Authorization"].startswith("Basic ")
    assert EntraMinter("ten", "id", "s", "scope", post).mint().value == "x" and "ten" in asked[1][0]


@given(st.lists(st.tuples(st.sampled_from(["a", "a/b", "a/bc", "a/b/c", ""]), st.text("xyz", min_size=1, max_size=3)), max_size=8), st.sampled_from(["a", "a/b/c/d", "a/bc", "b", "a/b"]))
def test_scoped_secrets(puts, path):
    s = ScopedSecrets()
    own = {}
    for p, secret in puts:
        s.put("Acct.host.net", "c", p, secret)
        own[p] = secret
    fit = [p for p in own if p in ("", path) or path.startswith(p + "/")]
    want = own[max(fit, key=len)] if fit else None
    assert s.get("acct.host.net", "c", path) == want == s.get("acct", "c", path)


def test_scoped_secrets_bounds():
    s = ScopedSecrets(limit=2)
    for p in "abc":
        s.put("h.x", "c", p, p)
    assert s.get("h.x", "c", "a") is None and s.get("h.x", "c", "c/d") == "c"
    s.put("h.y", "c", "z", "z")
    assert s.get("h", "c", "z") is None and s.get("h.x", "other", "c") is None
    conf = storage_conf("abfss://cont@Acct.dfs.x.net/p/q", "SECRET", s, "own.Provider")
    assert conf["fs.azure.account.auth.type.acct.dfs.x.net"] == "SAS" and "SECRET" not in str(conf) and s.get("acct.dfs.x.net", "cont", "/p/q/r") == "SECRET"
    assert storage_conf("abfss://c@h/p", None, s, "x") == {}


def test_summary():
    got = summary(100, [3.0, 1.0], 2.0)
    assert got["rows_per_s"] == 50 and got["p50_s"] == got["p99_s"] == got["max_s"] == 3.0 and got["min_s"] == 1.0


def test_stream_restarts(spark, tmp_path):
    """A micro-batch that fails after one of its tables was committed is taken again, and adds nothing twice."""
    rows = [("a", 0, k, value(V1, id=k, name="x")) for k in range(5)] + [("b", 0, k, value(V1, id=k, name="y")) for k in range(5)]
    records(spark, *rows).coalesce(1).write.parquet(f"{tmp_path}/in")
    schema = records(spark, rows[0]).schema

    class Broken(Ingest):
        def _flush(self, rows, name, parts, out):
            if name.endswith(".b"):
                raise OSError("lost sig=LEAK")
            super()._flush(rows, name, parts, out)

    config = IngestConfig(root=f"{tmp_path}/t", table_name_format="main.s.${topic}")
    stream = lambda: spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
    with pytest.raises(Exception, match="lost"):
        sink.start(stream(), Broken(spark, config), f"{tmp_path}/cp", available_now=True).awaitTermination()
    ingest = Ingest(spark, config)
    assert ingest.table("main.s.a").read().count() == 5 and not ingest.table("main.s.b").exists()
    sink.start(stream(), ingest, f"{tmp_path}/cp", available_now=True).awaitTermination()
    assert ingest.table("main.s.a").read().count() == 5 and ingest.table("main.s.b").read().count() == 5
    assert sink.admission_options(config) == {"maxOffsetsPerTrigger": "1000000", "minOffsetsPerTrigger": "500", "maxTriggerDelay": "5000ms"}


def test_topics_start_with_the_dials_as_options(spark, tmp_path):
    from siltflow.streaming import sink

    asked = {}

    def reader(spark, servers, topics, pattern, streaming, **options):
        asked.update(servers=servers, topics=topics, pattern=pattern, **options)
        schema = "topic string, `partition` int, offset long, value string"
        spark.createDataFrame([("a.b.c", 0, k, '{"schema":{"type":"struct","fields":[{"type":"int32","optional":true,"field":"id"}],"optional":false},"payload":{"id":%d}}' % k) for k in range(5)], schema).write.parquet(f"{tmp_path}/in")
        return spark.readStream.schema(schema).parquet(f"{tmp_path}/in")

    ingest = Ingest(spark, IngestConfig(root=f"{tmp_path}/t", table_name_format="x.${topic[1]}.${topic[2]}", flush_size=7, flush_interval_ms=900, max_buffered=100))
    sink.start_topics(spark, "host:1", ingest, f"{tmp_path}/checkpoint", pattern="a.*", reader=reader, available_now=True, startingOffsets="earliest").awaitTermination()
    assert asked == {"servers": "host:1", "topics": None, "pattern": "a.*", "minOffsetsPerTrigger": "7", "maxTriggerDelay": "900ms", "maxOffsetsPerTrigger": "100", "startingOffsets": "earliest"}
    assert sorted(r.id for r in ingest.table("x.b.c").read().collect()) == list(range(5))


def test_a_write_that_fails_goes_to_the_dead_letters(spark, tmp_path):
    """One table can't be written to; the others of the batch are, and a replay sets nothing aside twice."""
    from siltflow.operators.routing import Catalog

    (tmp_path / "file").write_text("no folder")

    class Half(Catalog):
        def resolve(self, name, schema=None):
            target = super().resolve(name, schema)
            return type(target)(**{**target.__dict__, "path": f"{tmp_path}/file/t"}) if name.endswith("bad") else target

    own = records(spark, *((topic, 0, k, value(V1, id=k, name="a")) for topic in ("good", "bad") for k in range(3)))
    config = IngestConfig(root=f"{tmp_path}/t", table_name_format="main.s.${topic}")
    for _ in range(2):
        ingest = Ingest(spark, config, catalog=Half(config.root))
        out = ingest.batch(own)
        assert ingest.table("main.s.good").read().count() == 3 and out.next_offsets == {("good", 0): 3, ("bad", 0): 3}
        assert sorted((r.topic, r.offset) for r in ingest.dead_letters.read().collect()) == [("bad", 0), ("bad", 1), ("bad", 2)]
    assert len(out.errors) == 1
    from dataclasses import replace

    with pytest.raises(RuntimeError, match="main.s.bad"):
        Ingest(spark, replace(config, root=f"{tmp_path}/u", dead_letters=False), catalog=Half(f"{tmp_path}/u")).batch(own)


def test_refused_credentials_arent_the_records_fault(spark, tmp_path):
    from siltflow.operators.routing import Catalog

    class Refused(Catalog):
        def resolve(self, name, schema=None):
            raise RuntimeError("HTTP 401 Unauthorized, sig=secret")

    ingest = Ingest(spark, IngestConfig(root=f"{tmp_path}/t"), catalog=Refused(f"{tmp_path}/t"))
    value = '{"schema":{"type":"struct","fields":[],"optional":false},"payload":{}}'
    with pytest.raises(PermissionError, match="401") as error:
        ingest.batch(spark.createDataFrame([("topic", 0, 0, value)], "topic string, `partition` int, offset long, value string"))
    assert "secret" not in str(error.value) and not ingest.dead_letters.exists()


def test_byte_dial_of_a_backlog(spark, tmp_path):
    value = '{"schema":{"type":"struct","fields":[{"type":"int32","optional":true,"field":"id"}],"optional":false},"payload":{"id":1}}'
    df = spark.createDataFrame([("topic", 0, k, value) for k in range(20)], "topic string, `partition` int, offset long, value string")
    ingest = Ingest(spark, IngestConfig(root=f"{tmp_path}/t", flush_size=0, flush_bytes=5 * len(value)))
    done = ingest.backlog(df)
    assert len(done) == 4 and ingest.table("main.ingestion.topic").history().count() == 4 and ingest.backlog(df.limit(0)) == []
    ingest.backlog(df)
    assert ingest.table("main.ingestion.topic").read().count() == 20


@pytest.mark.parametrize("span", [1, 7, 1 << 16])
def test_plan_by_two_levels(spark, span):
    """Whatever the ranges, flushes are as one running sum a partition gives them."""
    import random

    rng, want, rows = random.Random(span), {}, []
    for p in (0, 1):
        off, before = 0, 0
        for k in range(60):
            off, text = off + rng.choice([1, 1, 1, 9, 40]), "x" * rng.choice([0, 1, 5, 30])
            rows.append(("t", p, off, text))
            want[p, off] = (k // 4, before // 50, max(k // 4, before // 50))
            before += len(text)
    rng.shuffle(rows)
    df, size = records(spark, *rows), F.length("value")
    for i, dials in enumerate(({"flush_size": 4}, {"flush_bytes": 50}, {"flush_size": 4, "flush_bytes": 50})):
        got = flush.plan(df, **dials, size=size, span=span)
        assert got.columns == [*df.columns, "flush"] and {(r.partition, r.offset): r.flush for r in got.collect()} == {k: v[i] for k, v in want.items()}


@pytest.mark.parametrize("each", [False, True])
def test_backlog_over_a_schema_change(spark, tmp_path, each):
    """Commits in order of the flushes, by two writes; a replay adds nothing, and unusable records are set aside once."""
    rows = [("t", p, k, "garbage" if k == 5 else value(V1, id=k, name="a") if k < 6 else value(V2, id=k, name="b", email="e")) for p in (0, 1) for k in range(12)]
    ingest = engine(spark, tmp_path, flush_size=2, schema_evolution=Evolution.MERGE, commit_per_partition=each)
    done = ingest.backlog(records(spark, *rows))
    t = ingest.table("main.s.t")
    assert len(done) == 6 and done[-1].next_offsets == {("t", 0): 12, ("t", 1): 12} and sum(o.dead for o in done) == 2
    assert sorted((r.id, r.email) for r in t.read().collect()) == sorted((k, "e" if k > 5 else None) for _, _, k, v in rows if v != "garbage")
    stamps = [max(a["txn"]["version"] for a in t._actions(v) if "txn" in a) for v in t._versions() if any("txn" in a for a in t._actions(v))]
    assert len(stamps) >= 6 and (each or stamps == sorted(stamps))
    n = t.snapshot().version
    assert all(not r.applied for o in ingest.backlog(records(spark, *rows)) for rs in o.tables.values() for r in rs) and t.snapshot().version == n
    assert not ingest.dead_letters.read().filter("value <> 'garbage'").select("error").distinct().collect()
    assert ingest.dead_letters.read().count() == 2 and not list((tmp_path / "_dealt").iterdir())


def test_backlog_beside_another_writer(spark, tmp_path):
    """Where another writer commits meanwhile, what is left is written anew without what it applied."""
    rows = [("t", 0, k, value(V1, id=k, name="a")) for k in range(10)]
    ingest = engine(spark, tmp_path, flush_size=2)
    ingest.batch(records(spark, *rows[:1]))
    t = ingest.table("main.s.t")
    put, first = t._put, []

    def racing(version, text):
        if not first:
            first.append(1)
            engine(spark, tmp_path).batch(records(spark, *rows[:5]))
        return put(version, text)

    t._put = racing
    ingest.backlog(records(spark, *rows))
    assert first and sorted(r.id for r in t.read().collect()) == list(range(10))


@pytest.mark.parametrize("span", [3, 50, 1 << 16])
def test_offsets_are_dense_and_a_partition_is_spread_over_tasks(spark, span):
    from siltflow.plans.queries import _placed

    ids = [None, None, -7, -1, 0, 1, 2, 5, 8, 50, 51, 52, 90, 400, 401, 100_000, 1 << 40]
    df = spark.createDataFrame([(i, u) for i in ids for u in (3, None)] + [(i, 4) for i in range(1000, 1300)], "event_id long, user_id long")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # it would put so few rows into one task
    try:
        rows = _placed(df, span).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    for part in (0, 1, None):
        own = sorted((r for r in rows if r.part == part), key=lambda r: r.off)
        assert [r.off for r in own] == list(range(len(own)))
        assert [r.event_id for r in own] == (list(range(1000, 1300)) if part == 1 else ids)
    if span == 3:
        assert len({r.task for r in rows if r.part == 1}) > 1
