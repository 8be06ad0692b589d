"""The engine's queries: each writes through the engine, reads back, and has its SQL over the source tables."""

from __future__ import annotations

import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltflow.functions.convert import date_of_millis, decimal_of_base64, timestamp_of_millis
from siltflow.functions.redact import is_already_exists, is_auth_failure, redact_column, redact_error
from siltflow.functions.sizing import record_size
from siltflow.functions.types import wire_schema
from siltflow.operators import cdc
from siltflow.operators.evolution import Evolution
from siltflow.operators.routing import Catalog
from siltflow.plans import credentials, flush, measure
from siltflow.plans.catalog import CatalogClient, FakeCatalog, RemoteCatalog, StagedCommits, authorised
from siltflow.plans.config import IngestConfig
from siltflow.plans.credentials import ScopedSecrets
from siltflow.plans.ingest import BackPressure, Ingest
from siltflow.sources import admission
from siltflow.sources.records import encode, read_records
from siltflow.sources.stats import Between
from siltflow.sources.storage import work_dir
from siltflow.sources.table import TxnTable
from siltflow.streaming import current, sink

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def put(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return put


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with times as whole microseconds and the change kind that their type stands for."""
    op = F.when(F.col("event_type") == "signup", "c").when(F.col("event_type") == "error", "d").otherwise("u")
    return _table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "props", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"), op.alias("op"))


EVENTS_SQL = "(SELECT event_id, user_id, event_type, value, props, epoch_us(ts) AS ts_us, CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op FROM events)"
PLACED_SQL = f"(SELECT *, user_id % 3 AS part, row_number() OVER (PARTITION BY user_id % 3 ORDER BY event_id) - 1 AS off FROM {EVENTS_SQL})"


def _placed(df: DataFrame, span: int = flush.SPAN) -> DataFrame:
    """Rows with a partition and dense offsets, as a topic would have them.

    They are numbered within ranges of ids, from where the ranges before end, so tasks share a partition; df is read twice.
    """
    rows = df.withColumn("part", (F.col("user_id") % 3).cast("int")).withColumn("__range", F.floor(F.col("event_id") / span))
    earlier = W.partitionBy("__part").orderBy("__at").rowsBetween(W.unboundedPreceding, -1)
    ranges = rows.groupBy(F.col("part").alias("__part"), F.col("__range").alias("__at")).agg(F.count("*").alias("__n"))
    ranges = ranges.select("__part", "__at", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    within = W.partitionBy("part", "__range").orderBy("event_id")
    rows = rows.join(ranges, F.col("part").eqNullSafe(F.col("__part")) & F.col("__range").eqNullSafe(F.col("__at")))
    return rows.select(*(F.col(f"`{c}`") for c in df.columns), "part", (F.col("__before") + F.row_number().over(within) - 1).cast("long").alias("off"))


def _records(df: DataFrame, columns: list[str], topic: Column | str = "shop.app.events") -> DataFrame:
    """Rows that have part and off, as change records of these columns."""
    schema = df.select(*columns).schema
    topic = F.lit(topic) if isinstance(topic, str) else topic
    return encode(df, topic, F.col("part"), F.col("off"), schema)


def _ingest(spark: SparkSession, name: str, **settings) -> Ingest:
    return Ingest(spark, IngestConfig(**{"root": work_dir(spark, name), "table_name_format": "bronze.${topic[1]}.${topic[2]}", "max_buffered": 0, "flush_concurrency": 4} | settings))


def _bronze(spark: SparkSession, sf_dir: str, name: str) -> TxnTable:
    """The events as an append-only table of changes."""
    t = TxnTable(spark, work_dir(spark, name))
    t.append(_events(spark, sf_dir), {f"{name}:events-0": 0})
    return t


COLUMNS = ["event_id", "user_id", "event_type", "value", "props", "ts_us"]


@query(f"SELECT {', '.join(COLUMNS)} FROM {EVENTS_SQL}")
def ingest_roundtrip_events(spark, sf_dir):
    ingest = _ingest(spark, "events")
    ingest.batch(_records(_placed(_events(spark, sf_dir)), COLUMNS))
    return ingest.table("bronze.app.events").read()


@query("SELECT * FROM orders")
def ingest_roundtrip_orders(spark, sf_dir):
    """Orders as change records and back."""
    o = _table(spark, sf_dir, "orders")
    placed = o.withColumn("part", (F.col("o_custkey") % 4).cast("int")).withColumn("off", F.col("o_orderkey"))
    ingest = _ingest(spark, "orders")
    ingest.batch(_records(placed, o.columns, "shop.app.orders"))
    return ingest.table("bronze.app.orders").read().withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))


@query("SELECT * FROM lineitem")
def ingest_roundtrip_lineitem(spark, sf_dir):
    """Line items as change records and back."""
    x = _table(spark, sf_dir, "lineitem")
    placed = x.withColumn("part", (F.col("l_orderkey") % 4).cast("int")).withColumn("off", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    ingest = _ingest(spark, "lineitem")
    ingest.batch(_records(placed, x.columns, "shop.app.lineitem"))
    return ingest.table("bronze.app.lineitem").read().withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp_ntz"))


@query("SELECT event_id, CASE op WHEN 'd' THEN 'b' || event_type ELSE event_type END AS event_type, value, op AS __op, ts_us AS __source_ts_us, CASE op WHEN 'd' THEN 'true' ELSE 'false' END AS __deleted FROM " + EVENTS_SQL)
def nested_envelope_roundtrip(spark, sf_dir):
    """Before/after envelopes through the record path, flattened, with deletes as rows of the before-image."""
    e = _placed(_events(spark, sf_dir))
    row = lambda prefix: F.struct("event_id", F.concat(F.lit(prefix), "event_type").alias("event_type"), "value")
    e = e.withColumn("before", F.when(F.col("op") != "c", row("b"))).withColumn("after", F.when(F.col("op") != "d", row(""))).withColumn("source", F.struct(F.lit("app").alias("db"), "ts_us"))
    ingest = _ingest(spark, "envelope")
    ingest.batch(_records(e, ["before", "after", "op", "source"]))
    return cdc.flatten_envelope(ingest.table("bronze.app.events").read(), {"source_ts_us": "source.ts_us"})


@query("SELECT vec_id, label, CAST(len(embedding) AS BIGINT) AS dims, CAST(embedding[1] AS DOUBLE) AS head FROM embeddings")
def array_roundtrip(spark, sf_dir):
    e = _table(spark, sf_dir, "embeddings").withColumn("user_id", F.col("vec_id")).withColumn("event_id", F.col("vec_id"))
    ingest = _ingest(spark, "arrays")
    ingest.batch(_records(_placed(e), ["vec_id", "label", "embedding"]))
    return ingest.table("bronze.app.events").read().select("vec_id", "label", F.size("embedding").cast("long").alias("dims"), F.element_at("embedding", 1).cast("double").alias("head"))


@query("SELECT event_id, event_type AS k, user_id AS v, CAST(1 AS BIGINT) AS n FROM events")
def map_roundtrip(spark, sf_dir):
    e = _placed(_events(spark, sf_dir)).withColumn("attrs", F.create_map("event_type", "user_id"))
    ingest = _ingest(spark, "maps")
    ingest.batch(_records(e, ["event_id", "attrs"]))
    read = ingest.table("bronze.app.events").read()
    return read.select("event_id", F.map_keys("attrs")[0].alias("k"), F.map_values("attrs")[0].alias("v"), F.size("attrs").cast("long").alias("n"))


@query("SELECT count(*) AS n, count(DISTINCT event_id) AS n_distinct FROM events")
def replay_idempotent(spark, sf_dir):
    ingest = _ingest(spark, "replay")
    records = _records(_placed(_events(spark, sf_dir)), COLUMNS)
    ingest.batch(records)
    ingest.batch(records)
    return ingest.table("bronze.app.events").read().agg(F.count("*").alias("n"), F.countDistinct("event_id").alias("n_distinct"))


@query("SELECT count(*) AS n, count(DISTINCT event_id) AS n_distinct FROM events")
def replay_shifted_boundaries(spark, sf_dir):
    """Batches that overlap in other cuts than those that were committed."""
    ingest = _ingest(spark, "shifted")
    placed = _placed(_events(spark, sf_dir)).persist()  # as records they are many times as large
    records = _records(placed, COLUMNS)
    for low, high in ((0, 40), (0, 77), (30, 200), (150, 1 << 40)):
        ingest.batch(records.filter(F.col("offset").between(low, high)))
    placed.unpersist()
    return ingest.table("bronze.app.events").read().agg(F.count("*").alias("n"), F.countDistinct("event_id").alias("n_distinct"))


def _mixed(spark, sf_dir) -> DataFrame:
    """Records of which some are tombstones, some aren't JSON, and some have another schema."""
    e = _placed(_events(spark, sf_dir))
    usual = _records(e.filter("event_id % 13 <> 0"), ["event_id", "user_id"])
    other = _records(e.filter("event_id % 13 = 0"), ["event_id", "user_id", "value"])
    keyed = usual.unionAll(other)
    value = F.when(F.col("offset") % 7 == 0, None).when(F.col("offset") % 11 == 0, "garbage").otherwise(F.col("value"))
    return keyed.withColumn("value", value)


KINDS_SQL = f"SELECT *, CASE WHEN off % 7 = 0 OR off % 11 = 0 THEN NULL WHEN event_id % 13 = 0 THEN 'other' ELSE 'usual' END AS kind FROM {PLACED_SQL}"


@query(f"""WITH k AS ({KINDS_SQL}), r AS (SELECT *, (SELECT arg_min(j.kind, j.off) FROM k j WHERE j.kind IS NOT NULL AND j.part = k.part) AS ref FROM k)
SELECT CAST(part AS INT) AS part, count(*) FILTER (WHERE kind = ref) AS good, count(*) FILTER (WHERE kind IS DISTINCT FROM ref) AS dead FROM r GROUP BY part""")
def poison_split(spark, sf_dir):
    """Rows in the table and in the dead letters, by partition; replayed once."""
    ingest = _ingest(spark, "poison", table_name_format="bronze.app.${topic[2]}")
    records = _mixed(spark, sf_dir)
    ingest.batch(records)
    ingest.batch(records)
    good = ingest.table("bronze.app.events").read().groupBy((F.col("user_id") % 3).cast("int").alias("part")).agg(F.count("*").alias("good"))
    dead = ingest.dead_letters.read().groupBy(F.col("partition").alias("part")).agg(F.count("*").alias("dead"))
    return good.join(dead, "part", "full_outer").select("part", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("dead", F.lit(0)).alias("dead"))


@query("SELECT 'bronze.app.' || event_type AS table_name, count(*) AS n, CAST(sum(user_id) AS BIGINT) AS users FROM events GROUP BY event_type")
def route_topics(spark, sf_dir):
    ingest = _ingest(spark, "routes")
    e = _placed(_events(spark, sf_dir))
    done = ingest.batch(_records(e, COLUMNS, F.concat(F.lit("src.app."), "event_type")))
    out = None
    for name in sorted(done.tables):
        own = ingest.table(name).read().agg(F.lit(name).alias("table_name"), F.count("*").alias("n"), F.sum("user_id").alias("users"))
        out = own if out is None else out.unionAll(own)
    return out


@query("SELECT event_id, user_id, CASE WHEN event_id % 2 = 1 THEN value END AS value FROM events")
def evolve_add_column(spark, sf_dir):
    """A first batch without a column and a second with it: old rows have nulls."""
    e = _events(spark, sf_dir)
    ingest = _ingest(spark, "evolve", schema_evolution=Evolution.ADD)
    ingest.batch(_records(_placed(e.filter("event_id % 2 = 0")), ["event_id", "user_id"]))
    odd = _placed(e.filter("event_id % 2 = 1")).withColumn("off", F.col("off") + (1 << 32))
    ingest.batch(_records(odd, ["event_id", "user_id", "value"]))
    return ingest.table("bronze.app.events").read()


@query("SELECT count(*) FILTER (WHERE event_id % 2 = 0) AS n, count(*) FILTER (WHERE event_id % 2 = 1) AS dead FROM events")
def evolve_breaking(spark, sf_dir):
    """A batch whose column has another type goes to the dead letters."""
    e = _events(spark, sf_dir)
    ingest = _ingest(spark, "breaking", schema_evolution=Evolution.ADD)
    ingest.batch(_records(_placed(e.filter("event_id % 2 = 0")), ["event_id", "value"]))
    odd = _placed(e.filter("event_id % 2 = 1")).withColumn("off", F.col("off") + (1 << 32)).withColumn("value", F.col("value").cast("string"))
    ingest.batch(_records(odd, ["event_id", "value"]))
    n = ingest.table("bronze.app.events").read().agg(F.count("*").alias("n"))
    return n.crossJoin(ingest.dead_letters.read().agg(F.count("*").alias("dead")))  # one row by one row


@query(f"SELECT event_id, user_id, event_type, value, op FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM {EVENTS_SQL}) WHERE rn = 1")
def latest_per_key(spark, sf_dir):
    return cdc.latest_per_key(_bronze(spark, sf_dir, "latest").read(), ["user_id"], ["event_id"]).select("event_id", "user_id", "event_type", "value", "op")


SCD1_SQL = f"SELECT user_id, event_type, value, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM {EVENTS_SQL}) WHERE rn = 1 AND op <> 'd'"


@query(SCD1_SQL)
def scd1_apply(spark, sf_dir):
    """Current rows, brought up to date in three steps of which the last is a replay."""
    bronze = _bronze(spark, sf_dir, "scd1").read()
    t = TxnTable(spark, work_dir(spark, "scd1-current"))
    for part in (bronze.filter("event_id % 3 <> 2"), bronze, bronze):
        cdc.apply_changes(part, t, ["user_id"], ["event_id"], ["user_id", "event_type", "value"])
    return cdc.current(t)


@query(SCD1_SQL)
def replay_guard(spark, sf_dir):
    """Older changes after newer ones, creates and deleted keys included, leave current rows as they are."""
    bronze = _bronze(spark, sf_dir, "guard").read()
    t = TxnTable(spark, work_dir(spark, "guard-current"))
    cdc.apply_changes(bronze, t, ["user_id"], ["event_id"], ["user_id", "event_type", "value"])
    last = bronze.groupBy("user_id").agg(F.max("event_id").alias("m")).withColumnRenamed("user_id", "u")
    older = bronze.join(last, (F.col("user_id") == F.col("u")) & (F.col("event_id") < F.col("m"))).select(bronze.columns)
    cdc.apply_changes(older, t, ["user_id"], ["event_id"], ["user_id", "event_type", "value"])
    return cdc.current(t)


@query(SCD1_SQL)
def scd1_incremental(spark, sf_dir):
    """Three commits of changes, each applied on its own from the files that it added."""
    bronze, t = TxnTable(spark, work_dir(spark, "increments")), TxnTable(spark, work_dir(spark, "increments-current"))
    e = _events(spark, sf_dir)
    for k in (1, 0, 2):  # out of order
        bronze.append(e.filter(F.col("event_id") % 3 == k), {"increments:events-0": (1, 0, 2).index(k)})
        cdc.apply_new(bronze, t, ["user_id"], ["event_id"], ["user_id", "event_type", "value"])
    return cdc.current(t)


@query(SCD1_SQL)
def disjoint_rewrites(spark, sf_dir):
    """Two writers that read the same version: of other buckets, both commit; of the same ones, the second starts anew."""
    bronze = _bronze(spark, sf_dir, "disjoint").read()
    t = TxnTable(spark, work_dir(spark, "disjoint-current"))
    apply = lambda rows, **at: cdc.apply_changes(rows, t, ["user_id"], ["event_id"], ["user_id", "event_type", "value"], **at)
    read = apply(bronze.filter("event_id % 4 = 0")).version
    own = F.pmod(F.hash("user_id"), F.lit(cdc.BUCKETS)) % 2
    apply(bronze.filter((F.col("event_id") % 4 == 1) & (own == 0)), read_version=read)
    apply(bronze.filter((F.col("event_id") % 4 == 1) & (own == 1)), read_version=read)
    apply(bronze.filter("event_id % 4 > 1"), read_version=read)
    return cdc.current(t)


@query(SCD1_SQL)
def stream_current(spark, sf_dir):
    """Current rows kept by a stream with state by key, over changes in no order, some of them twice; it is stopped and started again in between."""
    base = work_dir(spark, "stream-current")
    t, e = TxnTable(spark, f"{base}/current"), _events(spark, sf_dir)
    for part in (e.filter("event_id % 3 <> 0"), e.filter("event_id % 3 < 2")):
        part.repartition(2, F.hash("event_id") % 2).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
        current.start_current(stream, t, ["user_id"], ["event_id"], ["user_id", "event_type", "value"], f"{base}/checkpoint", available_now=True).awaitTermination()
    return cdc.current(t)


@query("SELECT count(*) AS n, count(*) FILTER (WHERE op = 'd') AS deletes FROM " + EVENTS_SQL)
def tombstone_intake(spark, sf_dir):
    """Records with a null value, as a source sends them after each delete, are set aside and don't hold up the others."""
    e = _placed(_events(spark, sf_dir))
    ingest = _ingest(spark, "tombstones")
    records = _records(e, ["event_id", "op"]).withColumn("offset", F.col("offset") * 2)
    after = records.filter(F.col("value").contains('"op":"d"')).select("topic", "partition", (F.col("offset") + 1).alias("offset"), F.lit(None).cast("string").alias("value"))
    ingest.batch(records.unionAll(after))
    n = ingest.table("bronze.app.events").read().agg(F.count("*").alias("n"))
    return n.crossJoin(ingest.dead_letters.read().agg(F.count("*").alias("deletes")))  # one row by one row


SCD2_SQL = f"SELECT user_id, event_type, value, event_id, ts_us, ts_us AS __start_at, e AS __end_at FROM (SELECT *, lead(ts_us) OVER (PARTITION BY user_id ORDER BY event_id) AS e FROM {EVENTS_SQL}) WHERE op <> 'd'"
VERSION = ["user_id", "event_type", "value", "event_id", "ts_us"]


@query(SCD2_SQL)
def scd2_apply(spark, sf_dir):
    t = TxnTable(spark, work_dir(spark, "scd2-history"))
    cdc.apply_changes(_bronze(spark, sf_dir, "scd2").read(), t, ["user_id"], ["event_id"], VERSION, stored_as_scd_type=2, valid="ts_us")
    return cdc.history(t)


@query(SCD2_SQL)
def scd2_incremental(spark, sf_dir):
    """Three commits of changes, out of order, spliced into the history one after the other; the last call has nothing new."""
    bronze, t = TxnTable(spark, work_dir(spark, "splices")), TxnTable(spark, work_dir(spark, "splices-history"))
    e = _events(spark, sf_dir)
    for at, k in enumerate((1, 0, 2)):
        bronze.append(e.filter(F.col("event_id") % 3 == k), {"splices:events-0": at})
        cdc.apply_new(bronze, t, ["user_id"], ["event_id"], VERSION, stored_as_scd_type=2, valid="ts_us")
    cdc.apply_new(bronze, t, ["user_id"], ["event_id"], VERSION, stored_as_scd_type=2, valid="ts_us")
    return cdc.history(t)


@query(SCD1_SQL)
def growing_buckets(spark, sf_dir):
    """Current rows in buckets of eight on average: the table begins with two buckets, and its growth splits them."""
    bronze, t = _bronze(spark, sf_dir, "growing").read(), TxnTable(spark, work_dir(spark, "growing-current"))
    for least in (97, 80, 0):
        cdc.apply_changes(bronze.filter(F.col("user_id") % 100 >= least), t, ["user_id"], ["event_id"], ["user_id", "event_type", "value"], buckets=2, bucket_rows=8)
    return cdc.current(t)


@query(f"SELECT event_id, CASE WHEN op = 'd' THEN 'true' ELSE 'false' END AS __deleted, op AS __op FROM {EVENTS_SQL}")
def delete_rewrite(spark, sf_dir):
    e = _bronze(spark, sf_dir, "deletes").read()
    row = F.struct("event_id", "user_id")
    env = e.select(F.when(F.col("op") != "c", row).alias("before"), F.when(F.col("op") != "d", row).alias("after"), "op")
    return cdc.flatten_envelope(env).select("event_id", "__deleted", "__op")


@query(f"SELECT CAST(part AS INT) AS part, CAST(floor(off / 500) AS BIGINT) AS flush, count(*) AS n FROM {PLACED_SQL} GROUP BY ALL")
def flush_plan_rows(spark, sf_dir):
    placed = _placed(_bronze(spark, sf_dir, "flush").read())
    return flush.plan(placed, flush_size=500, keys=("part",), order="off").groupBy("part", "flush").agg(F.count("*").alias("n"))


SIZE_SQL = "8 + 8 + 2 * length(event_type) + 8 + 2 * length(props) + 8"


@query(f"""SELECT CAST(part AS INT) AS part, CAST(floor(coalesce(b, 0) / 20000) AS BIGINT) AS flush, count(*) AS n FROM (
SELECT part, sum({SIZE_SQL}) OVER (PARTITION BY part ORDER BY off ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM {PLACED_SQL}) GROUP BY ALL""")
def flush_plan_bytes(spark, sf_dir):
    bronze = _bronze(spark, sf_dir, "flush-bytes").read()
    size = record_size(bronze.select(COLUMNS).schema)
    return flush.plan(_placed(bronze), flush_bytes=20_000, size=size, keys=("part",), order="off").groupBy("part", "flush").agg(F.count("*").alias("n"))


@query(f"SELECT event_id, CAST({SIZE_SQL} AS BIGINT) AS bytes FROM {EVENTS_SQL}")
def record_size_events(spark, sf_dir):
    bronze = _bronze(spark, sf_dir, "sizes").read()
    return bronze.select("event_id", record_size(bronze.select(COLUMNS).schema).alias("bytes"))


@query("SELECT doc_id, CAST(8 + 2 * length(text) + 2 * length(lang) + 2 * length(source) + 8 AS BIGINT) AS bytes FROM documents")
def record_size_documents(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return docs.select("doc_id", record_size(docs.schema).alias("bytes"))


SECRET_SQL = "'Authorization: Bearer ' || event_type || '.x-' || event_id || ' at abfss://c@h/' || user_id || '?sig=k&se=2 then sig=' || user_id || '&se=2026 {\"sas_token\":\"' || event_type || '\"} database=sales'"


@query(rf"""SELECT event_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace({SECRET_SQL},
 '(?i)abfss?://[^\s"''<]+', 'abfss://<redacted>', 'g'),
 '(?i)(sig|se|st|skoid|sktid|sks|ske|skt|skv|spr|srt|ss|sp|sr|sv|sdd)=[^&\s"'']+', '\1=<redacted>', 'g'),
 '(?i)("?sas_token"?\s*[:=]\s*"?)[^"&\s,}}]+', '\1<redacted>', 'g'),
 '(?i)(bearer\s+)[A-Za-z0-9._\-]+', '\1<redacted>', 'g') AS said FROM events""")
def redact_text(spark, sf_dir):
    text = F.concat(F.lit("Authorization: Bearer "), "event_type", F.lit(".x-"), "event_id", F.lit(" at abfss://c@h/"), "user_id", F.lit("?sig=k&se=2 then sig="), "user_id", F.lit('&se=2026 {"sas_token":"'), "event_type", F.lit('"} database=sales'))
    return _table(spark, sf_dir, "events").select("event_id", redact_column(text).alias("said"))


@query("SELECT CAST(row_number() OVER (ORDER BY k) - 1 AS BIGINT) AS version, n AS num_output_rows, 'Append' AS mode, true AS is_blind_append FROM (SELECT event_id % 4 AS k, count(*) AS n FROM events GROUP BY 1)")
def commit_history(spark, sf_dir):
    t = TxnTable(spark, work_dir(spark, "history"))
    e = _events(spark, sf_dir)
    for k in range(4):
        t.append(e.filter(F.col("event_id") % 4 == k), {"history:events-0": k})
        t.append(e.filter(F.col("event_id") % 4 == k), {"history:events-0": k})  # a replay makes no version
    return t.history().select("version", "num_output_rows", "mode", "is_blind_append")


@query("SELECT event_id, event_type, value FROM events WHERE event_type = 'click'")
def partitioned_append(spark, sf_dir):
    """Only the files of one partition value are read."""
    t = TxnTable(spark, work_dir(spark, "partitioned"))
    t.append(_events(spark, sf_dir).select("event_id", "event_type", "value"), partition_columns=["event_type"])
    return t.read(where={"event_type": "click"})


SLICES_SQL = "(SELECT event_id, event_type, CASE WHEN event_id % 17 = 0 THEN 'NaN'::DOUBLE WHEN event_id % 19 <> 0 THEN value END AS value, CAST(event_id * 12 // (SELECT max(event_id) + 1 FROM events) AS INT) AS slice FROM events)"


def _sliced(spark, sf_dir, name: str, **settings) -> TxnTable:
    """Events in twelve files by event_id; some values are NaN, some null."""
    e = _table(spark, sf_dir, "events")
    n = e.agg(F.max("event_id") + 1).first()[0]
    value = F.when(F.col("event_id") % 17 == 0, F.lit(float("nan"))).when(F.col("event_id") % 19 != 0, F.col("value"))
    t = TxnTable(spark, work_dir(spark, name), **settings)
    rows = e.select("event_id", "event_type", value.alias("value"), F.expr(f"event_id * 12 div {n}").cast("int").alias("slice"))
    t.append(rows.repartition(12, "slice"), partition_columns=["slice"])
    return t


@query(f"""WITH s AS {SLICES_SQL}, b AS (SELECT max(event_id) // 3 AS low, max(event_id) // 2 AS high FROM s), f AS (SELECT slice, min(event_id) <= max(high) AND max(event_id) >= max(low) AS met FROM s, b GROUP BY slice)
SELECT event_id, event_type, isnan(value) AS not_a_number, (SELECT count(*) FILTER (NOT met) FROM f) AS left_out, (SELECT count(*) FROM f) AS files FROM s, b WHERE event_id BETWEEN low AND high AND value >= 10""")
def range_read(spark, sf_dir):
    """Rows of a range of ids and values, and how many files their bounds left out."""
    t = _sliced(spark, sf_dir, "ranges")
    top = t.read().agg(F.max("event_id")).first()[0]
    where = {"event_id": Between(top // 3, top // 2), "value": Between(low=10.0)}
    left_out, files = t.skipped(where)
    return t.read(where=where).select("event_id", "event_type", F.isnan("value").alias("not_a_number"), F.lit(left_out).cast("long").alias("left_out"), F.lit(files).cast("long").alias("files"))


@query(f"SELECT event_id, event_type, slice, CAST(4 AS BIGINT) AS versions FROM {SLICES_SQL} WHERE slice NOT IN (2, 5) OR event_id % 2 = 0")
def log_replay(spark, sf_dir):
    """A table whose log is replayed by an aggregation, from a checkpoint and later commits, as the driver keeps two actions only."""
    t = _sliced(spark, sf_dir, "replayed", max_tail=2)
    for k in (2, 5, 2):
        t.overwrite(t.read(where={"slice": str(k)}).filter("event_id % 2 = 0"), where={"slice": {str(k)}})
        t.maintain(every=2)
    again = TxnTable(spark, t.path, max_tail=2)
    return again.read().select("event_id", "event_type", "slice", F.lit(again.snapshot().version + 1).cast("long").alias("versions"))


@query("SELECT count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids, CAST(12 AS BIGINT) AS versions FROM events")
def checkpoint_restart(spark, sf_dir):
    """A reader that starts from the checkpoint sees what the log holds."""
    path = work_dir(spark, "checkpoint")
    t = TxnTable(spark, path)
    e = _events(spark, sf_dir)
    for k in range(12):
        t.append(e.filter(F.col("event_id") % 12 == k).coalesce(1), {"cp:events-0": k})
    t.maintain()
    again = TxnTable(spark, path)
    versions = again.snapshot().version + 1
    return again.read().agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"), F.lit(versions).cast("long").alias("versions"))


@query(f"SELECT CAST(part AS INT) AS part, max(off) + 1 AS next_offset FROM {PLACED_SQL} GROUP BY part")
def offset_gate(spark, sf_dir):
    """The next offset of each partition after a batch."""
    done = _ingest(spark, "gate").batch(_records(_placed(_events(spark, sf_dir)), ["event_id", "user_id"]))
    return spark.createDataFrame([(p, n) for (_, p), n in sorted(done.next_offsets.items())], "part int, next_offset long")


@query(f"SELECT {', '.join(COLUMNS)} FROM {EVENTS_SQL}")
def stream_ingest(spark, sf_dir):
    """Records from a file stream, stopped after some micro-batches and started again."""
    base = work_dir(spark, "stream")
    records = _records(_placed(_events(spark, sf_dir)), COLUMNS)
    records.repartition(3, "partition").write.parquet(f"{base}/in")
    for _ in range(2):
        ingest = _ingest(spark, "stream", root=f"{base}/tables")
        stream = spark.readStream.schema(records.schema).option("maxFilesPerTrigger", 2).parquet(f"{base}/in")
        q = sink.start(stream, ingest, f"{base}/checkpoint", available_now=True)
        q.awaitTermination()
        ingest.close()
    return ingest.table("bronze.app.events").read()


@query("SELECT event_id, CAST(trunc(((event_id - 500) * 40000001) / 86400000.0) AS INT) AS day_number, (event_id - 500) * 40000001 * 1000 AS ts_us FROM events")
def convert_times(spark, sf_dir):
    ms = (F.col("event_id") - 500) * 40_000_001
    return _table(spark, sf_dir, "events").select("event_id", F.unix_date(date_of_millis(ms)).alias("day_number"), F.unix_micros(timestamp_of_millis(ms)).alias("ts_us"))


@query("SELECT event_id, CAST(CAST((event_id - 500) * 1234567 AS DECIMAL(38,0)) / 1000 AS DECIMAL(38,3)) AS amount FROM events")
def convert_decimals(spark, sf_dir):
    """Decimals from base64 of two's-complement bytes."""
    n = (F.col("event_id") - 500) * 1_234_567
    raw = F.base64(F.unhex(F.lpad(F.hex(n), 16, "0")))
    return _table(spark, sf_dir, "events").select("event_id", decimal_of_base64(raw, 3).alias("amount"))


@query("SELECT CASE WHEN i % 13 = 0 THEN 'd' WHEN i % 7 = 0 THEN 'u' ELSE 'c' END AS op, count(*) AS n, count(*) FILTER (WHERE i % 13 = 0 OR i % 7 = 0) AS befores, count(*) FILTER (WHERE i % 13 <> 0) AS afters FROM range(25000) t(k), LATERAL (SELECT k % 10000 AS i) GROUP BY 1")
def generate_envelopes(spark, sf_dir):
    return measure.envelope_rows(spark, 25_000).groupBy("op").agg(F.count("*").alias("n"), F.count("before").alias("befores"), F.count("after").alias("afters"))


@query("SELECT CASE WHEN i % 13 = 0 THEN 'd' WHEN i % 7 = 0 THEN 'u' ELSE 'c' END AS op, count(*) AS n, CAST(sum(i) AS BIGINT) AS lsns FROM range(25000) t(k), LATERAL (SELECT k % 10000 AS i) GROUP BY 1")
def generate_flat(spark, sf_dir):
    return measure.flat_rows(spark, 25_000).groupBy("op").agg(F.count("*").alias("n"), F.sum("lsn").alias("lsns"))


@query("SELECT k AS table_no, count(*) AS n FROM events, range(4) t(k) WHERE event_id % 4 = k GROUP BY k")
def many_tables_at_once(spark, sf_dir):
    """Four tables of one batch, committed by four threads."""
    e = _placed(_events(spark, sf_dir))
    ingest = _ingest(spark, "many", flush_concurrency=4)
    done = ingest.batch(_records(e, ["event_id"], F.concat(F.lit("src.app.t"), (F.col("event_id") % 4).cast("string"))))
    out = None
    for name in sorted(done.tables):
        own = ingest.table(name).read().agg(F.lit(int(name[-1])).cast("long").alias("table_no"), F.count("*").alias("n"))
        out = own if out is None else out.unionAll(own)
    return out


@query("SELECT event_id, user_id, CASE WHEN event_id % 2 = 1 THEN value END AS value, 'CREATE TABLE IF NOT EXISTS `bronze`.`app`.`events` (`event_id` BIGINT, `user_id` BIGINT); ALTER TABLE `bronze`.`app`.`events` ADD COLUMNS (`value` DOUBLE)' AS statements, 'sig=id-0' AS secret FROM events")
def catalog_ingest(spark, sf_dir):
    """Two batches through a catalog service: token, lookup, CREATE TABLE, vended secret, ALTER TABLE."""
    place = work_dir(spark, "catalog")
    service, secrets = FakeCatalog(place), ScopedSecrets()
    token = credentials.Refreshing(credentials.WorkspaceMinter("https://w", "id", "secret", lambda url, headers, form: {"access_token": "t", "expires_in": 3600}))
    catalog = RemoteCatalog(CatalogClient(authorised(service, token)), secrets, "wh", "provider")
    ingest = _ingest(spark, "catalog-dead", schema_evolution=Evolution.ADD)
    ingest = Ingest(spark, ingest.config, catalog=catalog, coordinator=StagedCommits)
    e = _events(spark, sf_dir)
    ingest.batch(_records(_placed(e.filter("event_id % 2 = 0")), ["event_id", "user_id"]))
    odd = _placed(e.filter("event_id % 2 = 1")).withColumn("off", F.col("off") + (1 << 32))
    ingest.batch(_records(odd, ["event_id", "user_id", "value"]))
    credentials.storage_conf("abfss://c@acct.dfs.example/t", catalog.client.credentials("id-0")["sas_token"], secrets, "provider")
    if any(t != "t" for *_, t in service.calls):
        raise AssertionError("a request without its token")
    return ingest.table("bronze.app.events").read().select("event_id", "user_id", "value", F.lit("; ".join(service.statements)).alias("statements"), F.lit(secrets.get("acct.dfs.example", "c", "/t/part-0")).alias("secret"))


@query("SELECT count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids, CAST(8 AS BIGINT) AS versions FROM events")
def staged_commits(spark, sf_dir):
    """Two writers whose commits a coordinator ratifies; one published commit file is there already."""
    path = work_dir(spark, "staged")
    writers = [TxnTable(spark, path, coordinator=StagedCommits) for _ in range(2)]
    e = _events(spark, sf_dir)
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda w: [writers[w].append(e.filter(F.col("event_id") % 8 == k), {f"staged:events-{w}": k}) for k in range(w, 8, 2)], range(2)))
    reader = TxnTable(spark, path)
    return reader.read().agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"), F.lit(reader.snapshot().version + 1).cast("long").alias("versions"))


@query(f"SELECT flush AS version, count(*) AS num_output_rows FROM (SELECT CAST(floor(off / 1500) AS BIGINT) AS flush FROM {PLACED_SQL}) GROUP BY flush")
def dialled_commits(spark, sf_dir):
    """A backlog committed as buffers of 1,500 rows a partition would have."""
    ingest = _ingest(spark, "dials", flush_size=1500)
    stored = f"{work_dir(spark, 'dials-records')}"
    _records(_placed(_events(spark, sf_dir)), ["event_id", "user_id"]).write.parquet(stored)
    ingest.backlog(read_records(spark, stored))
    return ingest.table("bronze.app.events").history().filter("num_output_rows > 0").select("version", "num_output_rows")


#: The bytes of such a value beside its two numbers.
VALUE_BYTES = len('{"schema":,"payload":{"event_id":,"user_id":}}') + len(json.dumps(wire_schema(T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType())])), separators=(",", ":")))


@query(f"""WITH b AS (SELECT part, {VALUE_BYTES} + length(CAST(event_id AS VARCHAR)) + length(CAST(user_id AS VARCHAR)) AS bytes, off FROM {PLACED_SQL}),
f AS (SELECT coalesce(sum(bytes) OVER (PARTITION BY part ORDER BY off ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // 100000 AS flush FROM b)
SELECT CAST(dense_rank() OVER (ORDER BY flush) - 1 AS BIGINT) AS version, count(*) AS num_output_rows FROM f GROUP BY flush""")
def dialled_bytes(spark, sf_dir):
    """A backlog committed as buffers of 100,000 bytes a partition would have."""
    ingest = _ingest(spark, "byte-dials", flush_size=0, flush_bytes=100_000)
    stored = work_dir(spark, "byte-dials-records")
    _records(_placed(_events(spark, sf_dir)), ["event_id", "user_id"]).write.parquet(stored)
    ingest.backlog(read_records(spark, stored))
    return ingest.table("bronze.app.events").history().filter("num_output_rows > 0").select("version", "num_output_rows")


#: Both dials trip: the bytes are those of 2,500 values with six digits and a half.
STREAM_ROWS, STREAM_BYTES = 2500, 2500 * VALUE_BYTES + 16_250


@query(f"""WITH RECURSIVE b AS (SELECT part, off, {VALUE_BYTES} + length(CAST(event_id AS VARCHAR)) + length(CAST(user_id AS VARCHAR)) AS bytes FROM {PLACED_SQL}),
c AS (SELECT part, off, CAST(sum(bytes) OVER (PARTITION BY part ORDER BY off) AS BIGINT) AS total, max(off) OVER (PARTITION BY part) AS last FROM b),
f AS (SELECT part, CAST(-1 AS BIGINT) AS version, CAST(-1 AS BIGINT) AS low, CAST(-1 AS BIGINT) AS high, CAST(0 AS BIGINT) AS total FROM b GROUP BY part
UNION ALL SELECT f.part, f.version + 1, f.high, CAST(min(c.off) AS BIGINT), min(c.total) FROM f JOIN c ON c.part = f.part AND c.off > f.high AND (c.off - f.high >= {STREAM_ROWS} OR c.total - f.total >= {STREAM_BYTES} OR c.off = c.last)
GROUP BY f.part, f.version, f.high)
SELECT high - low AS num_output_rows, count(*) AS commits FROM f WHERE version >= 0 GROUP BY 1""")
def stream_dials(spark, sf_dir):
    """Stored records as a stream cut by rows and bytes of each partition. It is stopped when only buffers under the dials wait, and started again for them and further records."""
    base = work_dir(spark, "stream-dials")
    records = _records(_placed(_events(spark, sf_dir)), ["event_id", "user_id"])
    early = F.col("offset") < (records.agg(F.max("offset")).first()[0] or 0) * 4 // 5
    for part, wait in ((records.filter(early), "600000"), (records.filter(~early), "0")):
        admission.store(part, f"{base}/in")
        ingest = _ingest(spark, "stream-dials", root=f"{base}/tables", flush_size=STREAM_ROWS, flush_bytes=STREAM_BYTES, commit_per_partition=True)
        q = sink.start_stored(spark, f"{base}/in", ingest, f"{base}/checkpoint", wait_ms=wait)
        q.processAllAvailable()
        q.stop()
        ingest.close()
    commits = ingest.table("bronze.app.events").history().filter("num_output_rows > 0")
    return commits.groupBy("num_output_rows").agg(F.count("*").alias("commits"))


@query("SELECT 'bronze.app.' || event_type AS table_name, count(*) AS n FROM events WHERE event_type IN ('click', 'view') GROUP BY event_type")
def subscribe_pattern(spark, sf_dir):
    """Of many topics only those that a pattern matches as a whole."""
    stored = work_dir(spark, "topics")
    _records(_placed(_events(spark, sf_dir)), ["event_id"], F.concat(F.lit("src.app."), "event_type")).write.parquet(stored)
    ingest = _ingest(spark, "subscribed")
    done = ingest.batch(read_records(spark, stored, pattern=r"src\.app\.(click|vie.)"))
    out = None
    for name in sorted(done.tables):
        own = ingest.table(name).read().agg(F.lit(name).alias("table_name"), F.count("*").alias("n"))
        out = own if out is None else out.unionAll(own)
    return out


@query("SELECT CASE event_type WHEN 'click' THEN 'lake.web.clicks' ELSE 'bronze.app.' || event_type END AS table_name, count(*) AS n FROM events GROUP BY 1")
def route_overrides(spark, sf_dir):
    """A topic with a table of its own, by settings as text."""
    settings = {"root": work_dir(spark, "overrides"), "table.name.format": "bronze.${topic[1]}.${topic[2]}", "topic.to.table": "src.app.click:lake.web.clicks", "flush.concurrency": "3", "max.buffered": "0"}
    ingest = Ingest(spark, IngestConfig.of(settings))
    done = ingest.batch(_records(_placed(_events(spark, sf_dir)), ["event_id"], F.concat(F.lit("src.app."), "event_type")))
    out = None
    for name in sorted(done.tables):
        own = ingest.table(name).read().agg(F.lit(name).alias("table_name"), F.count("*").alias("n"))
        out = own if out is None else out.unionAll(own)
    return out


@query(f"SELECT CAST(part AS INT) AS part, max(off) + 1 AS next_offset, count(*) AS dead FROM {PLACED_SQL} GROUP BY part")
def all_poison_progress(spark, sf_dir):
    """Batches without a usable record: all of it is set aside, and the offsets go on."""
    ingest = _ingest(spark, "poison-only")
    done = ingest.batch(_records(_placed(_events(spark, sf_dir)), ["event_id"]).withColumn("value", F.lit("no envelope")))
    dead = ingest.dead_letters.read().groupBy(F.col("partition").alias("part")).agg(F.count("*").alias("dead"))
    gate = spark.createDataFrame([(p, n) for (_, p), n in sorted(done.next_offsets.items())], "part int, next_offset long")
    return gate.join(dead, "part")


@query("SELECT t.k AS task, count(*) AS n FROM range(3) t(k), events WHERE user_id % 3 = t.k GROUP BY t.k")
def task_fanout(spark, sf_dir):
    """Three ingestions of the same settings, each with a partition of its own, into one table at once."""
    config = IngestConfig(root=work_dir(spark, "fanout"), table_name_format="bronze.${topic[1]}.${topic[2]}", max_buffered=0)
    records = _records(_placed(_events(spark, sf_dir)), ["event_id", "user_id"])
    tasks = [Ingest(spark, c) for c in config.for_tasks(3)]
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda k: tasks[k].batch(records.filter(F.col("partition") == k)), range(3)))
    return tasks[0].table("bronze.app.events").read().groupBy((F.col("user_id") % 3).alias("task")).agg(F.count("*").alias("n"))


@query("SELECT k * 60 AS at_s, 'token-' || CAST(floor(k * 60 / 2880.0) + 1 AS BIGINT) AS token FROM range(240) t(k)")
def token_schedule(spark, sf_dir):
    """Tokens of an hour, asked for each minute over four hours: renewed at 80 % of their life."""
    now, minted = [0.0], []

    def post(url, headers, form):
        minted.append(url)
        return {"access_token": f"token-{len(minted)}", "expires_in": 3600}

    token = credentials.Refreshing(credentials.EntraMinter("tenant", "id", "secret", "scope", post), clock=lambda: now[0])
    rows = []
    for k in range(240):
        now[0] = k * 60.0
        rows.append((k * 60, token()))
    return spark.createDataFrame(rows, "at_s long, token string")


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN 'nation-' || n_nationkey ELSE 'region-' || n_regionkey END AS secret FROM nation")
def scoped_secrets(spark, sf_dir):
    """The secret of the longest path that holds a file's place: some nations have their own, others their region's."""
    store, nations = ScopedSecrets(), _table(spark, sf_dir, "nation").collect()  # 25 rows
    for r in nations:
        store.put("acct.dfs.example", "lake", f"/r{r.n_regionkey}", f"region-{r.n_regionkey}")
        if r.n_nationkey % 2 == 0:
            store.put("acct.dfs.example", "lake", f"/r{r.n_regionkey}/n{r.n_nationkey}", f"nation-{r.n_nationkey}")
    return spark.createDataFrame([(r.n_nationkey, store.get("acct", "lake", f"/r{r.n_regionkey}/n{r.n_nationkey}/part-0")) for r in nations], "n_nationkey int, secret string")


@query("SELECT * FROM (VALUES ('auth', true, false, 'RuntimeError: no write; caused by: ValueError: HTTP 401 for abfss://<redacted>'), ('exists', false, true, 'RuntimeError: no write; caused by: ValueError: Table already exists, sig=<redacted>'), ('other', false, false, 'RuntimeError: no write; caused by: ValueError: disk full')) t(kind, is_auth, is_benign, said)")
def error_causes(spark, sf_dir):
    """What an error's chain of causes says, masked, and what follows from it."""
    rows = []
    for kind, text in (("auth", "HTTP 401 for abfss://c@a/t?sig=x"), ("exists", "Table already exists, sig=abc"), ("other", "disk full")):
        try:
            try:
                raise ValueError(text)
            except ValueError as cause:
                raise RuntimeError("no write") from cause
        except RuntimeError as error:
            rows.append((kind, is_auth_failure(error), is_already_exists(error), redact_error(error)))
    return spark.createDataFrame(rows, "kind string, is_auth boolean, is_benign boolean, said string")


@query("SELECT 5 * 100000.0 / 15 AS rows_per_s, CAST(5 AS DOUBLE) AS commits, 3.0 AS p50_s, 5.0 AS p99_s, 1.0 AS min_s, 5.0 AS max_s")
def commit_summary(spark, sf_dir):
    s = measure.summary(500_000, [5.0, 1.0, 3.0, 2.0, 4.0], 15.0)
    return spark.createDataFrame([tuple(map(float, s.values()))], ", ".join(f"{k} double" for k in s))


@query("SELECT 'refused' AS batch, CAST(0 AS BIGINT) AS n UNION ALL SELECT 'taken', count(*) FROM events")
def back_pressure(spark, sf_dir):
    """A batch over the cap is refused as a whole; at the cap it is taken."""
    records = _records(_placed(_events(spark, sf_dir)), ["event_id"])
    n, out = records.count(), []
    for name, cap in (("refused", n - 1), ("taken", n)):
        ingest = _ingest(spark, name, max_buffered=cap)
        try:
            ingest.batch(records)
        except BackPressure:
            pass
        out.append((name, ingest.table("bronze.app.events").read().count() if ingest.table("bronze.app.events").exists() else 0))
    return spark.createDataFrame(out, "batch string, n long")


@query("SELECT k AS minutes, CASE WHEN k < 40 THEN 1 WHEN k < 80 THEN 2 ELSE 3 END AS lookups FROM (SELECT CAST(unnest([0, 39, 40, 79, 80]) AS BIGINT) AS k)")
def stale_tables(spark, sf_dir):
    """How often a table was looked up in the catalog by then: it is again after 40 minutes."""
    now, seen = [0.0], []

    class Watched(Catalog):
        def resolve(self, name, schema=None):
            seen.append(name)
            return super().resolve(name, schema)

    root = work_dir(spark, "stale")
    ingest, rows = Ingest(spark, IngestConfig(root=root), clock=lambda: now[0], catalog=Watched(root)), []
    for k in (0, 39, 40, 79, 80):
        now[0] = k * 60.0
        ingest.table("a.b.c")
        rows.append((k, len(seen)))
    return spark.createDataFrame(rows, "minutes long, lookups int")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as change records into a table, and each user's latest."""
    ingest = _ingest(spark, "flagship")
    ingest.batch(_records(_placed(_events(spark, sf_dir)), [*COLUMNS, "op"]))
    return cdc.latest_per_key(ingest.table("bronze.app.events").read(), ["user_id"], ["event_id"])
