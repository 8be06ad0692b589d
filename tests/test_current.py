import time

from pyspark.sql import functions as F

from siltflow.operators import cdc
from siltflow.sources.table import TxnTable
from siltflow.streaming import current

CHANGE = "id int, name string, n long, op string, seq long"


def start(spark, tmp_path, t, *rows, **settings):
    if rows:
        spark.createDataFrame(list(rows), CHANGE).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(CHANGE).parquet(f"{tmp_path}/in")
    return current.start_current(stream, t, ["id"], ["seq"], ["id", "name", "n"], f"{tmp_path}/checkpoint", **settings)


def test_only_newer_changes_reach_the_table(spark, tmp_path):
    t = TxnTable(spark, f"{tmp_path}/t")
    run = lambda *rows: start(spark, tmp_path, t, *rows, available_now=True).awaitTermination()
    live = lambda: sorted(tuple(r) for r in cdc.current(t).select("id", "name", "n", "seq").collect())
    big = 2**53 + 1
    run((1, "a", big, "c", 10), (1, "b", None, "u", 12), (1, "late", 0, "u", 11), (2, "x", big, "c", 5), (3, None, None, "c", None))
    assert live() == [(1, "b", None, 12), (2, "x", big, 5), (3, None, None, None)]
    run((2, None, None, "d", 9), (1, "b", None, "u", 12))
    assert live() == [(1, "b", None, 12), (3, None, None, None)]
    met = {p for p in t.snapshot().files}
    run((1, "old", 1, "u", 3), (2, "back", 1, "c", 6))  # after a start from the checkpoint: nothing is newer, so nothing is rewritten
    assert {p for p in t.snapshot().files} == met and live() == [(1, "b", None, 12), (3, None, None, None)]
    run((2, "again", big, "c", 20), (3, "first", 7, "u", 0))
    assert live() == [(1, "b", None, 12), (2, "again", big, 20), (3, None, None, None)]  # the table's rule: a row without a sequence isn't replaced
    assert spark.conf.get(current.PROVIDER, "") != current.ROCKSDB


def test_state_of_deleted_keys_is_given_up(spark, tmp_path):
    spark.createDataFrame([(1, "a", 1, "c", 10), (1, None, None, "d", 20), (2, "b", 1, "c", 10)], CHANGE).coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(CHANGE).parquet(f"{tmp_path}/in")
    seen = []
    out = current.changes(stream, ["id"], ["seq"], ["id", "name"], keep_deletes_ms=1500)
    spark.conf.set(current.PROVIDER, current.ROCKSDB)
    try:
        q = out.writeStream.foreachBatch(lambda df, k: seen.extend(tuple(r) for r in df.collect())).outputMode("update").option("checkpointLocation", f"{tmp_path}/checkpoint").start()
    finally:
        spark.conf.unset(current.PROVIDER)
    rows = lambda: q.lastProgress["stateOperators"][0]["numRowsTotal"] if q.lastProgress and q.lastProgress["stateOperators"] else None
    try:
        until = time.monotonic() + 90
        while not (len(seen) >= 2 and rows() == 1) and time.monotonic() < until and q.isActive:
            time.sleep(0.3)
        assert sorted(seen, key=str) == [(1, None, 20, "d"), (2, "b", 10, "u")] and rows() == 1  # key 2's state alone
    finally:
        q.stop()
