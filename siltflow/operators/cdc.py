"""From change records to current and historical state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltflow.sources.table import CommitConflict, Result, TxnTable

DELETED, BUCKET, BUCKETS = "__deleted", "__bucket", 16
#: Rows a bucket has on average, at most.
BUCKET_ROWS = 1_000_000
#: Buckets that one task writes, and the rows that it has at most by their average: a file is opened for each, however small.
TASK_BUCKETS, TASK_ROWS = 32, 1_000_000
#: Type 1: up to so many rows a bucket, deleted keys share the file of the others.
SMALL_ROWS = 10_000
#: Type 2: twice the bucket's number, and one more for all but a key's last version.
PART = "__part"
START, END, CLOSED, HASH = "__start_at", "__end_at", "__closed", "__hash"


def flatten_envelope(df: DataFrame, add: dict[str, str] | None = None, prefix: str = "__", rewrite_deletes: bool = True) -> DataFrame:
    """The after-image's columns with `<prefix>op` and others (add: name to source column).

    rewrite_deletes: deletes are rows of the before-image with `<prefix>deleted` = 'true', all
    others 'false'. Without it deletes are left out. Rows without any image (tombstones) go on as
    rows of nulls, for the caller to set aside.
    """
    is_delete = F.coalesce(F.col("op") == "d", F.lit(False))
    image = F.when(is_delete, F.col("before")).otherwise(F.col("after")) if rewrite_deletes else F.col("after")
    names = df.schema["after"].dataType.names
    extra = [F.col(c).alias(prefix + n) for n, c in {"op": "op", **(add or {})}.items()]
    out = df if rewrite_deletes else df.filter(~is_delete)
    deleted = [F.when(is_delete, "true").otherwise("false").alias(prefix + "deleted")] if rewrite_deletes else []
    return out.select(*(image[n].alias(n) for n in names), *extra, *deleted)


def latest_per_key(df: DataFrame, keys: list[str], sequence_by: list[str]) -> DataFrame:
    """Each key's row with the greatest sequence; further columns of sequence_by break ties."""
    order = [F.col(c).desc_nulls_last() for c in sequence_by]
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).filter("__rank = 1").drop("__rank")


def scd1(target: DataFrame, source: DataFrame, keys: list[str], sequence: str, op: str = "op", guard_deletes: bool = True, deleted: str | None = None) -> DataFrame:
    """target after the latest changes of source: matched deletes go, newer rows replace, unmatched others come in.

    A null op neither deletes nor inserts, and a null sequence never replaces. guard_deletes: a
    delete must be newer as well, which matters if source doesn't hold all changes.
    deleted: a boolean column of target that marks deleted rows. They are kept with their
    sequence, so an older change that comes again doesn't bring its key back.
    """
    cols = [c for c in target.columns if c != deleted]
    s, t = source.select(F.struct(*source.columns).alias("s"), *(F.col(k).alias(f"s_{k}") for k in keys)), target.select(F.struct(*target.columns).alias("t"), *(F.col(k).alias(f"t_{k}") for k in keys))
    on = [F.col(f"s_{k}") == F.col(f"t_{k}") for k in keys]
    both = t.join(s, on, "full_outer")
    matched, only_new = F.col("s").isNotNull() & F.col("t").isNotNull(), F.col("t").isNull()
    delete = F.coalesce(F.col(f"s.{op}") == "d", F.lit(False))
    newer = F.coalesce(F.col(f"s.{sequence}") > F.col(f"t.{sequence}"), F.lit(False))
    wanted = F.coalesce(F.col(f"s.{op}") != "d", F.lit(False))
    if deleted is None:
        gone = matched & delete & (newer if guard_deletes else F.lit(True))
        new = F.struct(*(F.col(f"s.{c}") for c in cols))
        row = F.when(gone, None).when(matched & newer & ~delete, new).when(only_new & wanted, new).when(~only_new, F.col("t"))
    else:
        new = F.struct(*(delete.alias(c) if c == deleted else F.col(f"s.{c}").alias(c) for c in target.columns))
        taken = matched & (newer if guard_deletes else newer | delete) | only_new & (wanted | delete)
        row = F.when(taken, new).when(~only_new, F.col("t"))
    return both.select(row.alias("r")).filter("r is not null").select("r.*")


def scd2(changes: DataFrame, keys: list[str], sequence_by: list[str], op: str | None = "op", valid: str = "ts") -> DataFrame:
    """Each version of each key with __start_at and __end_at (null: current) from valid; deletes only end the version before."""
    own = W.partitionBy(*keys).orderBy(*(F.col(c) for c in sequence_by))
    out = changes.withColumn("__start_at", F.col(valid)).withColumn("__end_at", F.lead(valid).over(own))
    return out.filter(F.coalesce(F.col(op) != "d", F.lit(True))) if op else out


def splice(old: DataFrame, new: DataFrame, keys: list[str], sequence_by: list[str], valid: str) -> DataFrame:
    """Whole histories of keys from stored versions and further changes, which split or shorten the intervals that they fall into.

    Both have a row a change, with DELETED; a key and its sequence are one change, of which the stored row, or else the
    least by its JSON text, stays. Adds __start_at, __end_at and CLOSED: whether a later change of the key follows.
    """
    row = [c for c in new.columns if c not in (START, END, CLOSED)]
    every = old.select(*row, F.lit(0).alias("__new"), F.lit("").alias("__text")).unionByName(new.select(*row, F.lit(1).alias("__new"), F.to_json(F.struct(*row)).alias("__text")))
    own = W.partitionBy(*keys).orderBy(*(F.col(c) for c in sequence_by), "__new", "__text")
    at = F.struct(*sequence_by)
    every = every.withColumn("__again", F.lag(at).over(own).eqNullSafe(at)).filter(~F.col("__again"))
    every = every.withColumns({START: F.col(valid), END: F.lead(valid).over(own), CLOSED: F.lead(F.lit(True)).over(own).isNotNull()})
    return every.drop("__new", "__text", "__again")


def current(target: TxnTable) -> DataFrame:
    """The live rows of a table that apply_changes keeps (type 1): those of deleted keys aren't read."""
    return target.read(where={DELETED: "false"}).drop(DELETED, BUCKET)


def history(target: TxnTable) -> DataFrame:
    """All versions of a table that apply_changes keeps (type 2), with __start_at and __end_at (null: current)."""
    return target.read().filter(~F.col(DELETED)).drop(DELETED, PART)


def address(key_hash: Column, n: int) -> Column:
    """The bucket of a key's hash among n, by linear hashing: with one bucket more, only `parent`'s keys move."""
    low = 1 << (n.bit_length() - 1)
    fine = F.pmod(key_hash, F.lit(2 * low))
    return F.when(fine < n, fine).otherwise(F.pmod(key_hash, F.lit(low)))


def parent(bucket: int, n: int) -> int:
    """Where the keys of a bucket are while there are only n."""
    low = 1 << (n.bit_length() - 1)
    return bucket % (2 * low) if bucket % (2 * low) < n else bucket % low


def apply_changes(bronze: DataFrame, target: TxnTable, keys: list[str], sequence_by: list[str], columns: list[str], apply_as_deletes: Column | None = None, stored_as_scd_type: int = 1, valid: str | None = None, txns: dict[str, int] | None = None, buckets: int = BUCKETS, bucket_rows: int = BUCKET_ROWS, read_version: int | None = None, tries: int = 5) -> Result | None:
    """Brings target up to date with bronze's changes, as current rows (type 1, see `current`) or history (type 2, see `history`).

    Both take any part of the changes, in any order, and changes that come again add nothing. Rows lie in buckets by
    key, and only buckets that changes meet are read and rewritten; deletes stay as marked rows with their sequence.
    Type 2 keeps each bucket's last version of a key apart from the versions before it, which are read and rewritten
    only in buckets where a change is older than its key's last one. None: there were no changes.

    A table begins with `buckets` of them and gets another for every bucket_rows rows more, at most (changes count as new
    keys): one bucket is split for each, in the same commit. How many there are is the greatest number in the log and one.

    Writers of other keys' buckets don't conflict. Where another has changed the same buckets since they were read (in
    read_version, the latest by default), the rewrite starts anew from the latest version, tries times at most.
    """
    op = F.when(F.coalesce(apply_as_deletes if apply_as_deletes is not None else F.col("op") == "d", F.lit(False)), "d").otherwise("u")
    changes, valid = bronze.withColumn("__op", op), valid or sequence_by[0]
    by_history = stored_as_scd_type == 2
    kept = list(dict.fromkeys([*columns, *keys, *sequence_by, valid] if by_history else [*columns, sequence_by[0]]))
    new = (changes if by_history else latest_per_key(changes, keys, sequence_by)).withColumn(HASH, F.hash(*keys)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for k in range(tries):
            at = target.snapshot().version if read_version is None or k else read_version
            try:
                return (_apply_history if by_history else _apply_latest)(new, target, at, keys, sequence_by, kept, valid, txns, buckets, bucket_rows)
            except CommitConflict:
                if k == tries - 1:
                    raise
    finally:
        new.unpersist()


def _buckets(new: DataFrame, target: TxnTable, at: int, column: str, parts: int, buckets: int, bucket_rows: int) -> tuple[int, int, set[int], set[int]] | None:
    """How many buckets there are and will be, which of them changes meet, and which are split; None without changes. parts: values of column a bucket."""
    rows = target.rows_by(column, at) if at >= 0 else {}
    now = max((int(v) // parts for v in rows), default=-1) + 1
    met = dict(new.groupBy(address(F.col(HASH), now or 1)).count().collect())  # a row a bucket
    if at >= 0 and not met:
        return None
    then = max(now or buckets, -(-(sum(rows.values()) + sum(met.values())) // bucket_rows))
    return (now, then, set(met), {parent(b, now) for b in range(now, then)}) if now else (0, then, set(), set())


def _apply_latest(new, target, at, keys, sequence_by, kept, valid, txns, buckets, bucket_rows) -> Result | None:
    found = _buckets(new, target, at, BUCKET, 1, buckets, bucket_rows)
    if found is None:
        return None
    now, then, met, split = found
    rows = new.select(*kept, (F.col("__op") == "d").alias(DELETED), address(F.col(HASH), then).alias(BUCKET))
    wanted = met | split
    if now:
        old = target.read(at, where={BUCKET: [str(x) for x in sorted(wanted)]})
        moved = old.withColumn(BUCKET, address(F.hash(*keys), then))
        rows = scd1(moved, new.withColumn(BUCKET, address(F.col(HASH), then)), keys, sequence_by[0], "__op", deleted=DELETED).select(*old.columns)
    rows, tasks = _spread(rows, BUCKET, len(wanted) + then - now, bucket_rows)
    by = [BUCKET] if bucket_rows <= SMALL_ROWS else [BUCKET, DELETED]
    return target.overwrite(rows, txns, partition_columns=by, where={BUCKET: {str(x) for x in wanted}}, read_version=at, touches=_touches(BUCKET, 1, now, wanted), tasks=tasks)


def _apply_history(new, target, at, keys, sequence_by, kept, valid, txns, buckets, bucket_rows) -> Result | None:
    found = _buckets(new, target, at, PART, 2, buckets, bucket_rows)
    if found is None:
        return None
    now, then, met, split = found
    rows = new.select(*kept, (F.col("__op") == "d").alias(DELETED))
    wanted, whole = met | split, split
    if now:
        last = target.read(at, where={PART: [str(2 * x) for x in sorted(wanted)]})
        first = new.groupBy(*keys, HASH).agg(F.min(F.struct(*sequence_by)).alias("__first"))
        ends = last.select(F.struct(*sequence_by).alias("__last"), *(F.col(c).alias(f"__t_{c}") for c in keys))
        on = [F.col(c).eqNullSafe(F.col(f"__t_{c}")) for c in keys]
        late = first.join(ends, on).filter("__first < __last").select(address(F.col(HASH), now)).distinct().collect()  # a number a bucket
        whole = split | {r[0] for r in late}
    values = {str(2 * x) for x in wanted} | {str(2 * x + 1) for x in whole}
    old = target.read(at, where={PART: sorted(values)}) if now else rows.limit(0)
    out = splice(old, rows, keys, sequence_by, valid).withColumn(PART, 2 * address(F.hash(*keys), then) + F.col(CLOSED).cast("int")).drop(CLOSED)
    out, tasks = _spread(out, PART, len(values) + 2 * (then - now), bucket_rows)
    return target.overwrite(out, txns, partition_columns=[PART], where={PART: values}, read_version=at, touches=_touches(PART, 2, now, wanted), tasks=tasks)


def _spread(rows: DataFrame, column: str, buckets: int, bucket_rows: int) -> tuple[DataFrame, int]:
    """Rows to be written by buckets, and by how many tasks (0: as they are). Large buckets are split over files and few small ones
    put into one task, by their bytes; many small ones are dealt to tasks by their number, as their files take the time and not their bytes."""
    small = buckets > TASK_BUCKETS and bucket_rows * TASK_BUCKETS <= TASK_ROWS
    return (rows, -(-buckets // TASK_BUCKETS)) if small else (rows.hint("rebalance", column), 0)


def _touches(column: str, parts: int, now: int, wanted: set[int]) -> Callable[[dict[str, str]], bool]:
    """Whether a file that another has added or removed lies in buckets that were read, or in ones that were split off them meanwhile."""
    return lambda values: not now or parent(int(values[column]) // parts, now) in wanted


def apply_new(bronze: TxnTable, target: TxnTable, keys: list[str], sequence_by: list[str], columns: list[str], name: str = "changes", **settings) -> Result | None:
    """apply_changes with what bronze has got since the last call; target's own stamp says how far that was."""
    stamp = f"cdc:{name}"
    done, now = (target.snapshot().txns.get(stamp, -1) if target.exists() else -1), bronze.snapshot().version
    if now <= done:
        return None
    return apply_changes(bronze.read_since(done, now), target, keys, sequence_by, columns, txns={stamp: now}, **settings)
