"""Best-fit packing of token pieces into sequences of a fixed length.

Bulk-synchronous best fit. Lengths are whole numbers up to the capacity, so pieces of one length
are alike, and so are sequences with one gap that were made together: both are kept as rows
(size, how many), pre-aggregated where the pieces are, and packed in supersteps of Spark jobs. In
each, pieces and gaps are dealt to ranges by size, and a sweep of each range matches pieces with
their successor, the tightest gap they fit in; longer pieces rank first where several want one
gap. A second sweep matches what the ranges leave across their borders. The gaps shrink, and the
next superstep goes on with them. Where nothing matches any more, the longest pieces open new
sequences, as many as those left need at least. A gap loses at least half in each match, so
supersteps are few whatever the number of pieces, and the state has some thousand rows.

Its moves (rank ranges of a length to runs of sequences) are then applied to all pieces by a join
on length and rank. Ranks are dealt within buckets of each length, so a hot length doesn't meet in
one task.

Null or empty text is one piece with the end token alone. Repeated rows are packed as often as
they occur. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from array import array

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltflow.llm._common import arrow_map, cut, discard, ready, table
from siltflow.llm._units import UnitCache, unit_encoder

CAPACITY = 1024
END_ID = 2
RANGES = 16
#: Kinds of rows of the packing state: pieces of a length, sequences with a gap, and moves of pieces to sequences.
PIECE, GAP, MOVE = range(3)
BROADCAST_MOVES = 300_000


def pieces(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Each document's ids with end_id, cut into pieces of capacity tokens of which the first may be shorter."""

    def make():
        ids_of = unit_encoder(tokenizer)
        cache = UnitCache(lambda u: array("I", ids_of(u)).tobytes())
        end = array("I", [end_id]).tobytes()

        def step(ids, texts):
            out = {k: [] for k in ("id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else []))}
            for i, t in zip(ids, texts, strict=True):
                data = (b"".join(cache.values(t)) if t else b"") + end
                n = len(data) // 4
                start, upto, k = 0, n % capacity or capacity, 0
                while start < n:
                    part = data[4 * start : 4 * upto]
                    for name, v in zip(out, (i, k, start, upto - start, zlib.crc32(part), list(array("I", part)) if with_ids else None), strict=False):
                        out[name].append(v)
                    start, upto, k = upto, upto + capacity, k + 1
            return out

        return step

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return arrow_map(docs.select(id_col, text), make, schema).withColumnRenamed("id", id_col)


def _sweep(rows: list[tuple], capacity: int, opening: bool, step: int) -> list[tuple]:
    """Matches the pieces and gaps among rows (kind, size, first, n, ...) of one range of sizes.

    From the greatest size down, gaps go on a stack and pieces take from its top, which is the
    tightest gap they fit in; those that want the same gap are served by rank, longer ones first. A
    gap takes as many of one length as fit. opening: rows are all there are, so if this step has
    matched nothing, the longest pieces open new sequences.
    """
    out = [r for r in rows if r[0] == MOVE]
    pieces = sorted((r for r in rows if r[0] == PIECE), key=lambda r: (-r[1], r[2]))
    gaps = sorted((r for r in rows if r[0] == GAP), key=lambda r: (-r[1], r[2]))
    matched = any(r[6] == step for r in out)
    stack: list[list[int]] = []
    k, left = 0, []

    def put(length: int, rank: int, n: int, first: int, many: int, gap: int) -> int:
        """Fills sequences first ... with n pieces at most; how many sequences took some."""
        each = gap // length
        full = min(many, n // each)
        rest = min(n - full * each, each) if full < many else 0
        for at, runs, fill, low in ((first, full, each, rank), (first + full, bool(rest), rest, rank + full * each)):
            if runs and fill:
                out.append((MOVE, length, low, runs * fill, at, fill, step, capacity - gap))
                if gap - fill * length:
                    out.append((GAP, gap - fill * length, at, int(runs), 0, 0, 0, 0))
        return full + bool(rest)

    for _, length, rank, n, *_ in pieces:
        while k < len(gaps) and gaps[k][1] >= length:
            stack.append([gaps[k][1], gaps[k][2], gaps[k][3]])
            k += 1
        while n and stack:
            gap, first, many = stack[-1]
            used = put(length, rank, n, first, many, gap)
            took = min(n, used * (gap // length))
            rank, n, matched = rank + took, n - took, True
            if used == many:
                stack.pop()
            else:
                stack[-1][1:] = first + used, many - used
        if n:
            left.append((length, rank, n))
    out += [(GAP, g, first, many, 0, 0, 0, 0) for g, first, many in stack] + gaps[k:]
    fresh = _needed(left, capacity) if opening and not matched else 0
    opened = max((r[4] + -(-r[3] // r[5]) for r in out if r[0] == MOVE), default=0)
    for length, rank, n in left:
        take = min(n, fresh)
        if take:
            out.append((MOVE, length, rank, take, opened, 1, step, 0))
            if capacity > length:
                out.append((GAP, capacity - length, opened, take, 0, 0, 0, 0))
            rank, n, opened, fresh = rank + take, n - take, opened + take, fresh - take
        if n:
            out.append((PIECE, length, rank, n, 0, 0, 0, 0))
    return out


def _needed(left: list[tuple[int, int, int]], capacity: int) -> int:
    """A lower bound of the sequences that pieces (length, rank, n) need: by their sum, and by how many of a size fit in one."""
    least = -(-sum(length * n for length, _, n in left) // capacity)
    for k in range(1, 9):
        least = max(least, -(-sum(n for length, _, n in left if (k + 1) * length > capacity) // k))
    return least


_STATE = "kind int, size long, first long, n long, a long, b long, step long, base long"


def _superstep(state: DataFrame, capacity: int, step: int) -> DataFrame:
    """One exchange: sweeps within ranges of sizes, and then one over what they leave, which holds the ranges' borders."""

    def sweep(opening: bool):
        def run(table: pa.Table) -> pa.Table:
            table = table.drop_columns(["range"])
            swept = _sweep(list(zip(*(c.to_pylist() for c in table.columns), strict=True)), capacity, opening, step)
            return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(zip(*swept, strict=True), table.schema.types, strict=True)], schema=table.schema)

        return run

    width = max(1, capacity // RANGES)
    dealt = state.withColumn("range", F.when(F.col("kind") == MOVE, -1).otherwise(F.expr(f"size div {width}")))
    within = dealt.groupBy("range").applyInArrow(sweep(False), _STATE)
    return within.withColumn("range", F.lit(0)).groupBy("range").applyInArrow(sweep(True), _STATE)


def plan(classes: DataFrame, capacity: int, steps_a_job: int = 4, max_steps: int = 4000) -> DataFrame:
    """(length, low, n, first, each, base): the moves that pack classes (length, n) of equal pieces.

    A move: the pieces of that length with ranks low to low + n - 1 go to sequences first, first + 1
    ..., `each` to a sequence, from offset base on.
    """
    ready(classes.sparkSession)
    zero = F.lit(0).cast("long")
    state = classes.select(F.lit(PIECE).alias("kind"), F.col("length").alias("size"), zero.alias("first"), F.col("n"), *(zero.alias(c) for c in ("a", "b", "step", "base")))
    path = None
    for step in range(0, max_steps, steps_a_job):
        for k in range(steps_a_job):
            state = _superstep(state, capacity, step + k + 1)
        state, new = cut(state, "packing-state")
        if path:
            discard(classes.sparkSession, path)
        path = new
        if not state.filter(F.col("kind") == PIECE).limit(1).count():
            moves = state.filter(F.col("kind") == MOVE)
            return moves.select(F.col("size").alias("m_length"), F.col("first").alias("low"), (F.col("first") + F.col("n")).alias("high"), F.col("a").alias("to"), F.col("b").alias("each"), "base")
    raise RuntimeError(f"packing isn't done after {max_steps} steps")


def pack(cut_pieces: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id") -> DataFrame:
    """Adds sequence_id and offset to rows with id, piece, start, length and ids_crc32. Reads its input twice: give a stored table."""
    moves = plan(cut_pieces.groupBy("length").agg(F.count("*").alias("n")), capacity)
    total = cut_pieces.count()
    buckets = max(16, -(-total // 1_000_000))
    dealt = cut_pieces.withColumn("__bucket", F.pmod(F.xxhash64(id_col, "piece", "ids_crc32"), F.lit(buckets)))
    before = (
        dealt.groupBy("length", "__bucket").agg(F.count("*").alias("__n"))
        .withColumn("__before", F.sum("__n").over(W.partitionBy("length").orderBy("__bucket")) - F.col("__n")).drop("__n")
    )
    if capacity * buckets <= 100_000:
        before = F.broadcast(before)  # at most capacity x buckets rows
    local = F.row_number().over(W.partitionBy("length", "__bucket").orderBy(id_col, "piece", "ids_crc32", "start")) - 1
    ranked = dealt.withColumn("__local", local).join(before, ["length", "__bucket"]).withColumn("__rank", F.col("__local") + F.col("__before"))
    to = F.broadcast(moves) if moves.count() <= BROADCAST_MOVES else moves
    place = F.col("__rank") - F.col("low")
    return ranked.join(to, (F.col("length") == F.col("m_length")) & (F.col("__rank") >= F.col("low")) & (F.col("__rank") < F.col("high"))).select(
        *cut_pieces.columns,
        (F.col("to") + F.expr("(__rank - low) div each")).alias("sequence_id"),
        (F.col("base") + place % F.col("each") * F.col("length")).alias("offset"),
    )


def sequences(packed: DataFrame) -> DataFrame:
    """The token ids of each sequence, from packed rows that carry ids; a group has at most capacity tokens."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))


def pack_documents(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", capacity: int = CAPACITY, id_col: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    stored, _ = cut(pieces(docs, tokenizer, capacity, id_col=id_col, text=text, with_ids=with_ids), "pieces")
    return pack(stored, capacity, id_col)


def op5_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
