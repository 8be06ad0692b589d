"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints: the majority bit, at each of 64 places, of the XXH64 values of a text's 3-word
shingles. Equal fingerprints are merged first, so copies cost nothing further on.

Index: fingerprints are range-sorted by Gray rank, where neighbours share long bit patterns, and
cut into runs of neighbours. What all members of a run share is its masked pattern; what FAN
neighbouring runs share is factored out into a node above them, and so on up to the root. Every
run goes down this tree: differences accumulate from the bits that each level adds, and a node
beyond the limit is left with all below it. Two fingerprints within the limit differ in no more of
their runs' shared bits, so the runs that are reached hold all links. Only pairs of such runs meet,
by joins on the run; in a pair, short stretches are left out by their patterns again and the rest
is compared bit by bit. The tree has a bounded size (runs grow with the table), so it is broadcast;
members are never collected. A pair of runs emits a spanning forest of its links, and components
are joined across pairs by alternating stars.

Null text counts as empty; texts without words have fingerprint zero and are linked like any
other. A null id takes part but names no component. Repeated rows give repeated rows; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltflow.llm._common import arrow_map, cut, discard, ready, scoped, table
from siltflow.llm.components import components

SEED = 42
LIMIT = 2
LEAF = 128
FAN = 16
#: Runs get longer beyond this many, so that the tree over them stays within a few MB.
MAX_RUNS = 1 << 17
_CHUNK = 1 << 22
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _word_lists(data: bytes):
    """The words of data in lists; a list starts with the last two words of the one before."""
    at, tail = 0, []
    while at < len(data):
        end = len(data)
        if end - at > _CHUNK and (m := _SPACE.search(data, at + _CHUNK)):
            end = m.start()
        words = tail + data[at:end].split()
        yield words
        tail, at = words[-2:], end


def fingerprint(text: str | None, seed: int = SEED) -> int:
    """The 64-bit SimHash of text, unsigned."""
    data = (text or "").encode().lower()  # bytes: only A-Z change
    ones, n, few = np.zeros(64, np.int64), 0, []
    for words in _word_lists(data):
        if len(words) < 3:
            few = words
            continue
        h = np.fromiter(map(lambda s: xxhash.xxh64_intdigest(s, seed), map(b" ".join, zip(words, words[1:], words[2:]))), np.uint64, len(words) - 2)  # noqa: B905, C417
        n += len(h)
        for i in range(0, len(h), 65_536):
            ones += np.unpackbits(h[i : i + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    if not n:
        return xxhash.xxh64_intdigest(b" ".join(few), seed) if few else 0
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, doc_key (of id and text) and fp (the fingerprint's bits as a signed long)."""

    def make():
        def step(ids, keys, texts):
            return {"id": ids, "doc_key": keys, "fp": np.array([fingerprint(t) for t in texts], dtype=np.uint64).astype(np.int64)}

        return step

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    return arrow_map(docs.select(id_col, F.xxhash64(id_col, text), text), make, f"id {kind}, doc_key long, fp long")


def _gray_rank(fp: Column) -> Column:
    for k in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, k))
    return fp


def _patterns(mask: np.ndarray, bits: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each run of size nodes: the bits that all share, and their values."""
    starts = np.arange(0, len(bits), size)
    every, some = np.bitwise_and.reduceat(bits, starts), np.bitwise_or.reduceat(bits, starts)
    shared = np.bitwise_and.reduceat(mask, starts) & ~(every ^ some)
    return shared, every & shared


def runs(fps: DataFrame, leaf: int) -> DataFrame:
    """(run, mask, bits, members): distinct fingerprints range-sorted by Gray rank, in runs of up to leaf neighbours.

    mask has the bits that all members share and bits their values. Runs are numbered in Gray order.
    """
    ready(fps.sparkSession)
    rank = _gray_rank(F.col("fp")).bitwiseXOR(F.lit(-(1 << 63)))  # in the order of unsigned numbers
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = fps.select("fp", rank.alias("rank")).repartitionByRange(parts, "rank").sortWithinPartitions("rank").select("fp")
    schema = pa.schema([("run", pa.int64()), ("mask", pa.int64()), ("bits", pa.int64()), ("members", pa.list_(pa.int64()))])

    def cut_runs(batches):
        from pyspark import TaskContext

        first, rest = TaskContext.get().partitionId() << 32, np.zeros(0, np.uint64)
        for batch in batches:
            rest = np.concatenate([rest, batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)])
            if len(rest) >= 64 * leaf:
                own, rest = rest[: len(rest) // leaf * leaf], rest[len(rest) // leaf * leaf :]
                yield made(own, first)
                first += len(own) // leaf
        if len(rest):
            yield made(rest, first)

    def made(own: np.ndarray, first: int) -> pa.RecordBatch:
        mask, bits = _patterns(np.full(len(own), ~np.uint64(0)), own, leaf)
        at = np.append(np.arange(0, len(own), leaf), len(own)).astype(np.int32)
        members = pa.ListArray.from_arrays(pa.array(at), pa.array(own.view(np.int64)))
        return pa.RecordBatch.from_arrays([pa.array(first + np.arange(len(mask))), pa.array(mask.view(np.int64)), pa.array(bits.view(np.int64)), members], schema=schema)

    return ordered.mapInArrow(cut_runs, "run long, mask long, bits long, members array<long>")


class Tree:
    """The upper nodes over runs: level by level, what FAN neighbours share is factored out into their parent."""

    def __init__(self, run: np.ndarray, mask: np.ndarray, bits: np.ndarray, fan: int = FAN):
        order = np.argsort(run)
        self.run, self.fan = run[order], fan
        self.levels = [(mask[order], bits[order])]
        while len(self.levels[-1][0]) > fan:
            self.levels.append(_patterns(*self.levels[-1], fan))

    def near(self, mask: np.uint64, bits: np.uint64, limit: int) -> tuple[np.ndarray, int]:
        """The runs whose shared bits differ from the given ones in at most limit places, and how many nodes were looked at.

        Going down, a node's differences are those of its parent and of the bits that it shares beyond
        its parent's; a node over the limit is left with all below it.
        """
        top = len(self.levels) - 1
        at, over, known = np.arange(len(self.levels[top][0])), np.int64(0), np.uint64(0)
        seen = 0
        for level in range(top, -1, -1):
            own_mask, own_bits = self.levels[level]
            seen += len(at)
            fresh = own_mask[at] & mask & ~known
            over = over + np.bitwise_count((own_bits[at] ^ bits) & fresh).astype(np.int64)
            keep = over <= limit
            at, over = at[keep], over[keep]
            if level:
                known = np.repeat(own_mask[at], self.fan)
                over = np.repeat(over, self.fan)
                at = (at[:, None] * self.fan + np.arange(self.fan)).ravel()
                inside = at < len(self.levels[level - 1][0])
                at, over, known = at[inside], over[inside], known[inside]
        return self.run[at], seen


def run_pairs(groups: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(a, b), a <= b: the runs that may hold fingerprints within limit bits of each other, by descending the tree."""
    nodes = groups.select("run", "mask", "bits").toArrow()  # at most MAX_RUNS and one a partition
    shared = groups.sparkSession.sparkContext.broadcast(tuple(nodes[c].to_numpy().view(np.uint64 if c != "run" else np.int64) for c in ("run", "mask", "bits")))

    def make():
        tree = Tree(*shared.value)

        def step(run, mask, bits):
            out = {"a": [], "b": []}
            for r, m, v in zip(run, np.array(mask, np.int64).view(np.uint64), np.array(bits, np.int64).view(np.uint64), strict=True):
                found, _ = tree.near(m, v, limit)
                found = found[found >= r]
                out["a"].append(np.full(len(found), r))
                out["b"].append(found)
            return {k: np.concatenate(v) for k, v in out.items()} if run else None

        return step

    return arrow_map(groups.select("run", "mask", "bits"), make, "a long, b long")


def links_between(x: np.ndarray, y: np.ndarray, limit: int, size: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of members of two runs within limit bits; short stretches of both are left out by what they share."""
    x_mask, x_bits = _patterns(np.full(len(x), ~np.uint64(0)), x, size)
    y_mask, y_bits = _patterns(np.full(len(y), ~np.uint64(0)), y, size)
    far = np.bitwise_count((x_bits[:, None] ^ y_bits[None, :]) & x_mask[:, None] & y_mask[None, :]) > limit
    i, j = np.nonzero(~far)
    if not len(i):
        return i, j
    within = np.arange(size)
    p, q = np.minimum(i[:, None] * size + within, len(x) - 1), np.minimum(j[:, None] * size + within, len(y) - 1)
    n, k, m = np.nonzero(np.bitwise_count(x[p][:, :, None] ^ y[q][:, None, :]) <= limit)
    return p[n, k], q[n, m]


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least index that each of n members is linked to, directly or not."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def links(fps: DataFrame, limit: int = LIMIT, leaf: int = LEAF) -> DataFrame:
    """Edges (u, v) that connect all distinct fingerprints within limit bits of each other."""
    groups, _ = cut(runs(fps, max(leaf, -(-fps.count() // MAX_RUNS))), "runs")
    pairs, _ = cut(run_pairs(groups, limit), "run-pairs")
    members = lambda x: groups.select(F.col("run").alias(x), F.col("members").alias(f"of_{x}"))
    met = pairs.join(members("a"), "a").join(members("b"), "b")

    def make():
        def step(x, y):
            out = {"u": [np.zeros(0, np.int64)], "v": [np.zeros(0, np.int64)]}
            for own, other in zip(x, y, strict=True):
                own, other = np.array(own, np.int64).view(np.uint64), np.array(other, np.int64).view(np.uint64)
                i, j = links_between(own, other, limit)
                if len(i):  # a forest of the links says the same
                    both = np.concatenate([own, other]).view(np.int64)
                    label = _forest(len(both), i, j + len(own))
                    at = np.flatnonzero(both != both[label])
                    out["u"].append(both[at])
                    out["v"].append(both[label[at]])
            return {k: np.concatenate(v) for k, v in out.items()}

        return step

    return arrow_map(met.select("of_a", "of_b"), make, "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", limit: int = LIMIT, leaf: int = LEAF) -> DataFrame:
    """id, doc_key (of id and text), fp, root (its group's fingerprint) and component_id (the smallest id of the group) of each document."""
    of, _ = cut(fingerprints(docs, id_col, text), "fingerprints")
    fps, _ = cut(of.groupBy("fp").agg(F.min("id").alias("rep")), "classes")
    with scoped() as made:
        edges = links(fps.select("fp"), limit, leaf)
    found = components(edges)
    for path in made:
        discard(docs.sparkSession, path)
    rooted = fps.join(found, F.col("fp") == F.col("id"), "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = rooted.join(least, "root").select(F.col("fp").alias("__fp"), "root", "component_id")
    return of.join(named, F.col("fp") == F.col("__fp")).select(F.col("id").alias(id_col), "doc_key", "fp", "root", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", limit: int = LIMIT, leaf: int = LEAF) -> DataFrame:
    """docs with one document of each group: that of the smallest id (nulls last)."""
    groups = near_duplicates(docs, id_col, text, limit, leaf)
    first = groups.groupBy("root").agg(F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), "doc_key")).alias("f"))
    keep, _ = cut(first.select(F.col("f.doc_key").alias("__keep")), "kept")
    rows = docs.withColumn("__key", F.xxhash64(id_col, text)).join(keep, F.col("__key") == F.col("__keep"), "left_semi")
    once = F.row_number().over(W.partitionBy("__key").orderBy("__key"))  # of repeated rows one
    return rows.withColumn("__n", once).filter("__n = 1").select(*docs.columns)


def op7_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
