"""How filters interact: what each of them removes in every order, by a subset-zeta transform.

Each document gets a mask of the filters that it fails. The counts of the 2^n masks of a part, summed
over all subsets of a mask (the zeta transform, one step a filter), give the survivors of every
set of filters. What a step of an order removes is the difference between two such sets that
differ in one filter, so all n! orders come from one pass over the documents; likewise for the
good and the toxic ones, and for the sum over all orders (Shapley), a sum over sets by weights.

The last filter, repeats, needs no row a document: copies of a text have the same other fails, so
texts are counted by digest (SHA-256), part and label, and all but those of the least doc_id fail.
No count passes through one task but the 2^n of a part; texts with many copies are counted before they meet.

Null text is empty. A null lang is the part ''. Repeated rows count each; rows of the same doc_id
and text aren't copies of one another (no smaller doc_id). A null doc_id is neither smaller nor
greater than others: such rows never fail for repeats, and have no label. Several labels of a
doc_id count as one that has what any of them has. Empty documents give an empty result; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations, permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltflow.llm._common import table

SPACE = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
REPEATS = "E"
MEASURES = ("n", "good", "toxic")


def rules(text: Column) -> dict[str, Column]:
    """Whether a text fails each filter that looks at it alone."""
    words = F.array_remove(F.split(text, SPACE), "")
    return {
        "A": F.size(words) < 100,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 80,
        "C": (F.length(text) - F.length(F.translate(text, UPPER, ""))) * 100 > F.length(text) * 10,
        "D": text.rlike("[#$%&*|]"),
    }


def mask_counts(docs: DataFrame, labels: DataFrame, filters=rules) -> DataFrame:
    """Documents by part and mask (bit k: fails the k-th filter, the last one for repeats): n, and of these good and toxic."""
    text = F.coalesce("text", F.lit(""))
    own = filters(text)
    mask = sum((F.when(fails, 1 << k).otherwise(0) for k, fails in enumerate(own.values())), F.lit(0))
    rows = docs.select("doc_id", F.unhex(F.sha2(text, 256)).alias("digest"), F.coalesce("lang", F.lit("")).alias("part"), mask.alias("mask"))
    rows = rows.groupBy("doc_id", "digest", "part", "mask").agg(F.count("*").alias("n"))
    # rows without a doc_id join nothing, and are dealt out by their digests instead
    rows = rows.withColumn("spread", F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(0))
    known = labels.filter("doc_id is not null").groupBy("doc_id").agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    rows = rows.join(known.withColumn("spread", F.lit(0).cast("long")), ["doc_id", "spread"], "left")
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    groups = rows.groupBy("digest", "part", "mask", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")).agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("unnamed"), first.alias("first")
    )
    # a text has a group a part and label, so few rows meet here
    least = F.min("first.doc_id").over(W.partitionBy("digest"))
    kept = F.col("unnamed") + F.when(F.col("first.doc_id") == least, F.col("first.n")).otherwise(0)
    groups = groups.withColumn("kept", kept).withColumn("split", F.explode(F.array(F.struct(F.col("mask").alias("m"), F.col("kept").alias("c")), F.struct((F.col("mask") + (1 << len(own))).alias("m"), (F.col("n") - F.col("kept")).alias("c")))))
    count = F.col("split.c")
    return groups.groupBy("part", F.col("split.m").alias("mask")).agg(F.sum(count).alias("n"), F.sum(F.when(F.col("good"), count).otherwise(0)).alias("good"), F.sum(F.when(F.col("toxic"), count).otherwise(0)).alias("toxic"))


def _plus(bit: int):
    """A step of the zeta transform of the column sums: sets with the bit get what the set without it has."""
    return lambda v, i: F.when(i.bitwiseAND(F.lit(bit)) != 0, F.struct(*((v[m] + F.get("sums", i - bit)[m]).alias(m) for m in MEASURES))).otherwise(v)


def audit(counts: DataFrame, letters: str) -> DataFrame:
    """Each order of the filters (letters, by their bits) and each of its steps, for each part of mask_counts."""
    size, full = 1 << len(letters), (1 << len(letters)) - 1
    by_mask = F.map_from_entries(F.collect_list(F.struct("mask", F.struct(*MEASURES).alias("c"))))  # at most 2^n entries
    parts = counts.groupBy("part").agg(by_mask.alias("c"))
    none = F.struct(*(F.lit(0).cast("long").alias(m) for m in MEASURES))
    parts = parts.withColumn("exact", F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda m: F.coalesce(F.try_element_at("c", m), none))).withColumn("sums", F.col("exact"))
    for k in range(len(letters)):  # sums over all subsets, a filter at a time
        parts = parts.withColumn("sums", F.transform("sums", _plus(1 << k)))
    # survivors of a set: the documents whose mask lies outside it
    parts = parts.select("part", "exact", F.transform(F.sequence(F.lit(0), F.lit(full)), lambda s: F.get("sums", F.lit(full) - s)).alias("left"))
    left = lambda s: F.get("left", s if isinstance(s, Column) else F.lit(s))

    def shapley(k: int) -> Column:
        others = [1 << j for j in range(len(letters)) if j != k]
        sets = [(r, sum(c)) for r in range(len(others) + 1) for c in combinations(others, r)]
        return sum((F.lit(factorial(r) * factorial(len(others) - r)) * (left(s)["n"] - left(s | 1 << k)["n"]) for r, s in sets), F.lit(0))

    parts = parts.withColumn("shares", F.array(*(shapley(k).cast("long") for k in range(len(letters)))))
    orders = F.array(*(F.lit("".join(p)) for p in permutations(letters)))
    steps = parts.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))))
    k = F.instr(F.lit(letters), F.substr("filter_order", "step", F.lit(1))) - 1
    done = F.substr(F.col("filter_order"), F.lit(1), F.col("step") - 1)
    before = sum((F.when(done.contains(x), 1 << j).otherwise(0) for j, x in enumerate(letters)), F.lit(0))
    steps = steps.withColumns({"k": k, "bit": F.pow(F.lit(2), k).cast("int"), "before": before})
    steps = steps.withColumns({"b": left(F.col("before")), "a": left(F.col("before") + F.col("bit"))})
    lost = lambda m: (F.col("b")[m] - F.col("a")[m]).cast("long")
    return steps.select(
        "part", "filter_order", "step", F.col("a")["n"].alias("kept"), lost("n").alias("removed"), (left(0)["n"] - left(F.col("bit"))["n"] - lost("n")).alias("redundant"),
        F.get("exact", F.col("bit"))["n"].alias("unique_fails"), lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"), F.get("shares", F.col("k")).alias("shapley"),
    )


def op12_filter_audit(spark, sf_dir: str) -> DataFrame:
    return audit(mask_counts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")), "ABCD" + REPEATS)


#: The query in SQL: every order applied to every document, by its flags alone.
OP12_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part FROM documents
), w AS (SELECT *, list_filter(string_split_regex(text, '{SPACE}'), lambda x: x <> '') AS words, min(doc_id) OVER (PARTITION BY text) AS least FROM d
), l AS (SELECT doc_id, max(coalesce(quality = 1, false)) AS good, max(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id
), f AS (SELECT part, {{'A': len(words) < 100, 'B': 100 * len(list_distinct(words)) < 80 * len(words), 'C': 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text),
    'D': regexp_matches(text, '[#$%&*|]'), 'E': coalesce(w.doc_id > least, false)}} AS x, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic FROM w LEFT JOIN l ON w.doc_id = l.doc_id
), g AS (SELECT part, good, toxic, list_filter(['A', 'B', 'C', 'D', 'E'], lambda y: CASE y WHEN 'A' THEN x.A WHEN 'B' THEN x.B WHEN 'C' THEN x.C WHEN 'D' THEN x.D ELSE x.E END) AS fails, count(*) AS n FROM f GROUP BY ALL
), v AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS y
), o AS (SELECT a.y || b.y || c.y || d.y || e.y AS filter_order FROM v a, v b, v c, v d, v e WHERE len(list_distinct([a.y, b.y, c.y, d.y, e.y])) = 5
), s AS (SELECT filter_order, CAST(k AS INT) AS step, filter_order[k] AS y, filter_order[1 : k - 1] AS done FROM o, range(1, 6) r(k)
), z AS (SELECT *, list_contains(fails, y) AS hit, len(list_filter(fails, lambda q: contains(done, q))) > 0 AS gone FROM s, g
), r AS (SELECT part, filter_order, step, y, CAST(sum(n) FILTER (NOT gone AND NOT hit) AS BIGINT) AS kept, CAST(sum(n) FILTER (NOT gone AND hit) AS BIGINT) AS removed, CAST(sum(n) FILTER (gone AND hit) AS BIGINT) AS redundant,
    CAST(sum(n) FILTER (fails = [y]) AS BIGINT) AS unique_fails, CAST(sum(n) FILTER (NOT gone AND hit AND good) AS BIGINT) AS good_lost, CAST(sum(n) FILTER (NOT gone AND hit AND toxic) AS BIGINT) AS toxic_lost FROM z GROUP BY ALL)
SELECT part, filter_order, step, coalesce(kept, 0) AS kept, coalesce(removed, 0) AS removed, coalesce(redundant, 0) AS redundant, coalesce(unique_fails, 0) AS unique_fails, coalesce(good_lost, 0) AS good_lost,
  coalesce(toxic_lost, 0) AS toxic_lost, CAST(coalesce(sum(removed) OVER (PARTITION BY part, y), 0) AS BIGINT) AS shapley FROM r
"""
