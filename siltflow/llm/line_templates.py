r"""Line de-duplication by a log-template tree.

Each line is parsed down a tree of fixed depth: the number of its tokens, its two leading tokens,
then one third of its other tokens. So a line of five tokens or more has three leaves, and two
lines whose variable fields leave one of their thirds alone meet in a leaf. Tokens with a digit
are variable fields from the start. In each leaf lines are merged by position: a token that
stands at its place in at least `min_docs` documents of the leaf is constant, any other is a
variable field. A line's template is what is left constant; at least half of the line must be.
First, though, each line has the exact template of all its tokens; leaves merge the lines that
recurring exact templates leave.

A template recurs if it stands in at least `min_docs` documents (two are enough for an exact
template of `long_tokens` or more). Templates with few fixed tokens, under MIN_TOKENS of an exact
one or MIN_FIXED of a merged one, repeat by chance as well: they must stand in `short_times` times
`min_docs` documents, and in as many as the median recurring exact template does. Lines of
recurring templates are dropped wherever they are.

Every document counts, but copies of documents aren't evidence of a template: those in which less
than `own_share` of the tokens are in lines of their own (whose exact template and leaves no other
document has) count as one document together, whatever they hold. So the lines of documents that
exist only as exact or near copies stay, for the near-duplicate operator; a boilerplate line that
outweighs a page's own text goes.

Leaves and templates are keys, counted with pre-aggregated sums; only lines in leaves of at least
`min_docs` documents are looked at token by token, and no group of lines ever meets in one task.

A null text stays null; lines without tokens stay; a text all of whose lines go is empty.
Rows that repeat an id and text are one document. Line ends are `\n` alone. An empty table gives
an empty result; other columns are kept by `drop_lines`.
"""

from __future__ import annotations

import re

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltflow.llm._common import arrow_map, cut, discard, table

MIN_TOKENS = 4
MIN_FIXED = 6
MIN_LEAF = 5
LONG_LEAF = 10
LONG_TOKENS = 20
MIN_DOCS = 3
SHORT_TIMES = 10
OWN_SHARE = 0.2
BROADCAST_KEYS = 200_000
HOT_KEYS = 10_000
VARIABLE = "<*>"
_DIGIT = re.compile(r"\d")
_FIELD = re.compile(r"\S*\d\S*")
#: The kind of a key is kept in its three low bits.
EXACT_LONG, EXACT, SHORT, LEAF, SHORT_LEAF = range(5)


def _key(kind: int, *parts: str) -> int:
    h = xxhash.xxh64_intdigest("\x00".join(parts))
    return (h & ~7 | kind) - (1 << 63)


def parse_line(line: str) -> tuple[list[str], list[int]]:
    """The tokens of line with its digit fields made variable, and its keys: exact templates, then leaves."""
    raw = line.split()
    n = len(raw)
    if not n:
        return raw, []
    tokens, fixed = raw, n
    if _DIGIT.search(line):
        tokens = [VARIABLE if _FIELD.fullmatch(t) else t for t in raw]
        fixed = n - tokens.count(VARIABLE)
        if not fixed:
            tokens = raw
    if fixed >= MIN_TOKENS:
        keys = [_key(EXACT_LONG if n >= LONG_TOKENS else EXACT, " ".join(tokens))]
    else:
        keys = [_key(EXACT, " ".join(raw))] if n >= MIN_TOKENS and fixed else []
        keys.append(_key(SHORT, " ".join(tokens)))
    if n >= MIN_LEAF and fixed:
        kind, head, least = (LEAF, f"{n} {tokens[0]} {tokens[1]}", 4) if n >= LONG_LEAF else (SHORT_LEAF, f"{n} {tokens[0]} {tokens[1]}", 3)
        least -= (tokens[0] != VARIABLE) + (tokens[1] != VARIABLE)
        for third in range(3):
            part = tokens[2 + (n - 2) * third // 3 : 2 + (n - 2) * (third + 1) // 3]
            if len(part) - part.count(VARIABLE) >= least:
                keys.append(_key(kind, head, str(third), " ".join(part)))
    return tokens, keys


def line_keys(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, pos, n, keys, first, tokens): each line with keys; first: those that no earlier line of its document has.

    n is the line's tokens, or 0 for a short line of a document that has longer ones. tokens is
    null for lines without leaves.
    """

    def make():
        def step(ids, texts):
            out: dict[str, list] = {k: [] for k in ("doc", "pos", "n", "keys", "first", "tokens")}
            for i, t in zip(ids, texts, strict=True):
                seen: set[int] = set()
                begin, longer = len(out["n"]), False
                for pos, line in enumerate(t.split("\n") if t else ()):
                    tokens, keys = parse_line(line)
                    if keys:
                        longer = longer or len(tokens) >= MIN_TOKENS
                        out["doc"].append(i)
                        out["pos"].append(pos)
                        out["n"].append(len(tokens))
                        out["keys"].append(keys)
                        out["first"].append([k for k in keys if k not in seen])
                        out["tokens"].append(" ".join(tokens) if keys[-1] + (1 << 63) & 7 >= LEAF else None)
                        seen.update(keys)
                if longer:
                    out["n"][begin:] = [n if n >= MIN_TOKENS else 0 for n in out["n"][begin:]]
            return out

        return step

    rows = docs.select(F.xxhash64(id_col, text).alias("doc"), F.col(text).alias("text"))
    return arrow_map(rows, make, "doc long, pos int, n int, keys array<long>, first array<long>, tokens string")


def _with_keys(left: DataFrame, keys: DataFrame, most: int) -> DataFrame:
    """left's rows whose key is in keys (key, docs); keys of over `most` documents are broadcast, the others joined.

    Each document has few rows of a key, so with n rows in left there are at most about n / most
    broadcast keys, and no very common key meets in one task.
    """
    hot, cold = F.broadcast(keys.filter(F.col("docs") > most).select("key")), keys.filter(F.col("docs") <= most).select("key")
    return left.join(hot, "key", "left_semi").unionByName(left.join(hot, "key", "left_anti").join(cold, "key", "left_semi"))


def _few_or_joined(left: DataFrame, keys: DataFrame, most: int) -> DataFrame:
    if keys.count() <= BROADCAST_KEYS:
        return left.join(F.broadcast(keys.select("key")), "key", "left_semi")
    return _with_keys(left, keys, most)


def _counted(rows: DataFrame, copies: DataFrame) -> DataFrame:
    """(key, docs): the documents of each key of rows (doc, key), all copies together as one."""
    flagged = rows.select("doc", "key").distinct().join(copies, "doc", "left")
    return flagged.groupBy("key").agg((F.sum(F.when(F.col("copy").isNull(), 1).otherwise(0)) + F.coalesce(F.max("copy"), F.lit(0))).alias("docs"))


def recurring_lines(lines: DataFrame, min_docs: int = MIN_DOCS, own_share: float = OWN_SHARE, short_times: int = SHORT_TIMES) -> DataFrame:
    """(doc, dropped): the positions of the lines of recurring templates, from a stored table of line_keys."""
    spark = lines.sparkSession
    most = max(64, lines.count() // HOT_KEYS)
    kind = F.col("key").bitwiseAND(F.lit(7))
    scratch = []

    def stored(df: DataFrame, name: str) -> DataFrame:
        df, path = cut(df, name)
        scratch.append(path)
        return df

    # what stands in one document alone is out of the question from here on
    again = stored(lines.select(F.explode("first").alias("key")).groupBy("key").agg(F.count("*").alias("docs")).filter("docs > 1"), "again")
    met = stored(_with_keys(lines.select("doc", "pos", "n", F.explode("keys").alias("key")), again, most), "met")
    shared = met.filter(kind != SHORT_LEAF).select("doc", "pos", "n").distinct().groupBy("doc").agg(F.sum("n").alias("shared"))
    total = lines.select("doc", "n").groupBy("doc").agg(F.sum("n").alias("total"))
    copies = stored(shared.join(total, "doc").filter(F.col("total") - F.col("shared") < own_share * F.col("total")).select("doc", F.lit(1).alias("copy")), "copies")
    exact = stored(_counted(met.filter(kind <= SHORT), copies).filter(F.col("docs") >= min(2, min_docs)), "exact")
    usual = exact.filter((kind < SHORT) & (F.col("docs") >= min_docs)).agg(F.percentile_approx("docs", 0.5)).first()[0]
    many = max(short_times * min_docs, usual or 0)
    recurs = F.when(kind == EXACT_LONG, min(2, min_docs)).when(kind == EXACT, min_docs).when(kind == SHORT, many)
    gone = stored(_few_or_joined(met.filter(kind <= SHORT).select("doc", "pos", "key"), stored(exact.filter(F.col("docs") >= recurs), "templates"), most).select("doc", "pos").distinct(), "exact-gone")
    # leaves of the lines that are left, with several documents: constants by position, and the templates that they leave
    left = met.filter(kind > SHORT).join(gone, ["doc", "pos"], "left_anti")
    enough = F.when(F.max("n") > MIN_FIXED, min_docs).otherwise(many)  # of so few tokens a merged template has under MIN_FIXED
    leaves = _counted(left, copies).join(left.groupBy("key").agg(enough.alias("enough")), "key").filter(F.col("docs") >= F.col("enough"))
    leaves = stored(leaves.select("key", "docs"), "leaves")
    leafy = lines.filter("tokens is not null").select("doc", "pos", "n", "tokens", F.explode("keys").alias("key"))
    words = F.split("tokens", " ")
    leafy = _few_or_joined(leafy.filter(kind >= LEAF), leaves, most).join(gone, ["doc", "pos"], "left_anti")
    inside = leafy.select("doc", "pos", F.col("key").alias("leaf"), "n", F.posexplode(words).alias("at", "token")).filter(F.col("token") != VARIABLE)
    inside = stored(inside.select("doc", "pos", "leaf", "n", "at", F.xxhash64("token").alias("token"), F.xxhash64("leaf", "at", "token").alias("key")), "inside")
    constant = stored(_counted(inside, copies).filter(F.col("docs") >= min_docs), "constant")
    fixed = F.sort_array(F.collect_list(F.struct("at", "token")))
    merged = _few_or_joined(inside, constant, most).groupBy("doc", "pos", "leaf", "n").agg(fixed.alias("fixed"))
    merged = stored(merged.filter(2 * F.size("fixed") >= F.col("n")).select("doc", "pos", F.size("fixed").alias("f"), F.xxhash64("leaf", "fixed").alias("key")), "merged")
    wanted = F.when(F.col("f") >= MIN_FIXED, min_docs).otherwise(many)
    size = merged.groupBy("key").agg(F.first("f").alias("f"))
    templates = stored(_counted(merged, copies).join(size, "key").filter(F.col("docs") >= wanted).select("key", "docs"), "templates")
    gone = gone.unionByName(_few_or_joined(merged.select("doc", "pos", "key"), templates, most).select("doc", "pos"))
    out = stored(gone.groupBy("doc").agg(F.collect_set("pos").alias("dropped")), "gone")
    for path in scratch[:-1]:
        discard(spark, path)
    return out


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS, own_share: float = OWN_SHARE, report: bool = False) -> DataFrame:
    """docs without the lines of recurring templates; n_chars, if there is one, follows the text.

    report: adds __dropped, the positions of the lines that went (null if none).
    """
    lines, path = cut(line_keys(docs, id_col, text), "lines")
    gone = recurring_lines(lines, min_docs, own_share).select(F.col("doc").alias("__gone"), F.col("dropped").alias("__dropped"))
    discard(docs.sparkSession, path)
    joined = docs.withColumn("__doc", F.xxhash64(id_col, text)).join(gone.hint("shuffle_hash"), F.col("__doc") == F.col("__gone"), "left")

    def kept(parts):  # parts is bound once
        left = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("__dropped"))
        return F.array_join(F.transform(left, lambda i: F.element_at(parts, i + 1)), "\n")

    cleaned = F.transform(F.array(F.split(F.col(text), "\n", -1)), kept)[0]
    joined = joined.withColumn(text, F.when(F.col("__dropped").isNotNull(), cleaned).otherwise(F.col(text)))
    if "n_chars" in docs.columns:
        joined = joined.withColumn("n_chars", F.when(F.col("__dropped").isNotNull(), F.length(text).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return joined.select(*docs.columns, *(["__dropped"] if report else []))


def op4_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Per document: how many lines went, which, and the digest of the text that is left."""
    out = drop_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), report=True)
    gone = F.coalesce(F.sort_array("__dropped"), F.expr("cast(array() as array<int>)"))
    said = F.transform(F.array("text"), lambda t: F.struct(F.length(t).cast("long").alias("n"), F.sha2(F.coalesce(t, F.lit("")), 256).alias("h")))[0]  # the text is made once
    out = out.select("doc_id", F.size(gone).cast("long").alias("n_dropped"), F.array_join(gone.cast("array<string>"), ",").alias("dropped_lines"), said.alias("said"))
    return out.select("doc_id", "n_dropped", "dropped_lines", F.col("said.n").alias("n_chars_left"), F.col("said.h").alias("text_sha256"))


#: The query in SQL, with texts as keys, for tables whose ids are unique and whose white space is ASCII.
OP4_SQL = rf"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents
), r AS (
  SELECT *, list_filter(string_split_regex(line, '\s+'), lambda x: x <> '') AS raw FROM l
), f AS (
  SELECT *, len(raw) AS n, list_transform(raw, lambda x: CASE WHEN regexp_matches(x, '\d') THEN '{VARIABLE}' ELSE x END) AS fields FROM r WHERE len(raw) > 0
), t AS (
  SELECT doc_id, pos, raw, n, len(list_filter(fields, lambda x: x <> '{VARIABLE}')) AS fixed, CASE WHEN len(list_filter(fields, lambda x: x <> '{VARIABLE}')) = 0 THEN raw ELSE fields END AS tokens FROM f
), thirds AS (
  SELECT *, unnest([0, 1, 2]) AS third FROM t WHERE n >= {MIN_LEAF} AND fixed > 0
), parts AS (
  SELECT *, tokens[3 + (n - 2) * third // 3 : 2 + (n - 2) * (third + 1) // 3] AS part FROM thirds
), leaf_rows AS (
  SELECT doc_id, pos, n, tokens, CASE WHEN n >= {LONG_LEAF} THEN 'leaf' ELSE 'short leaf' END AS kind, concat_ws(chr(1), n, tokens[1], tokens[2], third, array_to_string(part, ' ')) AS key FROM parts
  WHERE len(list_filter(list_concat(tokens[1:2], part), lambda x: x <> '{VARIABLE}')) >= CASE WHEN n >= {LONG_LEAF} THEN 4 ELSE 3 END
), k AS (
  SELECT doc_id, pos, n, CASE WHEN n >= {LONG_TOKENS} THEN 'long' ELSE 'exact' END AS kind, array_to_string(tokens, ' ') AS key FROM t WHERE fixed >= {MIN_TOKENS}
  UNION ALL SELECT doc_id, pos, n, 'exact', array_to_string(raw, ' ') FROM t WHERE fixed < {MIN_TOKENS} AND fixed > 0 AND n >= {MIN_TOKENS}
  UNION ALL SELECT doc_id, pos, n, 'short', array_to_string(tokens, ' ') FROM t WHERE fixed < {MIN_TOKENS}
  UNION ALL SELECT doc_id, pos, n, kind, key FROM leaf_rows
), again AS (
  SELECT kind, key FROM k GROUP BY kind, key HAVING count(DISTINCT doc_id) > 1
), met AS (
  SELECT k.* FROM k SEMI JOIN again USING (kind, key)
), weights AS (
  SELECT doc_id, pos, CASE WHEN n < {MIN_TOKENS} AND max(n) OVER (PARTITION BY doc_id) >= {MIN_TOKENS} THEN 0 ELSE n END AS w FROM t
), copies AS (
  SELECT w.doc_id FROM weights w LEFT JOIN (SELECT DISTINCT doc_id, pos, 1 AS hit FROM met WHERE kind <> 'short leaf') m USING (doc_id, pos)
  GROUP BY w.doc_id HAVING count(hit) > 0 AND sum(w) - coalesce(sum(w) FILTER (hit = 1), 0) < {OWN_SHARE} * sum(w)
), counted AS (
  SELECT kind, key, count(DISTINCT m.doc_id) FILTER (c.doc_id IS NULL) + max(CASE WHEN c.doc_id IS NULL THEN 0 ELSE 1 END) AS docs FROM met m LEFT JOIN copies c USING (doc_id)
  WHERE kind IN ('long', 'exact', 'short') GROUP BY kind, key
), many AS (
  SELECT greatest({SHORT_TIMES * MIN_DOCS}, coalesce(quantile_disc(docs, 0.5), 0)) AS bar FROM counted WHERE kind IN ('long', 'exact') AND docs >= {MIN_DOCS}
), exact_gone AS (
  SELECT doc_id, pos FROM met JOIN counted USING (kind, key), many WHERE docs >= CASE kind WHEN 'long' THEN 2 WHEN 'exact' THEN {MIN_DOCS} WHEN 'short' THEN bar END
), left_rows AS (
  SELECT * FROM leaf_rows ANTI JOIN exact_gone USING (doc_id, pos)
), leaves AS (
  SELECT key FROM left_rows m LEFT JOIN copies c USING (doc_id), many GROUP BY key, bar
  HAVING count(DISTINCT m.doc_id) FILTER (c.doc_id IS NULL) + max(CASE WHEN c.doc_id IS NULL THEN 0 ELSE 1 END) >= CASE WHEN max(n) > {MIN_FIXED} THEN {MIN_DOCS} ELSE bar END
), inside AS (
  SELECT doc_id, pos, key, n, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS place FROM left_rows SEMI JOIN leaves USING (key)
), constant AS (
  SELECT key, place, token FROM inside LEFT JOIN copies c USING (doc_id) WHERE token <> '{VARIABLE}' GROUP BY key, place, token
  HAVING count(DISTINCT inside.doc_id) FILTER (c.doc_id IS NULL) + max(CASE WHEN c.doc_id IS NULL THEN 0 ELSE 1 END) >= {MIN_DOCS}
), merged AS (
  SELECT doc_id, pos, key, n, count(*) AS f, string_agg(place || chr(2) || token, chr(1) ORDER BY place) AS fixed FROM inside JOIN constant USING (key, place, token) GROUP BY doc_id, pos, key, n HAVING 2 * count(*) >= n
), templates AS (
  SELECT key, fixed FROM merged m LEFT JOIN copies c USING (doc_id), many GROUP BY key, fixed, f, bar
  HAVING count(DISTINCT m.doc_id) FILTER (c.doc_id IS NULL) + max(CASE WHEN c.doc_id IS NULL THEN 0 ELSE 1 END) >= CASE WHEN f >= {MIN_FIXED} THEN {MIN_DOCS} ELSE bar END
), gone AS (
  SELECT doc_id, pos FROM exact_gone UNION SELECT doc_id, pos FROM merged SEMI JOIN templates USING (key, fixed)
), left_ AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text FROM l ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
), dropped AS (
  SELECT doc_id, count(*) AS n_dropped, string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) AS dropped_lines FROM gone GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_dropped, 0) AS n_dropped, coalesce(dropped_lines, '') AS dropped_lines,
  CASE WHEN d.text IS NULL THEN NULL ELSE CAST(length(coalesce(x.text, '')) AS BIGINT) END AS n_chars_left, sha256(coalesce(x.text, '')) AS text_sha256
FROM documents d LEFT JOIN dropped USING (doc_id) LEFT JOIN left_ x USING (doc_id)
"""
