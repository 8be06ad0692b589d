"""Repair of a conversation's structure: the cheapest edits that make its turns alternate.

A turn's role is known by its first letter. A conversation is whole if it has no turns, or a system turn or none, and then pairs of a
user's and an assistant's turn. Edits: keep a turn (K, cost 0), give it the role user or assistant (R, 2), delete it (D, 3; blank and repeated
turns must be), insert an empty turn of user or assistant (I, 2). A truncated turn that isn't deleted costs 1 more. Of the cheapest edits those
are taken whose initials in order are least.

Window functions flag each turn's first fault: blank (nothing but white space), duplicate (role and text were there before), truncated (the last
character other than white space is none of `.!?`). Sorted turns are folded by aggregate(), which carries four structs (cost, audit), for a
conversation that so far holds nothing, a system turn only, ends in a user's or ends in an assistant's turn, through least(). Costs and initials can be
compared as they grow: equal costs of the same turns have never one audit that begins another, so what follows changes no order.

Turns are folded in blocks of `BLOCK`, each from all four states at once, and the blocks' results are folded again, so that a long conversation
costs time in proportion to its blocks. Its turns meet in one row in the end, as its repaired text is one string.

Null role or text is one space. Turns of equal number are ordered by role and text, null numbers first; repeated rows are duplicates. A null conv_id is a conversation.
Gaps that don't fit a long are null. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltflow.llm._common import table

SPACE = " \t\n\x0b\x0c\r"
STATES = ("z", "s", "u", "a")
DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1
BLOCK = 64
_STATE = "struct<cost:bigint,audit:string>"
_ALL = f"struct<{','.join(f'{x}:{_STATE}' for x in STATES)}>"


def _let(x: Column, f: Callable[[Column], Column]) -> Column:
    """f(x), with x worked out once."""
    return F.transform(F.array(x), f)[0]


def _more(state: Column, cost, letter: str) -> Column:
    return F.when(state.isNotNull(), F.struct((state["cost"] + cost).alias("cost"), F.concat(state["audit"], F.lit(letter)).alias("audit")))


def _states(*columns: Column) -> Column:
    return F.struct(*(c.cast(_STATE).alias(x) for x, c in zip(STATES, columns, strict=True)))


def _inserted(t: Column) -> Column:
    """The states with turns inserted: a user's where one may follow, then an assistant's."""
    with_user = F.least(t["u"], _more(t["z"], INSERT, "I"), _more(t["s"], INSERT, "I"), _more(t["a"], INSERT, "I"))
    return _let(_states(t["z"], t["s"], with_user, t["a"]), lambda x: _states(x["z"], x["s"], x["u"], F.least(x["a"], _more(x["u"], INSERT, "I"))))


def _step(states: Column, turn: Column) -> Column:
    """The states after one more turn."""

    def after(t: Column) -> Column:
        free = F.least(t["z"], t["s"], t["a"])  # where a user's turn may follow
        may = lambda x, ok=None: F.when(~turn["must"] if ok is None else ~turn["must"] & ok, x)
        keep = lambda x, kind: may(_more(x, turn["extra"], "K"), turn["kind"] == kind)
        rerole = lambda x: may(_more(x, turn["extra"] + REROLE, "R"))
        gone = lambda x: _more(t[x], DELETE, "D")
        return _states(gone("z"), F.least(gone("s"), keep(t["z"], "s")), F.least(gone("u"), keep(free, "u"), rerole(free)), F.least(gone("a"), keep(t["u"], "a"), rerole(t["u"])))

    return _let(_inserted(states), after)


def _start(x: str) -> Column:
    zero = F.struct(F.lit(0).cast("long").alias("cost"), F.lit("").alias("audit"))
    return _states(*(zero if s == x else F.lit(None) for s in STATES))


def _then(states: Column, block: Column) -> Column:
    """The states after a block, from what it makes of each state."""
    joined = lambda x, y: F.when(x.isNotNull() & y.isNotNull(), F.struct((x["cost"] + y["cost"]).alias("cost"), F.concat(x["audit"], y["audit"]).alias("audit")))
    return _states(*(F.least(*(joined(states[q], F.get(block, F.lit(k))[x]) for k, q in enumerate(STATES))) for x in STATES))


def flagged(turns: DataFrame) -> DataFrame:
    """turns (conv_id, turn, role, text, present: false for rows that only name their conversation) with place, fault, the flag illegal (after the turn before) and new_turn (another number than before)."""
    own = W.partitionBy("conv_id", "present")
    order = own.orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    initial = F.substring("role", 1, 1)
    # one exchange serves all that follows, as every window and group holds the conversation
    rows = turns.repartition("conv_id").withColumns({"place": F.row_number().over(order), "before": F.lag(initial).over(order), "new_turn": F.coalesce(F.lag("turn").over(order) != F.col("turn"), F.col("turn").isNotNull())})
    again = F.row_number().over(W.partitionBy("conv_id", "present", "role", "text").orderBy("place")) > 1
    last = F.substring(F.rtrim("text", F.lit(SPACE)), -1, 1)
    fault = F.when(last == "", "blank").when(again, "duplicate").when(~last.isin(".", "!", "?"), "truncated")
    pair = F.concat("before", initial)
    return rows.withColumns({"fault": fault, "initial": initial, "illegal": F.col("before").isNotNull() & ~pair.isin("su", "ua", "au")}).drop("before")


def repair(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per conversation the faults' counts, gaps (numbers missing between its first and last turn), illegal pairs, cost, audit, and the repaired turns (role, text). turns as for flagged."""
    rows = flagged(turns)
    here = F.col("present")
    n = lambda c: F.count_if(here & F.coalesce(c, F.lit(False)))
    must = F.coalesce(F.col("fault").isin("blank", "duplicate"), F.lit(False))
    step = F.struct(F.col("initial").alias("kind"), must.alias("must"), F.when(F.col("fault") == "truncated", TRUNCATED).otherwise(0).alias("extra"))
    said = F.struct("place", step.alias("step"), "role", "text")
    blocks = rows.groupBy("conv_id", F.when(here, F.floor((F.col("place") - 1) / block)).otherwise(-1).alias("block")).agg(
        F.sort_array(F.collect_list(F.when(here, said))).alias("turns"),
        *(n(F.col("fault") == x).alias(x) for x in ("blank", "duplicate", "truncated")), n(F.col("illegal")).alias("illegal"), n(F.col("new_turn")).alias("numbers"),
        F.min(F.when(here, F.col("turn"))).alias("low"), F.max(F.when(here, F.col("turn"))).alias("high"),
    )
    starts = F.when(F.col("block") <= 0, F.array(_start("z"))).otherwise(F.array(*map(_start, STATES)))
    folded = F.transform(starts, lambda q: F.aggregate(F.col("turns.step"), q, _step))
    blocks = blocks.withColumn("folded", folded).withColumn("turns", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))))
    counts = ("blank", "duplicate", "truncated", "illegal", "numbers")
    whole = blocks.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("block", "folded", "turns"))).alias("b"), *(F.sum(c).alias(c) for c in counts), F.min("low").alias("low"), F.max("high").alias("high"))
    end = _inserted(F.aggregate(F.filter("b", lambda b: b["block"] >= 0), _start("z"), lambda acc, b: _then(acc, b["folded"])))
    whole = whole.withColumns({"end": end, "turns": F.flatten("b.turns")}).withColumn("best", F.least("end.z", "end.a"))
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    gaps = F.coalesce(F.lit(1).cast("decimal(20,0)") + wide("high") - wide("low") - wide("numbers"), F.lit(0))
    return whole.select(
        "conv_id", gaps.try_cast("long").alias("gaps"), "blank", "duplicate", "truncated", "illegal",
        F.col("best.cost").alias("cost"), F.col("best.audit").alias("audit"), _repaired(F.col("turns"), F.col("best.audit")).alias("turns"),
    )


def _repaired(turns: Column, audit: Column) -> Column:
    """The turns after their edits."""
    new = F.struct(F.lit(None).cast("string").alias("role"), F.lit("").alias("text"))
    edits = F.regexp_extract_all(audit, F.lit("I*[DKR]"), F.lit(0))

    def made(turn: Column, k: Column) -> Column:
        edit = F.get(edits, k)
        own = F.when(edit.endswith("K"), F.array(turn)).when(edit.endswith("R"), F.array(F.struct(F.lit(None).cast("string").alias("role"), turn["text"].alias("text")))).otherwise(F.expr("cast(array() as array<struct<role:string,text:string>>)"))
        return F.concat(F.array_repeat(new, F.length(edit) - 1), own)

    tail = F.array_repeat(new, F.length(F.regexp_extract(audit, "I*$", 0)))
    items = F.concat(F.flatten(F.transform(turns, made)), tail)

    def named(items: Column) -> Column:
        system = F.coalesce(F.get(items, F.lit(0))["role"].startswith("s"), F.lit(False)).cast("int")
        own = lambda k: F.when((k - system) % 2 == 0, "user").otherwise("assistant")
        return F.transform(items, lambda x, k: F.struct(F.coalesce(x["role"], own(k)).alias("role"), x["text"].alias("text")))

    return _let(items, named)


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with faults made in one of four, by the CRC-32 of conversation and turn."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), (F.crc32(F.concat_ws(":", blank("conv_id"), blank("turn")).cast("binary")) % 20).alias("h"))
    text = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.withColumns({"text": text, "role": F.when(F.col("h") == 4, "user").otherwise(F.col("role")), "present": F.col("h") != 0})
    return rows.withColumn("copy", F.explode(F.when(F.col("h") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).drop("copy", "h")


def op11_conversation_repair(spark, sf_dir: str) -> DataFrame:
    out = repair(damaged(table(spark, sf_dir, "conversations")))
    text = F.concat_ws("\n", F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])))
    return out.withColumn("repaired_sha256", F.sha2(text, 256)).drop("turns")


#: CRC-32 of a string k of ASCII characters, bit by bit.
_CRC = "xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], [ascii(k[i])::BIGINT for i in range(1, length(k) + 1)]), lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))))"


def _key(*parts: str) -> str:
    """The least of some texts, each a cost of 12 digits and an audit, or null."""
    return f"least({', '.join(parts)})"


def _add(state: str, cost: str, letter: str) -> str:
    return f"(lpad(CAST(CAST({state}[:12] AS BIGINT) + {cost} AS VARCHAR), 12, '0') || {state}[13:] || '{letter}')"


_WITH_USER = _key("u", _add("z", "2", "I"), _add("s", "2", "I"), _add("a", "2", "I"))
_KEPT = lambda x, kind: f"CASE WHEN NOT must AND kind = '{kind}' THEN {_add(x, 'extra', 'K')} END"
_REROLED = lambda x: f"CASE WHEN NOT must THEN {_add(x, '(2 + extra)', 'R')} END"
#: The query in SQL: a recursive step a turn over four columns of cost and audit.
OP11_SQL = rf"""
WITH RECURSIVE c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations
), h AS (SELECT *, {_CRC} % 20 AS h FROM c
), d AS (SELECT conv_id, turn, CASE h WHEN 4 THEN 'user' ELSE role END AS role, CASE h WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(CASE h WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM h WHERE h <> 0
), p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS trimmed FROM d
), q AS (SELECT *, role[:1] AS kind, lag(role[:1]) OVER (PARTITION BY conv_id ORDER BY place) || role[:1] AS pair, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 AS again FROM p
), f AS (SELECT *, CASE WHEN trimmed = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN trimmed[-1:] NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM q
), g AS (SELECT *, fault IN ('blank', 'duplicate') AS must, CASE fault WHEN 'truncated' THEN 1 ELSE 0 END AS extra FROM f
), o AS (SELECT DISTINCT conv_id FROM conversations
), n AS (SELECT o.conv_id, count(place) AS n, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps FROM o LEFT JOIN g ON o.conv_id IS NOT DISTINCT FROM g.conv_id GROUP BY o.conv_id
), w AS (SELECT conv_id, CAST(0 AS BIGINT) AS pos, n, '000000000000' AS z, NULL::VARCHAR AS s, NULL::VARCHAR AS u, NULL::VARCHAR AS a FROM n
  UNION ALL SELECT conv_id, pos, n, {_add('z', '3', 'D')}, {_key(_add('s', '3', 'D'), _KEPT('z', 's'))},
    {_key(_add('u', '3', 'D'), _KEPT('free', 'u'), _REROLED('free'))}, {_key(_add('a', '3', 'D'), _KEPT('u', 'a'), _REROLED('u'))}
  FROM (SELECT *, least(z, s, a) AS free FROM (SELECT * EXCLUDE (a), {_key('a', _add('u', '2', 'I'))} AS a FROM (SELECT w.conv_id, w.pos + 1 AS pos, w.n, z, s, {_WITH_USER} AS u, a, must, kind, extra FROM w JOIN g ON w.conv_id IS NOT DISTINCT FROM g.conv_id AND g.place = w.pos + 1)))
), e AS (SELECT conv_id, least(z, a, {_add(_WITH_USER, '2', 'I')}) AS best FROM w WHERE pos = n
), b AS (SELECT conv_id, CAST(best[:12] AS BIGINT) AS cost, best[13:] AS audit, regexp_extract_all(best[13:], 'I*[DKR]') AS edits FROM e
), i AS (SELECT b.conv_id, place AS x, unnest(list_concat([{{'role': NULL, 'text': '', 'y': 0}} for j in range(length(edits[place]) - 1)], CASE edits[place][-1:] WHEN 'K' THEN [{{'role': role, 'text': text, 'y': 1}}] WHEN 'R' THEN [{{'role': NULL, 'text': text, 'y': 1}}] ELSE [] END), max_depth := 2)
    FROM b JOIN g ON b.conv_id IS NOT DISTINCT FROM g.conv_id
  UNION ALL SELECT conv_id, 1000000000, unnest([{{'role': NULL, 'text': '', 'y': j}} for j in range(length(regexp_extract(audit, 'I*$')))], max_depth := 2) FROM b
), j AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY x, y) - 1 AS pos FROM i
), m AS (SELECT *, CASE WHEN first(role) OVER (PARTITION BY conv_id ORDER BY pos)[:1] = 's' THEN 1 ELSE 0 END AS system FROM j
), t AS (SELECT conv_id, string_agg(coalesce(role, CASE WHEN (pos - system) % 2 = 0 THEN 'user' ELSE 'assistant' END) || ':' || text, chr(10) ORDER BY pos) AS said FROM m GROUP BY conv_id)
SELECT n.conv_id, CAST(gaps AS BIGINT) AS gaps, blank, duplicate, truncated, illegal, cost, audit, sha256(coalesce(said, '')) AS repaired_sha256
FROM n JOIN b ON n.conv_id IS NOT DISTINCT FROM b.conv_id LEFT JOIN t ON n.conv_id IS NOT DISTINCT FROM t.conv_id
"""
