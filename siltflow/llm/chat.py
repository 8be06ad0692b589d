"""Chat formatting in budgeted windows, with DataFrame functions only.

The template marks a turn as `<|start|>role\n` text `<|end|>\n`. Inside texts and roles the
characters that could make up a control string are replaced reversibly (`&` as `&amp;`, `<` as
`&lt;`, `[` as `&#91;`), so no text can open or close a turn.

Windows: the prefix sums of a conversation's turn tokens are divided into cells of half of what
the budget leaves beside the system turn and the repeated ones (but a quarter of the budget at
least). A window holds the turns that start in a cell; with each at most a cell long, they fit.
A turn that is longer than a cell closes the cell and is a window of its own; a window exceeds
the budget (`over_budget`) only if such a turn or the system turn does. Turns are never cut. Every window retains the conversation's system turn and repeats up to `history` turns from
before it, as far as `history_tokens` goes; both are masked out of the loss, as are all turns
but the assistant's new ones, so each assistant text is a target exactly once.

A conversation is sorted by turn and read once, with running sums and lags only, so a long
one spills and needs no memory in proportion. Tokens are counted by a rule (runs of up to four
letters, up to three digits, and other characters), not by a vocabulary.

Null text or role counts as empty. Equal turn numbers are ordered by role and text, and repeated
rows are turns of their own. A null conv_id is a conversation. An empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltflow.llm._common import table

START, END = "<|start|>", "<|end|>"
BUDGET = 2048
HISTORY = 2
HISTORY_TOKENS = 256
PIECE = r"\p{L}{1,4}|\p{N}{1,3}|[^\s\p{L}\p{N}]"


def escape(text: Column) -> Column:
    for plain, safe in (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;")):
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    for plain, safe in (("[", "&#91;"), ("<", "&lt;"), ("&", "&amp;")):
        text = F.replace(text, F.lit(safe), F.lit(plain))
    return text


def turn(role: Column, text: Column) -> Column:
    """One formatted turn."""
    return F.concat(F.lit(START), escape(role), F.lit("\n"), escape(text), F.lit(END + "\n"))


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, history_tokens: int = HISTORY_TOKENS) -> DataFrame:
    """One row a window: conv_id, window (in order), text, loss_spans ([start, end) code points of text), n_context (leading turns that are retained or repeated), n_new, n_tokens, over_budget."""
    turns = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = turns.withColumn("tokens", (F.regexp_count("text", F.lit(PIECE)) + 4).cast("long"))
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    so_far = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    first = F.first(F.struct("role", "text", "tokens")).over(so_far)
    turns = (
        turns.withColumn("start", F.sum("tokens").over(so_far) - F.col("tokens"))
        .withColumn("place", F.row_number().over(order))
        .withColumn("system", F.when(F.lower(first["role"]) == "system", first))
    )
    for k in range(1, history + 1):
        turns = turns.withColumn(f"past{k}", F.lag(F.struct("role", "text", "tokens", "place"), k).over(order))
    # half of what the budget leaves beside the system turn and the repeated ones
    room = F.lit(budget - history_tokens * bool(history)) - F.coalesce("system.tokens", F.lit(0))
    turns = turns.withColumn("cell_size", F.greatest(room, F.lit(budget // 4), F.lit(2)).cast("long")).withColumn("cell_size", F.expr("cell_size div 2"))
    turns = turns.withColumn("cell", F.expr("start div cell_size")).withColumn("alone", F.col("tokens") > F.col("cell_size"))
    # the first turn of each window is the one whose predecessor is in another
    before = F.lag(F.struct("cell", "alone")).over(order)
    opens = before.isNull() | (before["cell"] != F.col("cell")) | F.col("alone")
    turns = turns.withColumn("opens", opens).withColumn("window", F.sum(F.col("opens").cast("long")).over(so_far) - 1)

    # context of a window: the system turn, then the repeated turns, oldest first; taken from its first turn
    pasts = F.array(*(F.col(f"past{k}") for k in range(history, 0, -1))) if history else F.array().cast("array<struct<role:string,text:string,tokens:bigint,place:int>>")
    known = F.filter(pasts, lambda p: p.isNotNull() & ~(F.col("system").isNotNull() & (p["place"] == 1)))
    # of the latest turns as many as history_tokens allows
    fits = F.transform(known, lambda p, i: F.aggregate(F.slice(known, i + 1, F.size(known)), F.lit(0).cast("long"), lambda a, q: a + q["tokens"]) <= history_tokens)
    repeated = F.filter(known, lambda p, i: F.element_at(fits, i + 1))
    system = F.when(F.col("system").isNotNull() & (F.col("place") > 1), F.array(F.struct(F.col("system.role").alias("role"), F.col("system.text").alias("text"), F.col("system.tokens").alias("tokens")))).otherwise(F.expr("cast(array() as array<struct<role:string,text:string,tokens:bigint>>)"))
    repeated = F.transform(repeated, lambda p: F.struct(p["role"].alias("role"), p["text"].alias("text"), p["tokens"].alias("tokens")))
    turns = turns.withColumn("context", F.when(F.col("opens"), F.concat(system, repeated)))

    made = turns.select("conv_id", "window", "place", "tokens", "context", F.lower("role").alias("kind"), turn(F.col("role"), F.col("text")).alias("piece"), F.length(escape(F.col("role"))).alias("r"), F.length(escape(F.col("text"))).alias("t"))
    # a window has few turns (its tokens are bounded), so they meet in one row
    grouped = made.groupBy("conv_id", "window").agg(
        F.sort_array(F.collect_list(F.struct("place", "piece", "kind", "r", "t"))).alias("new"), F.sum("tokens").alias("new_tokens"), F.first("context", ignorenulls=True).alias("context")
    )
    head = F.concat_ws("", F.transform("context", lambda c: turn(c["role"], c["text"])))
    at = F.length("head")
    # start of each new turn's text within the window
    state = F.aggregate(
        "new",
        F.struct(at.cast("long").alias("at"), F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)").alias("spans")),
        lambda s, n: F.struct(
            (s["at"] + F.length(n["piece"])).cast("long").alias("at"),
            F.when(n["kind"] == "assistant", F.concat(s["spans"], F.array(F.struct((s["at"] + len(START) + n["r"] + 1).cast("long").alias("start"), (s["at"] + len(START) + n["r"] + 1 + n["t"]).cast("long").alias("end"))))).otherwise(s["spans"]).alias("spans"),
        ),
    )
    return (
        grouped.withColumn("head", head)
        .select(
            "conv_id", "window", F.concat(F.col("head"), F.concat_ws("", F.transform("new", lambda n: n["piece"]))).alias("text"), state["spans"].alias("loss_spans"),
            F.size("context").alias("n_context"), F.size("new").alias("n_new"),
            (F.col("new_tokens") + F.aggregate("context", F.lit(0).cast("long"), lambda a, c: a + c["tokens"])).alias("n_tokens"),
        )
        .withColumn("over_budget", F.col("n_tokens") > budget)
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """A conversation's turns, losses and length, parsed from its windows' texts alone (with their spans and n_context)."""
    parts = F.filter(F.split("text", START.replace("|", "\\|")), lambda p: p != "")
    own = F.slice(F.col("parts"), F.col("n_context") + 1, F.col("n_new"))
    end = F.lit(END + "\n")

    def said(p: Column) -> Column:
        role = F.substring_index(p, "\n", 1)
        text = F.substr(p, F.length(role) + 2, F.length(p) - F.length(role) - 1 - F.length(end))
        return F.concat(unescape(role), F.lit("\n"), unescape(text), F.lit("\n"))

    one = formatted.withColumn("parts", parts).select(
        "conv_id", "window", "n_new", F.length("text").alias("chars"),
        F.concat_ws("", F.transform(own, said)).alias("turns"),
        F.concat_ws("", F.transform("loss_spans", lambda s: unescape(F.substr(F.col("text"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))).alias("loss"),
    )
    # the digests of a conversation are of all its text, in window order
    whole = one.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("window", "turns", "loss"))).alias("w"), F.sum("n_new").alias("n_turns"), F.sum("chars").alias("formatted_chars"))
    turns, loss = F.concat_ws("", F.col("w.turns")), F.concat_ws("", F.col("w.loss"))
    return whole.select("conv_id", F.col("n_turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), F.col("formatted_chars").cast("long").alias("formatted_chars"))


PROBE = "</s>[INST] ok [/INST]"


def op3_chat_formatting(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.sql(f"select -7L as conv_id, t as turn, r as role, '{PROBE}' as text from values (0L, 'user'), (1L, 'assistant') v(t, r)")
    return read_back(windows(rows.unionByName(probe)))


#: The query in SQL: turns, tokens and cells as above, and each window's context from its first turn.
OP3_SQL = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '{PROBE}'), (-7, 1, 'assistant', '{PROBE}'))
), t AS (
  SELECT *, row_number() OVER w AS place, len(regexp_extract_all(text, '{PIECE}')) + 4 AS tokens,
    {len(START) + len(END) + 2} + length(replace(replace(replace(role || text, '&', '&amp;'), '<', '&lt;'), '[', '&#91;')) AS chars
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), s AS (
  SELECT *, sum(tokens) OVER w - tokens AS start, lower(first(role) OVER w) = 'system' AS has_system, first(tokens) OVER w AS tokens1, first(chars) OVER w AS chars1
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY place ROWS UNBOUNDED PRECEDING)
), z AS (
  SELECT *, greatest({BUDGET - HISTORY_TOKENS} - CASE WHEN has_system THEN tokens1 ELSE 0 END, {BUDGET // 4}) // 2 AS size FROM s
), o AS (
  SELECT *, place = 1 OR tokens > size OR lag(start // size) OVER w <> start // size OR lag(tokens > size) OVER w <> (tokens > size) AS opens,
    CASE WHEN has_system AND place > 1 THEN chars1 ELSE 0 END AS kept,
    CASE WHEN NOT (has_system AND place = 2) AND lag(tokens) OVER w <= {HISTORY_TOKENS} THEN lag(chars) OVER w ELSE 0 END AS past1,
    CASE WHEN NOT (has_system AND place = 3) AND lag(tokens) OVER w + lag(tokens, 2) OVER w <= {HISTORY_TOKENS} THEN lag(chars, 2) OVER w ELSE 0 END AS past2
  FROM z WINDOW w AS (PARTITION BY conv_id ORDER BY place)
), e AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY place) AS turns,
    coalesce(string_agg(text, '' ORDER BY place) FILTER (lower(role) = 'assistant'), '') AS loss,
    CAST(sum(chars) + sum(CASE WHEN opens THEN kept + past1 + past2 ELSE 0 END) AS BIGINT) AS formatted_chars
  FROM o GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM e
"""
