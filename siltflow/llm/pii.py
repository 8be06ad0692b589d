"""Personal data: fixed patterns, and an information-theoretic pass for what gives it away.

Base spans come from four patterns (see `base_spans`). The values found (say, one address) are
the protected entities. Corpus co-occurrence says how strongly a word reveals one: over the
distinct documents of the whole corpus, a word's disclosure of an entity is its pointwise mutual
information with it, divided by the entity's information content -log2 p(entity), which is what
the word would tell if it never came without the entity. Words at or over `remove_at` are
removed, words at or over `generalise_at` generalised, wherever they stand.

Words and entities meet in a document. One document alone doesn't say which of its words go with
an entity, so for an entity of one document only words near it in its line count (`near` on each
side); for the others all words of their documents do. A word must also meet the entity more
often than by chance: by Chernoff's bound on a Poisson count with the mean that the frequencies
of both give, at level `alpha` over the number of words that meet the entity. So one document is
enough for a rare word beside a rare entity, if the corpus is large. Copies count once.

Words travel as 64-bit keys. Which words and entities matter goes to the workers as a filter of
bounded size, and exact joins follow, so nothing but the terms themselves (up to
`BROADCAST_TERMS`, beyond which they are joined) is collected.

Null text counts as empty: no spans, no text. Repeated rows give repeated rows; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltflow.llm._common import arrow_map, cut, discard, scoped, table

KINDS = ("email", "ip", "card", "phone")
TERM_KINDS = ("term_removed", "term_generalised")
NEAR = 8
ALPHA = 0.05
REMOVE_AT = 0.95
GENERALISE_AT = 0.9
BROADCAST_TERMS = 300_000
BROADCAST_LETTERS = 10_000_000
#: Words are counted in one document of so many, by the hash of its text; the last round is exact.
ROUNDS = (64, 8, 1)

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A match can't start within a run of digits whose start is free, so only run starts are tried.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\W\d_]{3,}")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns' valid matches, by start and then kind.

    Each pattern's matches are leftmost and don't overlap; a match that fails its test is dropped.
    """
    out: list[tuple[int, int, str]] = []
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end(), "email"))
            done = m.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(at + 1, done))
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(x := p.lstrip("0")) <= 3 and int(x or 0) <= 255 for p in m[0].split(".")):
                out.append((m.start(), m.end(), "ip"))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12 and 12 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and _luhn(d):
                out.append((m.start(), m.end(), "card"))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_DIGIT.findall(m[0])) <= 15:
                    out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def _entity(kind: str, value: str) -> str:
    return f"{kind}:{value.lower()}" if kind in ("email", "ip") else kind + ":" + "".join(_DIGIT.findall(value))


def _word_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, lower case) of each word of text."""
    lower = text.lower()
    if len(lower) != len(text):  # rare letters whose lower case is longer: by word
        return [(m.start(), m.end(), m[0].lower()) for m in _WORD.finditer(text)]
    return [(m.start(), m.end(), m[0]) for m in _WORD.finditer(lower)]


def _words(text: str) -> set[str]:
    """The distinct words of text, split as in _word_spans."""
    lower = text.lower()
    return {w.lower() for w in _WORD.findall(text)} if len(lower) != len(text) else set(_WORD.findall(lower))


class _Keys(dict):
    """64-bit keys of words, with a bounded memory."""

    def __init__(self, limit: int = 200_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = _key(word)
        return value


def _key(value: str) -> int:
    """The hash that Spark's xxhash64 gives a string."""
    k = xxhash.xxh64_intdigest(value.encode("utf-8", "surrogatepass"), 42)
    return k - (1 << 64) if k >> 63 else k


def _bitmap(keys: DataFrame, column: str) -> np.ndarray:
    """A filter of at most 32 MB that holds every key: beyond its capacity it lets more others pass, never fewer."""
    n = keys.count()
    slots = 1 << min(28, max(16, (8 * n).bit_length()))
    slot = F.col(column).bitwiseAND(F.lit(slots - 1))
    words = keys.select(slot.alias("slot")).groupBy((F.shiftright("slot", 6)).alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 as int)))").alias("bits")).toArrow()
    out = np.zeros(slots // 64, np.int64)
    out[words["at"].to_numpy()] = words["bits"].to_numpy()
    return out.view(np.uint64)


def _passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    slot = keys.view(np.uint64) & np.uint64(64 * len(bits) - 1)
    return (bits[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)


def _merged(spans: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """The stretches that spans (ordered by start) cover, ordered and apart."""
    out: list[tuple[int, int]] = []
    for s, e, _ in spans:
        if out and s < out[-1][1]:
            out[-1] = out[-1][0], max(e, out[-1][1])
        else:
            out.append((s, e))
    return out


def _free_words(text: str, spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """The words of text outside the spans."""
    words, k = [], 0
    edges = _merged(spans)
    for w in _word_spans(text):
        while k < len(edges) and edges[k][1] <= w[0]:
            k += 1
        if k == len(edges) or edges[k][0] >= w[1]:
            words.append(w)
    return words


def near_words(text: str, spans: list[tuple[int, int, str]], near: int = NEAR) -> set[tuple[str, str]]:
    """(entity, word) for the words of the same line with fewer than near others between them and the entity."""
    found: set[tuple[str, str]] = set()
    lines: dict[int, list] = {}
    for s, e, kind in spans:
        start = text.rfind("\n", 0, s) + 1
        lines.setdefault(start, []).append((s - start, e - start, kind))
    for start, own in lines.items():
        end = text.find("\n", start)
        line = text[start : end if end >= 0 else len(text)]
        words = _free_words(line, own)
        starts, ends = [w[0] for w in words], [w[1] for w in words]
        for s, e, kind in own:
            entity = _entity(kind, line[s:e])
            before, after = bisect_right(ends, s), bisect_left(starts, e)
            found |= {(entity, w[2]) for w in words[max(0, before - near) : before] + words[after : after + near]}
    return found


def _entity_rows(docs: DataFrame, text: str, near: int | None, wanted: np.ndarray | None = None) -> DataFrame:
    """(entity, doc, words, first, names): for each entity of a document the keys of the words that meet it.

    With near: the words around the entities. Without: all words of the documents that hold
    entities of the filter wanted. One of a document's entities is its first. Words are spelled
    out in names, mostly once a task. Copies give equal rows, but for names.
    """
    shared = None if wanted is None else docs.sparkSession.sparkContext.broadcast(wanted)

    def make():
        keys, named = _Keys(), set()

        def step(texts):
            out: dict[str, list] = {"entity": [], "doc": [], "words": [], "first": [], "names": []}
            for t in texts:
                spans = base_spans(t) if t and ("@" in t or _DIGIT.search(t)) else []
                if not spans:
                    continue
                met: dict[int, set[str]] = {_key(x): set() for x in sorted({_entity(k, t[s:e]) for s, e, k in spans})}
                if near is not None:
                    for x, w in near_words(t, spans, near):
                        met[_key(x)].add(w)
                else:
                    own = np.fromiter(met, np.int64, len(met))
                    own = own[_passes(shared.value, own)].tolist()
                    words = {w[2] for w in _free_words(t, spans)} if own else set()
                    met = dict.fromkeys(own, words)
                if len(named) > keys.limit:
                    named.clear()
                doc = _key(t)
                for i, (x, words) in enumerate(met.items()):
                    out["entity"].append(x)
                    out["doc"].append(doc)
                    out["words"].append([keys[w] for w in words])
                    out["first"].append(i == 0)
                    out["names"].append([w for w in words if w not in named])
                    named.update(words)
            return out

        return step

    return arrow_map(docs.select(text), make, "entity long, doc long, words array<long>, first boolean, names array<string>")


def _once(rows: DataFrame) -> DataFrame:
    """One row of each entity and document."""
    return rows.groupBy("entity", "doc").agg(F.first("words").alias("words"), F.first("first").alias("first"))


def _held_words(docs: DataFrame, text: str, bits: np.ndarray) -> DataFrame:
    """(word_key, doc), distinct: the words of each document that pass the filter."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def make():
        keys = _Keys()

        def step(texts):
            out: dict[str, list] = {"word_key": [], "doc": []}
            for t in texts:
                if t and (own := _words(t)):
                    k = np.fromiter(map(keys.__getitem__, own), np.int64, len(own))
                    k = k[_passes(shared.value, k)]
                    out["word_key"].append(k)
                    out["doc"].append(np.full(len(k), _key(t)))
            return {k: np.concatenate(v) for k, v in out.items()} if out["doc"] else None

        return step

    return arrow_map(docs.select(text), make, "word_key long, doc long").distinct()


def _disclosure(total: float, both: str, docs: str, entity_docs: str) -> Column:
    """PMI of a word and an entity over the entity's information content; 0 if the entity has none."""
    n = F.greatest(F.lit(total), F.col(docs), F.col(entity_docs))
    content = F.log2(n / F.col(entity_docs))
    return F.when(content > 0, F.log2(F.col(both) * n / (F.col(docs) * F.col(entity_docs))) / content).otherwise(0.0)


def _significant(total: float, both: str, docs: str, entity_docs: str, tested: str, alpha: float) -> Column:
    """Whether the word stands with the entity more often than chance, by a bound that rises with docs."""
    mean = F.col(docs) * F.col(entity_docs) / F.lit(max(total, 1.0))
    k = F.col(both)
    return (mean < k) & (k * (1 + F.log(mean / k)) - mean <= F.log(F.lit(alpha) / F.col(tested)))


def disclosing_terms(docs: DataFrame, text: str = "text", near: int = NEAR, alpha: float = ALPHA, generalise_at: float = GENERALISE_AT) -> DataFrame:
    """(word, disclosure): the words that tell of some entity at least generalise_at of its information content.

    The documents in which a word meets any entity bound its documents in the corpus from below,
    and so its disclosure from above; so do its documents in any part of the corpus. Only pairs
    that can still reach generalise_at are counted further: in a 64th of the distinct documents,
    in an 8th, and then in all, which gives the exact count of the few words left by then.
    """
    close, close_at = cut(_entity_rows(docs, text, near), "close")
    held = close.select("entity", "doc").distinct().groupBy("entity")
    own = [F.bit_xor(F.xxhash64("doc", F.lit(k))).alias(f"sign{k}") for k in (1, 2)]
    of_entity, entities_at = cut(held.agg(F.count("*").alias("entity_docs"), *own), "entities")
    # entities that stand in the same documents have the same words and counts there, so one stands for all of them: a
    # directory page's words are paired once for all addresses that it shares with another page, not once for each
    again = of_entity.filter("entity_docs > 1").groupBy("entity_docs", "sign1", "sign2").agg(F.min("entity").alias("entity")).select("entity", "entity_docs")
    of_entity = of_entity.select("entity", "entity_docs")
    whole, whole_at = cut(_entity_rows(docs, text, None, _bitmap(again, "entity")), "whole")
    met = _once(close).join(of_entity.filter("entity_docs = 1"), "entity").withColumn("all", F.lit(False))
    met, met_at = cut(met.unionByName(_once(whole).join(again, "entity").withColumn("all", F.lit(True))), "met")
    one = met.select("entity", "entity_docs", "first", "all", F.explode("words").alias("word_key"))
    both = one.groupBy("entity", "word_key").agg(F.count("*").alias("both"), F.first("entity_docs").alias("entity_docs"))
    # the condition always holds; it lets the plan share one exchange with both
    tested = both.groupBy("entity").agg(F.count_if((F.col("both") > 0) & (F.col("entity_docs") > 0)).alias("tested"))
    # only a document's first entity counts its words, in either pass, so neither count is too high
    at_least = one.filter("first").groupBy("word_key").agg(F.greatest(F.count_if(F.col("all")), F.count_if(~F.col("all"))).alias("least_docs"))
    total = float(docs.filter(F.col(text) != "").select(F.xxhash64(text).alias("doc")).distinct().count())
    reaches = lambda n, of: _significant(total, "both", n, "entity_docs", of, alpha) & (_disclosure(total, "both", n, "entity_docs") >= generalise_at)
    likely = lambda n: reaches(n, "tested")
    joint = both.join(at_least, "word_key", "left").withColumn("least_docs", F.greatest("both", "least_docs"))
    joint = joint.withColumn("fewest", F.lit(1)).filter(reaches("least_docs", "fewest")).drop("fewest")
    joint, joint_at = cut(joint.join(tested, "entity").filter(likely("least_docs")), "joint")
    for share in ROUNDS:
        some = docs.filter(F.pmod(F.xxhash64(text), F.lit(share)) == 0)
        words = joint.select("word_key").distinct()
        counts = _held_words(some, text, _bitmap(words, "word_key")).join(words, "word_key", "left_semi").groupBy("word_key").agg(F.count("*").alias("docs"))
        more = joint.join(counts, "word_key", "left").withColumn("least_docs", F.greatest("least_docs", F.coalesce("docs", F.lit(0)))).drop("docs")
        last, (joint, joint_at) = joint_at, cut(more.filter(likely("least_docs")), "joint")
        discard(docs.sparkSession, last)
    told = joint.withColumn("disclosure", _disclosure(total, "both", "least_docs", "entity_docs"))
    told = told.groupBy("word_key").agg(F.max("disclosure").alias("disclosure"))
    names = close.select("names").unionByName(whole.select("names")).select(F.explode("names").alias("word"))
    named = names.withColumn("word_key", F.xxhash64("word")).join(told, "word_key")
    out, _ = cut(named.groupBy("word").agg(F.max("disclosure").alias("disclosure")), "terms")
    for path in (close_at, entities_at, whole_at, met_at, joint_at):
        discard(docs.sparkSession, path)
    return out


def all_spans(text: str | None, terms: dict[str, float], remove_at: float = REMOVE_AT) -> tuple[list, list]:
    """The base spans of text, and all spans: with the disclosing words outside them."""
    base = base_spans(text) if text else []
    if not terms or not text:
        return base, base
    more = []
    k = 0
    for s, e, w in _word_spans(text):
        d = terms.get(w)
        if d is None:
            continue
        while k < len(base) and base[k][1] <= s and (k + 1 == len(base) or base[k + 1][0] <= s):
            k += 1
        if not any(a < e and s < b for a, b, _ in base[max(0, k - 4) : k + 4]):
            more.append((s, e, TERM_KINDS[d < remove_at]))
    order = KINDS + TERM_KINDS
    return base, sorted(base + more, key=lambda x: (x[0], order.index(x[2])))


def sanitised(text: str | None, spans: list[tuple[int, int, str]]) -> str:
    """text with entities replaced by their kind, removed words gone and generalised ones by a general word."""
    if not text:
        return ""
    out, at = [], 0
    for s, e, kind in spans:
        if s >= at:
            out += [text[at:s], "" if kind == "term_removed" else "[term]" if kind == "term_generalised" else f"[{kind}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def find(docs: DataFrame, id_col: str = "doc_id", text: str = "text", near: int = NEAR, alpha: float = ALPHA, generalise_at: float = GENERALISE_AT, remove_at: float = REMOVE_AT, with_text: bool = True) -> DataFrame:
    """id, counts of the kinds, base_sha256, spans and (with_text) the sanitised text of each document."""
    with scoped() as made:
        terms = disclosing_terms(docs, text, near, alpha, generalise_at)
    few, letters = terms.agg(F.count("*"), F.coalesce(F.sum(F.length("word")), F.lit(0))).first()
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    if few <= BROADCAST_TERMS and letters <= BROADCAST_LETTERS:
        shared = docs.sparkSession.sparkContext.broadcast({r.word: r.disclosure for r in terms.collect()})
        for path in made:
            discard(docs.sparkSession, path)
        rows = rows.withColumn("own", F.lit(None).cast("map<string,double>"))
    else:  # each document gets the terms that it holds
        shared = None
        keyed = terms.withColumn("word_key", F.xxhash64("word"))
        held = _held_words(rows, "text", _bitmap(keyed, "word_key")).join(keyed, "word_key").groupBy("doc").agg(F.map_from_entries(F.collect_list(F.struct("word", "disclosure"))).alias("own"))
        rows = rows.withColumn("doc", F.xxhash64("text")).join(held, "doc", "left").select("id", "text", "own")

    def make():
        known = shared.value if shared else None
        names_of = frozenset(known or ())

        def step(ids, texts, own):
            out: dict[str, list] = {"id": ids, "base_sha256": [], "spans": [], "sanitised_text": [], **{f"n_{k}": [] for k in KINDS}}
            for t, mine in zip(texts, own, strict=True):
                if known is not None:
                    mine = {w: known[w] for w in names_of & _words(t)} if t else {}
                base, spans = all_spans(t, dict(mine or ()), remove_at)
                names = [",".join(f"{k}:{s}:{e}" for s, e, k in x) for x in (base, spans)]
                out["base_sha256"].append(hashlib.sha256(names[0].encode()).hexdigest())
                out["spans"].append(names[1])
                out["sanitised_text"].append(sanitised(t, spans) if with_text else None)
                for k in KINDS:
                    out[f"n_{k}"].append(sum(x[2] == k for x in base))
            return out

        return step

    found = arrow_map(rows, make, f"id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, sanitised_text string")
    return (found if with_text else found.drop("sanitised_text")).withColumnRenamed("id", id_col)


def op2_pii(spark, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"), with_text=False)
