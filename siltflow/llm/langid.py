"""Language identification by rank-order profiles.

A language's profile is the list of its most frequent character n-grams (1 to 3 letters, with
word ends), by falling count. A document's own list is compared with each profile by the
out-of-place distance: for each of its n-grams the difference of the two ranks, or the profile's
length where the profile lacks it. The smallest distance wins; equal ones go to the first
language by name.

Profiles are learned from at most `docs_per_lang` documents of each language (chosen by hash of
the id): a bounded sample of labelled rows. Predictions read whole texts.

Null text, or text without a letter, is `und` with score 0; so is everything if nothing could be
learned. Repeated rows give repeated rows; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltflow.llm._common import arrow_map, cut, discard, give_back, ready, table

PROFILE = 400
DOC_GRAMS = 400
DOCS_PER_LANG = 400
MAX_LANGS = 10_000
SLICE = 400_000
SLACK = 0.65
UND = "und"
_END = 0xFFFF


class Grams:
    """Counts n-grams of many texts at once, as 64-bit keys: 16 bits of text number, 3 x 16 of letters."""

    def __init__(self):
        self.letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)

    def _codes(self, text: str) -> np.ndarray:
        c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        return np.where(self.letter[c], np.maximum((c & 0xFFFF) ^ (c >> 16), 1), 0).astype(np.uint64)  # 0: no letter

    @staticmethod
    def _keys(c: np.ndarray, doc: np.ndarray, own: slice = slice(None)) -> np.ndarray:
        """c: letters, with zeros between words and around each text; doc: text numbers << 48. Those around the letters of own are counted."""
        at = np.flatnonzero(c)
        first, last, _ = own.indices(len(c))
        at = at[(at >= first) & (at < last)]
        mid, before, after = c[at], c[at - 1], c[np.minimum(at + 1, len(c) - 1)]
        d = doc[at]
        one = d | mid << np.uint64(32) | np.uint64(_END << 16 | _END)
        two = d | before << np.uint64(32) | mid << np.uint64(16) | np.uint64(_END)
        ends = np.flatnonzero(after == 0)
        final = d[ends] | mid[ends] << np.uint64(32) | np.uint64(_END)
        three = d | before << np.uint64(32) | mid << np.uint64(16) | after
        return np.concatenate([one, two, final, three])

    def counts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text number, n-gram and count, ordered by text and n-gram."""
        out, group, size = [], [], 0
        for i, t in enumerate(texts):
            if not t:
                continue
            if len(t) > SLICE:
                out.append(self._long(i, t))
                continue
            if size + len(t) > SLICE or len(group) >= 0xFFFF:
                out.append(self._group(group))
                group, size = [], 0
            group.append((i, t))
            size += len(t)
        if group:
            out.append(self._group(group))
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        doc, gram, n = (np.concatenate(x) for x in zip(*out, strict=True))
        order = np.argsort(doc, kind="stable")
        return doc[order], gram[order], n[order]

    def _group(self, group: list[tuple[int, str]]):
        c = self._codes(" " + " ".join(t for _, t in group) + " ")
        at = np.cumsum([0] + [len(t.lower()) + 1 for _, t in group])
        doc = np.zeros(len(c), np.uint64)
        doc[at[1:-1]] = 1
        doc = np.cumsum(doc, dtype=np.uint64) << np.uint64(48)
        keep = (c > 0) | np.concatenate([[True], c[:-1] > 0])
        keys, n = np.unique(self._keys(c[keep], doc[keep]), return_counts=True)
        ids = np.array([i for i, _ in group], dtype=np.int64)
        return ids[(keys >> np.uint64(48)).astype(np.int64)], keys & np.uint64(0xFFFFFFFFFFFF), n

    def _long(self, i: int, text: str):
        """One text, in slices, so that memory stays bounded by SLICE. They are cut at the last character that is no letter;
        a run of more letters is cut anywhere, and each slice sees its neighbours, so the n-grams are those of the whole."""
        text = text.lower()  # as a whole: a letter's lower case may go by its neighbours
        keys, n, at = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0
        while at < len(text):
            end = min(at + SLICE, len(text))
            if end < len(text):
                c = np.frombuffer(text[at:end].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
                free = np.flatnonzero(~self.letter[c])
                end = at + int(free[-1]) if len(free) and free[-1] > 0 else end
            before = self._codes(text[at - 1])[-1:] if at else np.zeros(1, np.uint64)
            after = self._codes(text[end])[:1] if end < len(text) else np.zeros(1, np.uint64)
            c = np.concatenate([before, self._codes(text[at:end]), after])
            k, m = np.unique(self._keys(c, np.zeros(len(c), np.uint64), slice(1, -1)), return_counts=True)
            keys, where = np.unique(np.concatenate([keys, k]), return_inverse=True)
            n = np.bincount(where, np.concatenate([n, m]), len(keys)).astype(np.int64)
            at = end
        return np.full(len(keys), i, np.int64), keys & np.uint64(0xFFFFFFFFFFFF), n

    def ranked(self, texts: list[str | None], most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text number, n-gram and its rank by falling count, up to rank most; equal counts by n-gram."""
        doc, gram, n = self.counts(texts)
        order = np.lexsort((-n, doc))
        doc, gram = doc[order], gram[order]
        start = np.searchsorted(doc, doc, "left")
        rank = np.arange(len(doc)) - start
        keep = rank < most
        return doc[keep], gram[keep], rank[keep]


def sample(docs: DataFrame, lang: str = "lang", id_col: str = "doc_id", text: str = "text", docs_per_lang: int = DOCS_PER_LANG) -> DataFrame:
    """(lang, text) of the docs_per_lang documents of each language whose ids have the smallest hashes."""
    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(id_col)).alias("h")).filter("lang is not null")
    # the docs_per_lang smallest hashes of each language: only hashes under a bound that some
    # times as many pass are ranked, so the rows that meet don't grow with the input
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"))
    known = counts.limit(MAX_LANGS + 1).collect()
    small = F.broadcast if len(known) <= MAX_LANGS else (lambda x: x)  # beyond it the joins shuffle
    if len(known) <= MAX_LANGS:
        counts = docs.sparkSession.createDataFrame(known, "lang string, n long")
    share = F.col("h") / F.lit(2.0**64) + 0.5
    low = rows.select("lang", "h").join(small(counts), "lang").filter(share * F.col("n") <= 4 * docs_per_lang + 64)
    ranked = low.withColumn("k", F.row_number().over(W.partitionBy("lang").orderBy("h"))).filter(F.col("k") <= docs_per_lang)
    bounds = ranked.groupBy(F.col("lang").alias("l")).agg(F.max("h").alias("most"))
    return rows.join(small(bounds), F.col("lang") == F.col("l")).filter("h <= most and text is not null").select("lang", "text")


def learn(docs: DataFrame, lang: str = "lang", id_col: str = "doc_id", text: str = "text", docs_per_lang: int = DOCS_PER_LANG, profile: int = PROFILE) -> dict[str, list[int]]:
    """Each language's n-grams by rank, from at most docs_per_lang of the given rows for each."""
    return _profiles(sample(docs, lang, id_col, text, docs_per_lang), profile)


def learn_with_limits(docs: DataFrame, lang: str = "lang", id_col: str = "doc_id", text: str = "text", docs_per_lang: int = DOCS_PER_LANG, profile: int = PROFILE) -> tuple[dict[str, list[int]], dict[str, float]]:
    """The profiles, and for each language the score under which a text isn't taken for it.

    The limit is SLACK times the score that all but a 100th of the language's own sample reach.
    """
    chosen, path = cut(sample(docs, lang, id_col, text, docs_per_lang), "sample")
    profiles = _profiles(chosen, profile)
    own = predict(chosen, profiles, ["lang"], profile=profile).filter("lang = lang_pred")
    limits = own.groupBy("lang").agg(F.percentile_approx("score", 0.01, 10_000).alias("low")).collect()  # a row a language
    discard(docs.sparkSession, path)
    return profiles, {r.lang: SLACK * r.low for r in limits}


def _profiles(chosen: DataFrame, profile: int) -> dict[str, list[int]]:

    def make():
        grams = Grams()

        def step(langs, texts):
            names = sorted(set(langs))
            number = {x: i for i, x in enumerate(names)}
            doc, gram, n = grams.counts(texts)
            k = np.array([number[x] for x in langs], dtype=np.int64)[doc]
            order = np.lexsort((gram, k))
            k, gram, n = k[order], gram[order], n[order]
            new = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (gram[1:] != gram[:-1])])) if len(k) else np.zeros(0, int)
            total = np.add.reduceat(n, new) if len(k) else n
            return {"lang": [names[i] for i in k[new]], "gram": gram[new].astype(np.int64), "n": total.astype(np.int64)}

        return step

    counted = arrow_map(chosen.select("lang", "text"), make, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    top = counted.withColumn("k", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "gram"))).filter(F.col("k") <= profile)
    out: dict[str, list[int]] = {}
    for r in top.orderBy("lang", "k").collect():  # profile rows a language
        out.setdefault(r.lang, []).append(r.gram)
    return out


class _Judge:
    """For a batch of texts: the numbers of their languages (-1: none) and their scores."""

    def __init__(self, profiles: dict[str, list[int]], profile: int, doc_grams: int):
        self.grams, self.names = Grams(), sorted(profiles)
        self.profile, self.doc_grams, self.own = profile, doc_grams, []
        for x in self.names:
            own = np.array(profiles[x], dtype=np.uint64)
            order = np.argsort(own)
            self.own.append((own[order], order))

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        doc, gram, rank = self.grams.ranked(texts, self.doc_grams)
        size = len(texts)
        m = np.bincount(doc, minlength=size)
        best, lang = np.full(size, np.inf), np.full(size, -1)
        for k, (own, place) in enumerate(self.own):
            at = np.minimum(np.searchsorted(own, gram), len(own) - 1)
            out_of = np.where(own[at] == gram, np.minimum(np.abs(place[at] - rank), self.profile), self.profile)
            d = np.bincount(doc, out_of, size)
            lang = np.where((d < best) & (m > 0), k, lang)
            best = np.minimum(best, d)
        score = np.where(lang >= 0, 1 - best / np.maximum(m * self.profile, 1), 0.0)
        return lang, np.clip(score, 0, 1)


def predict(docs: DataFrame, profiles: dict[str, list[int]], columns: list[str], text: str = "text", profile: int = PROFILE, doc_grams: int = DOC_GRAMS) -> DataFrame:
    """columns of docs with lang_pred and score (1: the n-grams rank as in the profile; 0: it has none of them)."""
    shared = docs.sparkSession.sparkContext.broadcast(profiles)
    kept = docs.select(*columns, F.col(text).alias("__text"))
    schema = kept.drop("__text").schema

    def make():
        judge = _Judge(shared.value, profile, doc_grams)

        def step(*cols):
            lang, score = judge(cols[-1])
            out = {f"c{i}": c for i, c in enumerate(cols[:-1])}
            return out | {"lang_pred": [judge.names[k] if k >= 0 else UND for k in lang], "score": score.tolist()}

        return step

    fields = [f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(schema)]
    out = arrow_map(kept, make, ", ".join([*fields, "lang_pred string", "score double"]))
    return out.toDF(*[f.name for f in schema], "lang_pred", "score")


def accepted(docs: DataFrame, profiles: dict[str, list[int]], limits: dict[str, float] | None = None, text: str = "text", profile: int = PROFILE, doc_grams: int = DOC_GRAMS) -> DataFrame:
    """The rows of docs, unchanged, whose text has a language: not `und`, and a score of at least that language's limit (0 if it has none)."""
    ready(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(profiles)
    at = docs.columns.index(text)

    def run(batches):
        try:
            yield from judged(batches)
        finally:
            give_back()

    def judged(batches):
        judge = _Judge(shared.value, profile, doc_grams)
        least = np.array([*((limits or {}).get(x, 0.0) for x in judge.names), 0.0])  # the last for none
        for batch in batches:
            step = max(1, batch.num_rows // max(1, batch.nbytes // 16_000_000 + 1))
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                lang, score = judge(part.column(at).to_pylist())
                yield part.filter(pa.array((lang >= 0) & (score >= least[lang])))

    return docs.mapInArrow(run, docs.schema)


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    third = F.crc32(F.col("doc_id").cast("string")) % 3
    profiles = learn(docs.filter(third != 1))
    held = docs.select("doc_id", "text", F.coalesce(third == 1, F.lit(False)).alias("held_out"))
    return predict(held, profiles, ["doc_id", "held_out"])
