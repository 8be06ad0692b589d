"""Benchmark decontamination: BM25 over the test items with block-max WAND, then verification.

The test items are indexed in blocks: postings by term with each item's BM25 weight, every
term's greatest weight in each block of items, and every item's score against itself, of which
`recall_at` is its threshold. Every passage of every document (windows of words that overlap by
half, twice as long as the longest item, so that some window holds any item whole) is a query.
As in WAND, an item's commonest terms that can't lift it over the threshold alone are not
essential and their postings aren't read. A window's essential terms give an upper bound for
each block from the block maxima; blocks whose bound is under the least need of their items are
skipped, all windows of a batch at a time. In the other blocks postings are read and the items
that have what they need are scored in full. All above their threshold are retrieved; there is
no top-k.

Retrieved pairs are verified on the exact words: of an item's distinct five-word shingles at
least `overlap` must stand in the window. Question (all but the last sentence) and answer (the
last sentence) must both be there: at least half of the distinct words of each.

The index is read from the item table in slices of about `slice_items` items or SLICE_LETTERS
characters, each broadcast and run against all documents, so its size in memory is bounded whatever the
table's size. Frequencies and lengths are always those of the whole table.

Null or empty texts of documents have no passages. Items without five words are matched as a
whole run of words; items without words (null texts too) are never found. Repeated rows and
items give repeated matches. Empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltflow.llm._common import arrow_map, cut, table

SHINGLE = 5
OVERLAP = 0.8
RECALL_AT = 0.6
BLOCK = 8
SLICE_ITEMS = 20_000
SLICE_LETTERS = 50_000_000
#: Index entries that are looked at together.
ENTRIES = 1 << 20
K1, B = 1.2, 0.75
_WORD = re.compile(r"[^\W_]+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _shingles(words: list[str], k: int = SHINGLE) -> set[tuple]:
    return set(zip(*(words[i:] for i in range(k)), strict=False)) if len(words) >= k else {tuple(words)} if words else set()


@dataclass(frozen=True)
class Corpus:
    """Figures of all items: how many have words, their mean and greatest length in words, and in how many a term stands."""

    n: int
    mean: float
    longest: int
    df: dict[str, int]


class Index:
    """An inverted index of test items with block maxima."""

    def __init__(self, items: list[tuple[int, str]], recall_at: float = RECALL_AT, block: int = BLOCK, corpus: Corpus | None = None):
        self.ids, self.words, self.parts, self.shingles = [], [], [], []
        for i, text in items:
            w = words_of(text or "")
            if not w:
                continue
            *question, answer = [s for s in map(words_of, _SENTENCE.split(text)) if s]
            self.ids.append(i)
            self.words.append(w)
            self.parts.append([p for p in ({x for s in question for x in s}, set(answer)) if p])
            self.shingles.append(_shingles(w))
        n = len(self.ids)
        tf = [Counter(w) for w in self.words]
        df = Counter(t for c in tf for t in c)
        if corpus is None:  # these are all items
            corpus = Corpus(n, sum(map(len, self.words)) / max(n, 1), max(map(len, self.words), default=0), df)
        self.longest, mean = corpus.longest, corpus.mean
        self.term = {t: k for k, t in enumerate(sorted(df))}
        idf = {t: math.log(1 + (corpus.n - corpus.df[t] + 0.5) / (corpus.df[t] + 0.5)) for t in df}
        weights: list[dict[int, float]] = []
        for d, c in enumerate(tf):
            norm = K1 * (1 - B + B * len(self.words[d]) / mean)
            weights.append({self.term[t]: idf[t] * f * (K1 + 1) / (f + norm) for t, f in c.items()})
        self.weights = weights
        self.least = [recall_at * sum(w.values()) for w in weights]
        # An item's commonest terms, up to half of what it needs, are not essential: without them
        # it still needs the other half, so only its other postings have to be read.
        common = {self.term[t]: d for t, d in df.items()}
        essential: list[list[tuple[int, float]]] = []
        self.needs = np.zeros(n)
        for d, own in enumerate(weights):
            left = self.least[d] / 2
            kept = []
            for t in sorted(own, key=lambda t: (-common[t], t)):
                if own[t] <= left and not kept:
                    left -= own[t]
                else:
                    kept.append((t, own[t]))
            essential.append(kept)
            self.needs[d] = self.least[d] / 2 + left
        # blocks of items with like needs
        self.order = np.argsort(self.needs, kind="stable")
        self.block, self.blocks = block, -(-n // block)
        self.block_needs = np.array([self.needs[self.order[b * block]] for b in range(self.blocks)])
        postings: list[list[tuple[int, float]]] = [[] for _ in self.term]
        for place, d in enumerate(self.order):
            for t, w in essential[d]:
                postings[t].append((place, w))
        # compressed rows: of each term its blocks with their maxima, and of each of those the postings
        self.start = np.zeros(len(postings) + 1, np.int64)
        at_block, best, at_post, places, worth = [], [], [0], [], []
        for t, own in enumerate(postings):
            for place, w in own:
                if self.start[t] == len(at_block) or at_block[-1] != place // block:
                    at_block.append(place // block)
                    best.append(w)
                    at_post.append(at_post[-1])
                best[-1] = max(best[-1], w)
                at_post[-1] += 1
                places.append(place)
                worth.append(w)
            self.start[t + 1] = len(at_block)
        self.read = {t: k for t, k in self.term.items() if postings[k]}  # terms with postings to read
        self.at_block, self.best, self.at_post = np.array(at_block, np.int64), np.array(best), np.array(at_post, np.int64)
        self.places, self.worth = np.array(places, np.int64), np.array(worth)

    @staticmethod
    def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The numbers start[i] ... start[i] + size[i] - 1 for each i."""
        return np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())

    def candidates(self, window: np.ndarray, term: np.ndarray) -> list[tuple[int, int]]:
        """(window, item): all pairs that may be over the items' thresholds. The pairs (window, term) are distinct and ordered."""
        if not len(term):
            return []
        size = self.start[term + 1] - self.start[term]
        if size.sum() > ENTRIES and window[0] != window[-1]:  # windows are ordered; a few at a time, so memory is bounded
            half = np.searchsorted(size.cumsum(), size.sum() / 2)
            at = np.searchsorted(window, window[half], "left") or np.searchsorted(window, window[half], "right")
            return self.candidates(window[:at], term[:at]) + self.candidates(window[at:], term[at:])
        entry = self._spread(self.start[term], size)
        cell = np.repeat(window, size) * self.blocks + self.at_block[entry]
        # a block whose maxima can't sum to the least need in it is skipped
        cells, where = np.unique(cell, return_inverse=True)  # only those that occur
        keep = (np.bincount(where, self.best[entry], len(cells)) >= self.block_needs[cells % self.blocks] - 1e-9)[where]
        if not keep.any():
            return []
        # in the blocks that are left: their postings, and the items that have what they need
        entry, owner = entry[keep], cell[keep] // self.blocks
        size = self.at_post[entry + 1] - self.at_post[entry]
        post = self._spread(self.at_post[entry], size)
        pair = np.repeat(owner, size) * len(self.order) + self.places[post]
        pairs, where = np.unique(pair, return_inverse=True)
        score = np.bincount(where, self.worth[post], len(pairs))
        alive = pairs[score >= self.needs[self.order[pairs % len(self.order)]] - 1e-9]
        return [(x // len(self.order), int(self.order[x % len(self.order)])) for x in alive.tolist()]

    def score(self, item: int, words: set[str]) -> float:
        own = self.weights[item]
        return sum(own.get(self.term[t], 0.0) for t in words if t in self.term)

    def verify(self, item: int, window: list[str]) -> float:
        """The share of the item's shingles that are in the window; 0 if its question or answer isn't there."""
        words = set(window)
        if any(2 * len(p & words) < len(p) for p in self.parts[item]):
            return 0.0
        found = _shingles(window, min(SHINGLE, len(self.words[item])))
        return len(self.shingles[item] & found) / len(self.shingles[item])

    def search(self, texts: list[str | None], overlap: float = OVERLAP):
        """(text number, item, score, share, first word) of each verified pair, best window first."""
        if not self.ids:
            return []
        width = 2 * max(self.longest, SHINGLE)
        step = width // 2
        best: dict[tuple[int, int], tuple[float, float, int]] = {}
        group, size = [], 0
        for i, t in enumerate([*texts, None]):
            if t:
                w = words_of(t)
                group.append((i, w))
                size += len(w)
            if group and (size > 200_000 or i == len(texts)):
                self._group(group, width, step, overlap, best)
                group, size = [], 0
        return [(i, k, *v) for (i, k), v in sorted(best.items())]

    def _group(self, group, width, step, overlap, best):
        known = self.read.get
        text_of, first_of, window, term = [], [], [], []
        for n, (_, w) in enumerate(group):
            t = np.fromiter(map(known, w, repeat(-1)), np.int64, len(w))
            at = np.flatnonzero(t >= 0)
            base, count = len(text_of), max(1, -(-(len(w) - width) // step) + 1 if len(w) > width else 1)
            text_of += [n] * count
            first_of += range(0, count * step, step)
            k = at // step  # a word is in the windows k and k - 1
            for own in (np.minimum(k, count - 1), k - 1):
                ok = (own >= 0) & (own < count) & (at < own * step + width)
                window.append(own[ok] + base)
                term.append(t[at[ok]])
        pair = np.unique(np.concatenate(window) * len(self.term) + np.concatenate(term))
        for w, item in self.candidates(pair // len(self.term), pair % len(self.term)):
            i, words = group[text_of[w]]
            own = words[first_of[w] : first_of[w] + width]
            if (score := self.score(item, set(own))) < self.least[item] - 1e-9:
                continue
            share = self.verify(item, own)
            if share >= overlap and (share, score) > best.get((i, item), (0, 0, 0))[:2]:
                best[i, item] = (share, score, first_of[w])


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", overlap: float = OVERLAP, recall_at: float = RECALL_AT, slice_items: int = SLICE_ITEMS) -> DataFrame:
    """(id, item_id, overlap, bm25, first_word): every document and test item of which it holds a copy; keyed by doc_key too."""
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    own = docs.select(F.col(id_col).alias("id"), F.xxhash64(id_col, text).alias("doc_key"), F.col(text).alias("text"))
    rows = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text")).filter("text is not null")
    n, letters = rows.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    parts = max(1, -(-n // slice_items), -(-letters // SLICE_LETTERS))
    if parts == 1:
        return _against(own, [(r.item_id, r.text) for r in rows.collect()], None, kind, overlap, recall_at).withColumnRenamed("id", id_col)
    # huge item tables: slices of like size, dealt by row so that copies don't gather, all with the figures of the whole table
    dealt, _ = cut(rows.withColumn("part", F.monotonically_increasing_id() % parts), "items")
    terms, _ = cut(_terms(dealt), "terms")
    n, mean, longest = terms.filter("term is null").agg(F.count("*"), F.avg("length"), F.max("length")).first()
    df = terms.filter("term is not null").groupBy("term").agg(F.count("*").alias("df"))
    out = None
    for part in range(parts):
        mine = [(r.item_id, r.text) for r in dealt.filter(F.col("part") == part).collect()]
        known = df.join(terms.filter((F.col("part") == part) & F.col("term").isNotNull()).select("term").distinct(), "term").collect()  # a slice's terms
        found = _against(own, mine, Corpus(n, mean or 0.0, longest or 0, {r.term: r.df for r in known}), kind, overlap, recall_at)
        out = found if out is None else out.unionAll(found)
    return out.withColumnRenamed("id", id_col)


def _terms(items: DataFrame) -> DataFrame:
    """(part, term, length): the distinct terms of each item, and one row with a null term for each item that has any."""

    def make():
        def step(parts, texts):
            out: dict[str, list] = {"part": [], "term": [], "length": []}
            for p, t in zip(parts, texts, strict=True):
                if w := words_of(t):
                    own = [None, *set(w)]
                    out["part"] += [p] * len(own)
                    out["term"] += own
                    out["length"] += [len(w)] * len(own)
            return out

        return step

    return arrow_map(items.select("part", "text"), make, "part long, term string, length long")


def _against(own: DataFrame, items: list[tuple[int, str]], corpus: Corpus | None, kind: str, overlap: float, recall_at: float) -> DataFrame:
    spark = own.sparkSession
    shared = spark.sparkContext.broadcast((sorted(items, key=lambda x: (x[0] is None, x[0] or 0, x[1])), corpus))

    def make():
        index = Index(shared.value[0], recall_at, corpus=shared.value[1])

        def step(ids, keys, texts):
            got = index.search(texts, overlap)
            return {
                "id": [ids[i] for i, *_ in got], "doc_key": [keys[i] for i, *_ in got], "item_id": [index.ids[k] for _, k, *_ in got],
                "overlap": [x[2] for x in got], "bm25": [x[3] for x in got], "first_word": [x[4] for x in got],
            }

        return step

    return arrow_map(own, make, f"id {kind}, doc_key long, item_id long, overlap double, bm25 double, first_word long")


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """docs without those that hold a copy of a test item."""
    hit = matches(docs, items, id_col, text).select(F.col("doc_key").alias("__hit")).distinct()
    return docs.withColumn("__key", F.xxhash64(id_col, text)).join(hit, F.col("__key") == F.col("__hit"), "left_anti").drop("__key")


def op10_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    out = matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "item_id", F.round("overlap", 6).alias("overlap"), F.round("bm25", 6).alias("bm25"), "first_word")
