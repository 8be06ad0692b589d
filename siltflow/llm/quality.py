"""Quality rules: rule statistics of each text, and an isolation forest that judges them.

The statistics of a document become ratios (so that length alone says nothing). An isolation
forest is grown on labelled good documents: random splits isolate documents of odd ratios after
few steps. The threshold on the anomaly score comes from the labelled rows: of all cut-offs that
keep at least `keep_good` of the good labelled rows, the one with the best balanced accuracy.

The forest is fitted on at most `max_labelled` labelled rows (chosen by hash of their id);
everything else covers every row and the whole texts. Without labelled rows of both kinds only
the base rules decide. Null text counts as empty: zero words, so it fails the base rules.
Repeated rows give repeated rows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltflow.llm._common import arrow_map, table

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LABELLED = 12_000
#: Repeats up to this share are usual; only what is beyond counts as odd.
USUAL = 0.3
_SPACES = re.compile(r"[\x20\x09-\x0D]")
_UPPER = re.compile(r"[^\W\d_a-zß-öø-ÿ]")
_PUNCT = re.compile(r"[!?;:|*#$%&<>=_~^\\/{}\[\]]")
FEATURES = ("symbols_a_word", "marks_a_char", "upper_share", "repeat_excess", "dup_line_excess", "mean_word", "distinct_share", "odd_share")


def rule_stats(text: str | None) -> tuple[int, int, int, int, int, list[float]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the forest's features."""
    text = text or ""
    words = text.encode().split()  # splits at x20 and x09-x0D only, as bytes do
    n = len(words)
    chars = len(text) - len(_SPACES.findall(text))
    symbols = sum(map(text.count, SYMBOLS))
    lines = text.split("\n")
    dup_lines = 0
    if len(set(lines)) < len(lines):
        seen: set[str] = set()
        for line in lines:
            if line in seen:
                dup_lines += bool(line.encode().split())
            seen.add(line)
    repeat = 0
    if n >= 3:
        windows = list(zip(words, words[1:], words[2:], strict=False))
        if len(set(windows)) < len(windows):
            once: set = set()
            twice: set = set()
            for w in windows:
                (twice if w in once else once).add(w)
            upto = 0
            for i, w in enumerate(windows):
                if w in twice:
                    repeat += i + 3 - max(i, upto)
                    upto = i + 3
    k, c = max(n, 1), max(chars, 1)
    letters = max(1, sum(map(len, words)))
    distinct = len(set(words))
    features = [
        symbols / k,
        len(_PUNCT.findall(text)) / c,
        len(_UPPER.findall(text)) / c,
        max(0.0, repeat / k - USUAL),
        max(0.0, dup_lines / len(lines) - USUAL),
        min(c / k, 40.0),
        distinct / k**0.8,
        1 - chars / letters,
    ]
    return n, chars, symbols, dup_lines, repeat, features


@dataclass
class Forest:
    """Isolation trees as arrays: node i of tree t splits feature[t, i] at cut[t, i]; leaves have feature -1."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    depth: np.ndarray
    scale: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 ** (-mean path length / expected path length): near 1 is odd, under 0.5 is ordinary."""
        if not len(x):
            return np.zeros(0)
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for f, cut, left, depth in zip(self.feature, self.cut, self.left, self.depth, strict=True):
            at = np.zeros(len(x), dtype=np.int32)
            while (open_ := f[at] >= 0).any():
                go_right = x[rows, np.maximum(f[at], 0)] >= cut[at]
                at = np.where(open_, left[at] + go_right, at)
            total += depth[at]
        return np.exp2(-total / len(self.feature) / self.scale)


def _expected(n: float) -> float:
    """Mean path length of an unsuccessful search among n."""
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def grow(x: np.ndarray, trees: int = 100, sample: int = 256, seed: int = 7) -> Forest:
    rng = np.random.default_rng(seed)
    sample = min(sample, len(x))
    limit = int(np.ceil(np.log2(max(sample, 2)))) + 2
    size = 2 ** (limit + 1) + 2
    feature, cut = np.full((trees, size), -1, np.int32), np.zeros((trees, size))
    left, depth = np.zeros((trees, size), np.int32), np.zeros((trees, size))
    for t in range(trees):
        rows = x[rng.choice(len(x), sample, replace=False)]
        free, todo = 1, [(0, rows, 0)]
        while todo:
            i, part, d = todo.pop()
            lo, hi = part.min(0), part.max(0)
            wide = np.flatnonzero(hi > lo)
            if d >= limit or len(part) < 2 or not len(wide):
                depth[t, i] = d + _expected(len(part))
                continue
            f = rng.choice(wide)
            c = rng.uniform(lo[f], hi[f])
            right = part[:, f] >= c
            feature[t, i], cut[t, i], left[t, i] = f, c, free
            todo += [(free, part[~right], d + 1), (free + 1, part[right], d + 1)]
            free += 2
    return Forest(feature, cut, left, depth, max(_expected(sample), 1e-9))


def calibrate(good: np.ndarray, bad: np.ndarray, keep_good: float) -> float:
    """The score above which a document is dropped."""
    best, at = -1.0, float(np.inf)
    for c in np.unique(np.concatenate([good, bad])):
        kept = (good <= c).mean()
        if kept >= keep_good and (value := kept + (bad > c).mean()) > best:
            best, at = value, float(c)
    return at


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", max_labelled: int = MAX_LABELLED, keep_good: float = 0.97) -> tuple[Forest, float] | None:
    """The forest and its threshold, from at most max_labelled labelled rows; None without both kinds.

    An id with several labels counts as good only if all of them are.
    """
    known = labels.filter(F.col("quality").isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("label_id"), F.col("quality").alias("good"), F.xxhash64(id_col).alias("h"))
    # only hashes under a bound that twice as many pass are sorted: what meets doesn't grow with the input
    few = known.filter((F.col("h") / F.lit(2.0**64) + 0.5) * known.count() <= 2 * max_labelled + 64)
    chosen = few.groupBy("label_id", "h").agg(F.min("good").alias("good")).orderBy("h", "label_id").limit(max_labelled).drop("h")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), F.col("id") == F.col("label_id"))
    # of rows that repeat an id the one with the least hash, so that as many are fitted on as ids are chosen
    least = rows.groupBy(F.col("id").alias("own")).agg(F.min(F.xxhash64("text")).alias("least"))
    rows = rows.join(F.broadcast(least), (F.col("id") == F.col("own")) & (F.xxhash64("text") == F.col("least")))

    def make():
        def step(texts, good):
            got = [rule_stats(t) for t in texts]
            return {"good": good, "n": [g[0] for g in got], "repeat": [g[4] for g in got], "x": [g[5] for g in got]}

        return step

    got = arrow_map(rows.select("text", F.col("good").cast("int")), make, "good int, n long, repeat long, x array<double>").distinct().collect()
    got = sorted((r for r in got if not base_failed(r.n, r.repeat)), key=lambda r: r.x)
    x, good = np.array([r.x for r in got]).reshape(-1, len(FEATURES)), np.array([r.good for r in got], dtype=int) > 0
    if good.sum() < 10 or not (~good).any():
        return None
    forest = grow(x[good])
    score = forest.score(x)
    return forest, calibrate(score[good], score[~good], keep_good)


def base_failed(n_words: int, n_repeat: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * n_words


def judge(docs: DataFrame, model: tuple[Forest, float] | None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rule statistics, base_failed, the anomaly score and kept, for each document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def step(ids, texts):
            got = [rule_stats(t) for t in texts]
            failed = [base_failed(g[0], g[4]) for g in got]
            if shared.value is None:
                score, most = np.zeros(len(got)), np.inf
            else:
                score, most = shared.value[0].score(np.array([g[5] for g in got]).reshape(-1, len(FEATURES))), shared.value[1]
            out = {"id": ids, "base_failed": failed, "score": score.tolist(), "kept": [not b and bool(s <= most) for b, s in zip(failed, score, strict=True)]}
            return out | {k: [g[i] for g in got] for i, k in enumerate(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))}

        return step

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    schema = f"id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, score double, kept boolean"
    return arrow_map(docs.select(id_col, text), make, schema).withColumnRenamed("id", id_col)


def op6_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return judge(docs, fit(docs, table(spark, sf_dir, "labels")))
