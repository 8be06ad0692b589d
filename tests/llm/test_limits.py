"""Time, memory, sizes and rare inputs of the operators, and predictions and forests by brute force."""

import collections
import random
import re
import time
import tracemalloc

import numpy as np
import pytest

from siltflow.llm import decontam, html_text, langid, quality, token_counts
from siltflow.llm._units import splits_at_spaces

# op1


@pytest.mark.parametrize("make", [lambda n: "<i>" * n + "</b>" * n, lambda n: "<p><table>" + "<i>" * n + "<h1></h1>" * n, lambda n: "<div>" * n + "<p>x, y</p>" * n, lambda n: "<li>" * n + "<i>" * n + "</ul>" * n])
def test_time_in_proportion_to_the_page(make):
    began = time.perf_counter()
    html_text.main_text(make(40_000))
    assert time.perf_counter() - began < 15  # a climb from each tag takes minutes


@pytest.mark.parametrize(("body", "want"), [
    ("<div class='page has-sidebar'><article><p>a, b, c</p></article></div><div class=sidebar><p>d, e, f</p></div>", "a, b, c"),
    ("<form id=aspnetForm><div id=content-no-comments><h1>T</h1><p>One, two, and three.</p></div></form>", "T\nOne, two, and three."),
    ("<div class=related><article><p>other, things</p></article></div><article><p>this, one</p></article>", "this, one"),
    ("<div id=story><p>All of it, here, at some length, as it goes.</p></div><div id=comments>" + "<p>I, for one, think so.</p>" * 3 + "</div>", "All of it, here, at some length, as it goes."),
    ("<h1>T</h1><p>" + "First, long, paragraph. " * 9 + "</p><h2>H</h2><ul><li>x</li></ul><p>Short.</p><p>" + "Last, long, one. " * 9 + "</p><div class=x><a href=y>link, link</a></div>", "T\n" + ("First, long, paragraph. " * 9).strip() + "\nH\nx\nShort.\n" + ("Last, long, one. " * 9).strip()),
    ("<article><p>a, b</p><form><input><p>Name, please</p></form><p>c</p></article>", "a, b\nc"),
])
def test_wrappers_and_siblings(body, want):
    assert html_text.main_text(f"<html><body>{body}</body></html>") == want


def test_score_before_mark():
    """A page's single article gives way where nearly all points lie elsewhere."""
    page = "<html><body><article><p>More, soon</p></article><div id=text>" + "<p>" + "Here, it, is, all, of, the, text. " * 9 + "</p>" + "</div></body></html>"
    assert html_text.main_text(page).startswith("Here, it")


# op6


def test_forest_by_hand():
    """Path lengths over the same splits, one row and one node at a time."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 5))
    forest = quality.grow(x, trees=20, sample=64)

    def path(t, row):
        at = 0
        while forest.feature[t, at] >= 0:
            at = forest.left[t, at] + (row[forest.feature[t, at]] >= forest.cut[t, at])
        return forest.depth[t, at]

    rows = np.concatenate([x[:40], rng.normal(size=(10, 5)) * 6])
    want = [2 ** (-np.mean([path(t, r) for t in range(20)]) / forest.scale) for r in rows]
    got = forest.score(rows)
    assert np.allclose(got, want) and got[40:].mean() > got[:40].mean()


def test_repeated_ids_dont_change_the_fit(spark):
    rng = random.Random(5)
    good = [(k, " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "of", "the"]) + str(rng.randint(0, 99)) for _ in range(60))) for k in range(60)]
    bad = [(100 + k, "!!! " + " ".join("#" * rng.randint(1, 9) + str(i) for i in range(60))) for k in range(20)]
    labels = spark.createDataFrame([(k, 1, 0) for k, _ in good] + [(k, 0, 0) for k, _ in bad], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(good + bad + good[:30] * 5, "doc_id long, text string")
    fits = [quality.fit(docs.repartition(n), labels, max_labelled=50) for n in (1, 3, 7)]
    assert len({f[1] for f in fits}) == 1 and all((f[0].cut == fits[0][0].cut).all() for f in fits)


# op8


def test_kind_of_pre_tokenizer():
    assert splits_at_spaces("byte_bpe_50k.json") and not splits_at_spaces("word_bpe_49k.json") and not splits_at_spaces("piece_bpe_32k.model")


def test_table_from_a_sample(spark):
    df = spark.createDataFrame([(k, f"common words and x{k}") for k in range(3000)], "doc_id long, text string")
    some = token_counts.frequent_words(df, sample_docs=300)
    assert {"common", "words", "and"} <= set(some) and len(some) < 50
    assert token_counts.token_counts(df).groupBy("n_tokens").count().count() >= 1


# op9


def test_letters_beyond_the_first_plane(spark):
    t = "\U00010001\U00020002\U00030003" * 4
    assert all(c.isalpha() for c in t)
    df = spark.createDataFrame([(1, t), (2, "a word"), (3, "123")], "doc_id long, text string")
    rows = {r.doc_id: r for r in langid.predict(df, {"xx": [int(g) for g in langid.Grams().ranked([t], 400)[1]], "yy": [5]}, ["doc_id"]).collect()}
    assert rows[1].lang_pred == "xx" and rows[1].score == 1.0 and rows[2].lang_pred != "und" and rows[3].lang_pred == "und"


def brute_profile(texts, most, code):
    """N-grams by falling count and then code, counted word by word."""
    n = collections.Counter()
    for t in texts:
        for w in re.findall(r"[^\W\d_]+", t.lower()):
            c = [0, *map(ord, w), 0]
            n.update(code(c[k], None, None) for k in range(1, len(c) - 1))
            n.update(code(c[k], c[k + 1], None) for k in range(len(c) - 1))
            n.update(code(*c[k : k + 3]) for k in range(len(c) - 2))
    return sorted(n, key=lambda g: (-n[g], g))[:most]


def test_predictions_by_brute_force(spark):
    """Profiles and out-of-place distances from the definition, over real rows."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    own = {r.doc_id: (r.text, r.lang) for r in docs.collect()}
    code = lambda *c: sum((0xFFFF if x is None else x) << s for x, s in zip(c, (32, 16, 0), strict=True))
    learned = {x: brute_profile([t for t, y in own.values() if y == x], 400, code) for x in {y for _, y in own.values() if y}}
    profiles = langid.learn(docs)
    assert profiles == learned
    for r in langid.predict(docs, profiles, ["doc_id"]).collect():
        mine = brute_profile([own[r.doc_id][0]], 400, code)
        far = {}
        for x, ranks in learned.items():
            place = {g: k for k, g in enumerate(ranks)}
            far[x] = sum(min(abs(place[g] - k), 400) if g in place else 400 for k, g in enumerate(mine))
        best = min(sorted(far), key=far.get)
        assert (r.lang_pred, round(r.score, 9)) == ((best, round(1 - far[best] / (400 * len(mine)), 9)) if mine else ("und", 0.0))


def test_other_languages_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    others = ["Witaj świecie, to jest zwykły tekst w języku polskim, który ma kilka zdań i nic więcej. Dzisiaj jest ładna pogoda.", "asdkjh qwoieu zmxncb qpwoei alskdj zmxnc bvqpwo eiruty alskdj fhgzm xncbv", "aGVsbG8gd29ybGQgdGhpcyBpcyBiYXNlNjQgZW5jb2RlZCB0ZXh0IHdpdGggbm8gbWVhbmluZw", "Привет мир, это обычный текст"]
    df = spark.createDataFrame([(k, t, None, None, len(t)) for k, t in enumerate(others)], docs.schema)
    model = langid.learn_with_limits(docs)
    assert langid.accepted(df, *model).count() == 0 and langid.accepted(docs, *model).count() == docs.filter(r"text rlike '\\p{L}'").count()


# op10


def test_memory_of_candidates():
    rng = random.Random(2)
    items = [(k, " ".join(f"w{rng.randrange(4000)}" for _ in range(12))) for k in range(5000)]
    index = decontam.Index(items)
    text = " ".join(f"w{rng.randrange(4000)}" for _ in range(199_000))
    tracemalloc.start()
    index.search([text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 400e6, peak


def test_slices_score_like_the_whole_table(spark):
    rng = random.Random(4)
    pick = lambda n: " ".join(f"w{min(199, int(rng.expovariate(0.03)))}" for _ in range(n))
    items = [(k, pick(rng.randint(6, 30))) for k in range(50)] + [(7, pick(9))] * 6
    docs = [(k, pick(40) + " " + (items[k % 50][1] if k % 2 else "") + " " + pick(30)) for k in range(60)]
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(tuple, decontam.matches(d, i).distinct().collect()))
    assert whole and whole == sorted(map(tuple, decontam.matches(d, i, slice_items=9).distinct().collect()))
