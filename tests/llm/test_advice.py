"""Cases that were wrong once: short lines, word fields, boilerplate, terms."""

import collections
import math
import random
import re

from siltflow.llm import line_templates, pii


def _prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(7)) for _ in range(n))


# op4


def test_short_lines_recur(spark):
    rng = random.Random(3)
    rows = [(k, f"{_prose(rng, 30)}\nAll rights reserved.\n{_prose(rng, 20)}" + ("\nSee also" if k < 9 else "")) for k in range(40)]
    rows += [(100 + k, "Only this\nhere") for k in range(50)]  # copies without a longer line
    out = {r.doc_id: r.text for r in line_templates.drop_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert not any("All rights reserved." in out[k] for k in range(40)) and all("See also" in out[k] for k in range(9))
    assert all(out[100 + k] == "Only this\nhere" for k in range(50))


# op2


def test_words_split_alike_on_both_ways(spark, monkeypatch):
    rows = [f"Cafe\u0301teria \u0915\u0932\u092e\u0916\u0917\u0918 wrote to bob@x.org from zeppe\u0301lin number {k}" for k in range(6)] + [f"plain line number {k} with other words" for k in range(60)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    terms = sorted(map(tuple, pii.disclosing_terms(df).collect()))
    found = sorted((r.doc_id, r.spans, r.sanitised_text) for r in pii.find(df).collect())
    assert {"cafe", "teria", "lin"} <= {w for w, _ in terms}
    monkeypatch.setattr(pii, "BROADCAST_TERMS", 0)
    assert terms == sorted(map(tuple, pii.disclosing_terms(df).collect()))
    assert found == sorted((r.doc_id, r.spans, r.sanitised_text) for r in pii.find(df).collect())


def test_rare_names_of_rare_entities(spark):
    rng = random.Random(4)
    common = [_prose(rng, 1) for _ in range(40)]
    prose = lambda n: " ".join(rng.choice(common) for _ in range(n))
    rows = [f"{prose(12)}\n{prose(12)}" for _ in range(6000)]
    rows[7] = f"{prose(5)} Zaphodius writes from ann@x.org {prose(5)}"  # one line
    for k in (20, 21):  # another line of the same documents
        rows[k] = f"{prose(9)} {prose(9)}\nMeet Trillianne here {k}\n{prose(9)}\n{prose(10)} bob@y.org {prose(10)}"
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.word for r in pii.disclosing_terms(df).collect()}
    assert {"zaphodius", "trillianne"} <= got and not set(common) & got


def brute_terms(texts, near=pii.NEAR, alpha=pii.ALPHA, generalise_at=pii.GENERALISE_AT):
    """{word: disclosure} by the definition, over all pairs of distinct texts."""
    texts = sorted(set(t for t in texts if t))
    split = lambda t: [(m.start(), m.end(), m[0]) for m in re.finditer(r"[^\W\d_]{3,}", t.lower())]
    with_word, with_entity, beside = (collections.defaultdict(set) for _ in range(3))
    for d, t in enumerate(texts):
        for w in {w for *_, w in split(t)}:
            with_word[w].add(d)
        spans = pii.base_spans(t)
        free = [w for w in split(t) if not any(s < w[1] and w[0] < e for s, e, _ in spans)]
        for s, e, kind in spans:
            x = pii._entity(kind, t[s:e])
            with_entity[x].add(d)
            low, high = t.rfind("\n", 0, s) + 1, t.find("\n", s)
            line = [w for w in free if low <= w[0] and (high < 0 or w[1] <= high)]
            for *_, w in [w for w in line if w[1] <= s][-near:] + [w for w in line if w[0] >= e][:near]:
                beside[x, w].add(d)
    out = {}
    for x, own in with_entity.items():
        met = {w: v for (y, w), v in beside.items() if y == x}
        if len(own) > 1:
            met = {w: own & v for w, v in with_word.items() if own & v and any(w in {a[2] for a in split(texts[d]) if not any(s < a[1] and a[0] < e for s, e, _ in pii.base_spans(texts[d]))} for d in own & v)}
        n, content = len(texts), math.log2(len(texts) / len(own))
        for w, both in met.items():
            k, mean = len(both), len(with_word[w]) * len(own) / n
            told = math.log2(k * n / (len(with_word[w]) * len(own))) / content if content else 0.0
            if mean < k and k * (1 + math.log(mean / k)) - mean <= math.log(alpha / len(met)) and told >= generalise_at:
                out[w] = max(told, out.get(w, 0.0))
    return out


def test_terms_by_brute_force(spark):
    """Random small corpora; the corpus's size is estimated, so words beside a limit may differ."""
    rng = random.Random(12)
    common, rare = [_prose(rng, 1) for _ in range(30)], [_prose(rng, 1) for _ in range(400)]
    people = [f"p{k}@x.org" for k in range(12)] + [f"10.0.0.{k}" for k in range(6)]
    rows = []
    for _ in range(1500):
        words = [rng.choice(common) if rng.random() < 0.9 else rng.choice(rare) for _ in range(rng.randint(5, 40))]
        if rng.random() < 0.05:
            k = int(rng.expovariate(0.2)) % len(people)
            at = rng.randrange(len(words))
            words[at:at] = [people[k], rare[k]]
        rows.append(" ".join(w + ("\n" if rng.random() < 0.05 else "") for w in words))
    rows += rows[:40] + [None, ""]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.word: r.disclosure for r in pii.disclosing_terms(df).collect()}
    want = brute_terms(rows)
    sure = {w for w, v in brute_terms(rows, generalise_at=pii.GENERALISE_AT + 0.02, alpha=pii.ALPHA / 2).items()}
    loose = {w for w, v in brute_terms(rows, generalise_at=pii.GENERALISE_AT - 0.02, alpha=2 * pii.ALPHA).items()}
    assert want and sure <= set(got) <= loose and all(abs(got[w] - want[w]) < 0.02 for w in set(got) & set(want))


def test_variable_words_in_short_and_long_lines(spark):
    rng = random.Random(6)
    name = lambda: _prose(rng, 1)
    own = lambda k: f"{_prose(rng, 30)}\n{_prose(rng, 25)}"
    rows = [(k, f"{own(k)}\nPosted by {name()} in news and {name()} today\nShare this story on Facebook with {name()} and also follow {name()}") for k in range(12)]
    rows += [(100 + k, f"{own(k)}\nPage {k} of {k + 40} pages\nPosted by {name()} in {('Sports', 'News', 'Arts')[k % 3]}") for k in range(100)]
    out = {r.doc_id: r.text for r in line_templates.drop_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(out[k].count("\n") == 1 and "Posted" not in out[k] and "Share" not in out[k] for k in range(12))
    assert all(out[100 + k].count("\n") == 1 and "pages" not in out[100 + k] and "Posted" not in out[100 + k] for k in range(100))


def test_boilerplate_that_outweighs_the_text(spark):
    rng = random.Random(7)
    passage, licence = _prose(rng, 60), "All of this page is under the licence that its publisher states on the first page of the site"
    rows = [(k, f"{_prose(rng, 40)}\n{passage}") for k in range(200)] + [(300 + k, f"{_prose(rng, 8)}\n{licence}") for k in range(20)]
    out = {r.doc_id: r.text for r in line_templates.drop_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all("\n" not in t and t for t in out.values())


def test_near_copies_survive(spark):
    rng = random.Random(8)
    original = [_prose(rng, 25).split() for _ in range(6)]
    rows = [(999, "\n".join(map(" ".join, original)))]
    for k in range(60):  # a word or two are changed in each copy
        lines = [list(x) for x in original]
        for _ in range(2):
            lines[rng.randrange(6)][rng.randrange(25)] = _prose(rng, 1)
        rows.append((k, "\n".join(map(" ".join, lines))))
    rows += [(2000 + k, f"{_prose(rng, 30)}\n{_prose(rng, 30)}") for k in range(20)]
    out = line_templates.drop_lines(spark.createDataFrame(rows, "doc_id long, text string"), report=True)
    assert out.filter("__dropped is not null").count() == 0


def test_entities_of_the_same_documents(spark, monkeypatch):
    """Pages with many addresses in common: the terms are the definition's exactly, and words are paired once for such a group."""
    rng, made = random.Random(21), {}
    words = [_prose(rng, 1) for _ in range(60)]
    line = lambda n: " ".join(rng.choice(words) for _ in range(n))
    group = [f"g{k}@dir.org" for k in range(10)]
    rows = [line(12) for _ in range(600)]
    rows += ["\n".join(f"{line(6)} {a} {line(5)}" for a in group) + f" zaphodius{k % 2} trillianne" for k in range(2)]
    rows += [f"{line(3)} solo{k}@x.org {line(3)} vogonic{k // 2}" for k in range(8)] + [f"{line(2)} pair{k // 3}@x.org marvinous{k // 3}" for k in range(9)]
    cut = pii.cut

    def watched(df, name):
        out = cut(df, name)
        made.setdefault(name, []).append(out[0])
        if name in ("met", "whole"):
            made[name + "_pairs"] = out[0].selectExpr("coalesce(sum(size(words)), 0)").first()[0]
        return out

    monkeypatch.setattr(pii, "cut", watched)
    got = {r.word: r.disclosure for r in pii.disclosing_terms(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()}
    want = brute_terms(rows)
    assert {"trillianne", "zaphodius"} <= want.keys() and got.keys() == want.keys()
    assert all(abs(got[w] - want[w]) < 1e-9 for w in want)
    assert made["whole_pairs"] < 300  # over 1,000 if each of ten addresses had the words of its two pages
