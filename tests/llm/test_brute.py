"""Operators against brute force, round trips and held-out accuracy on small tables."""

import collections
import hashlib
import random
import re
import zlib
from html.parser import HTMLParser

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from siltflow.llm import chat, decontam, html_text, langid, line_templates, packing, pii, quality, simhash
from siltflow.llm._units import UnitCache, load_tokenizer, unit_encoder
from siltflow.llm.components import components
from siltflow.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def run(spark, name):
    return QUERIES[name](spark, SF).collect()


# op1


PARTS = [
    ("<nav><a href=x>m, m, m, menu</a></nav>", None), ("<header>Site, name</header>", None), ("<div class='ad-box'>Buy, now, please</div>", None), ("<aside>See, also, this</aside>", None),
    ("<form><p>Name, please</p></form>", None), ("<div id=comments><p>First, of, all, comments</p></div>", None), ("<script>var a='<p>x, y</p>'</script>", None), ("<div class=\"cookie-notice\">We, use, cookies</div>", None), ("<footer>&copy; x, y</footer>", None),
    ("<!-- <p>not, this</p> -->", None),
]


@pytest.mark.parametrize("seed", range(20))
def test_pages_with_noise(seed):
    rng = random.Random(seed)
    article = [f"Sentence {k}, with &amp; some, words &eacute; in\n  it." for k in range(rng.randint(1, 6))]
    before, after = rng.sample(PARTS, 3), rng.sample(PARTS, 3)
    body = "".join(f"<p>{x}</p>" if rng.random() < 0.7 else f"<p>{x}" for x in article)
    wrap = rng.choice(["<article><h1>T</h1>{}</article>", "<main><article><h1>T</h1>{}</article></main>", "<div class=page><article><h1>T</h1>{}</article></div>"])
    page = "<html><body>" + "".join(p for p, _ in before) + wrap.format(body) + "".join(p for p, _ in after) + "</body></html>"
    assert html_text.main_text(page) == "\n".join(["T", *(f"Sentence {k}, with & some, words é in it." for k in range(len(article)))])


@pytest.mark.parametrize(("body", "want"), [
    ("<div class=content><div>One, two and three.</div><div>Short.</div><div>Four, five, six, seven.</div></div><div class=x><a href=y>a link, and another</a></div>", "One, two and three.\nShort.\nFour, five, six, seven."),
    ("<div class=top>Site</div><div class=story>All of the text, in one block, without any paragraph, at all.</div><div class=low>Imprint</div>", "All of the text, in one block, without any paragraph, at all."),
    ("<div><h2>Title</h2><p>First, one.</p><ul><li>a<li>b</ul><table><tr><td>c<td>d</table><blockquote>e</blockquote><pre>f\n g</pre></div>", "Title\nFirst, one.\na\nb\nc\nd\ne\nf g"),
    ("<main><section><h1>A</h1><p>b, c</p></section><section><p>d, e</p></section></main>", "A\nb, c\nd, e"),
    ("<main><article class=has-comments><p>a, b</p></article><section><p>other, things, and more of them, by far</p></section></main>", "a, b"),
    ("<article><p>a, b</p></article><article class=comment><p>nice, nice, nice</p></article><article><p>c</p></article>", "a, b\nc"),
    ("<p>1 &lt; 2 &#x41; &amp;amp; &nbsp; x</p>", "1 < 2 A &amp; x"),
])
def test_other_pages(body, want):
    assert html_text.main_text(f"<html><body>{body}</body></html>") == want


class Plain(HTMLParser):
    """The text of a page's article, by a parser of its own: lines at the ends of paragraphs, cells, headings and breaks of blocks."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.off, self.lines = 0, 0, [""]

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "article"
        self.off += tag in ("script", "style", "nav", "aside", "form", "footer", "header") or dict(attrs).get("class") in ("ad", "comments")
        self.handle_data("\n" if tag == "br" else "")
        if tag in ("p", "li", "tr", "td", "th", "h1", "h2", "h3", "div", "table", "ul", "ol", "blockquote", "pre"):
            self.lines.append("")

    def handle_endtag(self, tag):
        self.inside -= tag == "article"
        self.off -= self.off > 0 and tag in ("script", "style", "nav", "aside", "form", "footer", "header", "div")
        if tag in ("p", "li", "tr", "td", "th", "h1", "h2", "h3", "div", "table", "ul", "ol", "blockquote", "pre"):
            self.lines.append("")

    def handle_data(self, data):
        if self.inside and not self.off:
            self.lines[-1] += data


def plain_article(page):
    parser = Plain()
    parser.feed(page)
    return "\n".join(x for x in (" ".join(y.split()) for y in parser.lines) if x)


def test_pages_query(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = run(spark, "op1_html_extraction")
    assert len(rows) == len(pages) == 50
    for r in rows:
        assert r.url == pages[r.page_id].url and r.n_chars == len(r.text) > 0 and r.text == plain_article(pages[r.page_id].html)


# op2


def plain_spans(t):
    luhn = lambda d: sum(sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(reversed(d))) % 10 == 0
    out = [(m.start(), m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), m.end(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), m.end(), "card") for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 12 <= len(d := re.sub("[^0-9]", "", m[0])) <= 19 and luhn(d)]
    out += [(m.start(), m.end(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[2])))


def test_base_spans_by_chance():
    rng = random.Random(1)
    for letters in ("a@.b_- 1", "0123.. +()-", "19 -.+@x\n", "12.5", "4 -"):
        for _ in range(4000):
            t = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
            assert pii.base_spans(t) == plain_spans(t), t


def test_pii_query(spark, texts):
    for r in run(spark, "op2_pii"):
        want = plain_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, e, k in want).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(x[2] == k for x in want) for k in pii.KINDS)


def test_disclosing_terms(spark, monkeypatch):
    rows = [f"Mr Smithson wrote to bob@x.org about zeppelin number {k} and other things" for k in range(6)] + [f"plain line number {k} with other things and nothing else" for k in range(60)]
    rows += ["copied line of ann@x.org with a unicorn"] * 9  # copies count once
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.word: r.disclosure for r in pii.disclosing_terms(df).collect()}
    assert {"smithson", "zeppelin"} <= set(got) and not {"unicorn", "number", "other", "things"} & set(got)
    one = {r.doc_id: (r.spans, r.sanitised_text) for r in pii.find(df).collect()}
    assert "zeppelin" not in one[0][1] and "[email]" in one[0][1] and one[10][0] == ""
    monkeypatch.setattr(pii, "BROADCAST_TERMS", 0)  # the way without broadcasts
    assert one == {r.doc_id: (r.spans, r.sanitised_text) for r in pii.find(df).collect()}


# op3


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, name):
    for table in ("conversations", "documents"):
        duckdb.sql(f"create or replace view {table} as select * from '{SF}/{table}.parquet'")
    want = duckdb.sql(SQL[name])
    got = QUERIES[name](spark, SF).select(*want.columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())


@pytest.mark.parametrize(("budget", "history", "tokens"), [(64, 2, 30), (200, 3, 60), (1000, 0, 0)])
def test_windows(spark, budget, history, tokens):
    conv = spark.read.parquet(f"{SF}/conversations.parquet")
    w = chat.windows(conv, budget, history, tokens).cache()
    whole = {r.conv_id: r[1:5] for r in chat.read_back(chat.windows(conv)).collect()}
    assert {r.conv_id: r[1:5] for r in chat.read_back(w).collect()} == whole
    systems = {r.conv_id: r.text for r in conv.filter("role = 'system' and turn = 0").collect()}
    for r in w.collect():
        assert r.n_context <= history + 1 and (r.over_budget or r.n_tokens <= budget) and (not r.over_budget or r.n_new == 1 or r.conv_id in systems)
        assert r.text.count(chat.START) == r.text.count(chat.END) == r.n_context + r.n_new
        if r.conv_id in systems:
            assert r.text.startswith(chat.START + "system\n" + systems[r.conv_id])
        assert all(r.text[: s.start].endswith("assistant\n") and r.text[s.end :].startswith(chat.END) for s in r.loss_spans)


def test_escapes(spark):
    rng = random.Random(5)
    bits = ["<|start|>", "<|end|>", "&lt;", "&amp;", "&", "<", "[", "&#91;", "[INST]", "</s>", "\n", "a", "amp;", "lt;"]
    said = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 9))) for _ in range(200)]
    rows = [(k, t, r, x) for k, x in enumerate(said) for t, r in enumerate(("user", "assistant", x))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for r in chat.read_back(chat.windows(df, 16, 1, 8)).collect():
        x = said[r.conv_id]
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{x}\n" for a in ("user", "assistant", x)).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256((x * (1 + (x.lower() == "assistant"))).encode()).hexdigest()


# op4


def brute_lines(rows):
    """{doc: positions}, by the definition, from (doc, text) of distinct documents."""
    V = line_templates.VARIABLE
    lines, exact, leaves = {}, collections.defaultdict(list), collections.defaultdict(list)
    for d, t in rows:
        for p, line in enumerate(t.split("\n")):
            raw = line.split()
            n = len(raw)
            if not n:
                continue
            masked = [V if re.search(r"\d", x) else x for x in raw]
            fixed = sum(x != V for x in masked)
            tokens = masked if fixed else raw
            lines[d, p] = n
            if fixed >= 4:
                exact["long" if n >= 20 else "exact", *tokens].append((d, p))
            else:
                if fixed and n >= 4:
                    exact["exact", *raw].append((d, p))
                exact["short", *tokens].append((d, p))
            if n >= 5 and fixed:
                for k in range(3):
                    part = tuple(tokens[2 + (n - 2) * k // 3 : 2 + (n - 2) * (k + 1) // 3])
                    if sum(x != V for x in (*tokens[:2], *part)) >= (4 if n >= 10 else 3):
                        leaves[n, tokens[0], tokens[1], k, part].append((d, p, tokens))
    docs_in = lambda own: {x[0] for x in own}
    shared = {(d, p) for own in exact.values() if len(docs_in(own)) > 1 for d, p in own}
    shared |= {(d, p) for key, own in leaves.items() if key[0] >= 10 and len(docs_in(own)) > 1 for d, p, _ in own}
    copies = set()
    for d in {d for d, _ in shared}:
        mine = {p: n for (e, p), n in lines.items() if e == d}
        if max(mine.values()) >= 4:
            mine = {p: n if n >= 4 else 0 for p, n in mine.items()}
        if sum(n for p, n in mine.items() if (d, p) not in shared) < 0.2 * sum(mine.values()):
            copies.add(d)
    count = lambda docs: len(docs - copies) + bool(docs & copies)
    usual = sorted(c for key, own in exact.items() if key[0] != "short" and len(docs_in(own)) > 1 and (c := count(docs_in(own))) >= 3)
    many = max(30, usual[(len(usual) + 1) // 2 - 1] if usual else 0)
    gone = {x for key, own in exact.items() if len(docs_in(own)) > 1 and count(docs_in(own)) >= {"long": 2, "exact": 3, "short": many}[key[0]] for x in own}
    before = set(gone)
    for (n, *_), own in leaves.items():
        own = [x for x in own if x[:2] not in before]
        at = collections.defaultdict(set)
        for d, _, tokens in own:
            for x in enumerate(tokens):
                at[x].add(d)
        merged = collections.defaultdict(list)
        for d, p, tokens in own:
            merged[tuple(x for x in enumerate(tokens) if x[1] != V and count(at[x]) >= 3)].append((d, p))
        for template, mine in merged.items():
            if 2 * len(template) >= n and count(docs_in(mine)) >= (3 if len(template) >= 6 else many):
                gone |= set(mine)
    out = {d: [] for d, _ in rows}
    for d, p in sorted(gone):
        out[d].append(p)
    return out


def test_line_query(spark, texts):
    want = brute_lines(list(texts.items()))
    got = {r.doc_id: r for r in run(spark, "op4_line_dedup")}
    for d, t in texts.items():
        left = "\n".join(x for p, x in enumerate(t.split("\n")) if p not in set(want[d]))
        assert got[d].dropped_lines == ",".join(map(str, want[d])) and got[d].text_sha256 == hashlib.sha256(left.encode()).hexdigest() and got[d].n_chars_left == len(left)
    assert sum(map(len, want.values())) > 20


def test_templates_and_copies(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(7))
    prose = lambda n: " ".join(word() for _ in range(n))
    rows = []
    passage = prose(60)
    for k in range(12):
        lines = [prose(30) for _ in range(4)]
        lines.insert(2, f"Posted by user{rng.randint(1, 10**6)} on 2024-0{k % 9 + 1}-11 in the news section of our own site here")
        if k < 2:
            lines.insert(1, passage)
        if k % 2:
            lines.append("Read the whole story of today " + prose(3) + " and more")
        rows.append((k, "\n".join(lines)))
    copy = "\n".join(prose(12) for _ in range(5))
    rows += [(100 + k, copy) for k in range(40)]
    out = {r.doc_id: r for r in line_templates.drop_lines(spark.createDataFrame(rows, "doc_id long, text string"), report=True).collect()}
    for k in range(12):
        assert "Posted by" not in out[k].text and passage not in out[k].text and out[k].text.count("\n") == (3 if k % 2 == 0 else 3 + ("Read the whole" in out[k].text))
    assert all(out[100 + k].text == copy for k in range(40))


# op5


def test_packing_query(spark, texts):
    rows = run(spark, "op5_best_fit_packing")
    library = load_tokenizer("byte_bpe_50k.json")
    by, seqs = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
        seqs[r.sequence_id].append((r.offset, r.length))
    for d, t in texts.items():
        ids = np.array([*library.encode(t, add_special_tokens=False).ids, 2], "<u4")
        own = sorted(by[d], key=lambda r: r.piece)
        assert [r.start for r in own] == list(np.cumsum([0, *(r.length for r in own)])[:-1]) and sum(r.length for r in own) == len(ids)
        assert all(r.length == 1024 for r in own[1:]) and all(zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in own)
    for own in seqs.values():
        own.sort()
        assert [o for o, _ in own] == list(np.cumsum([0, *(n for _, n in own)])[:-1]) and sum(n for _, n in own) <= 1024
    assert len(seqs) <= 1.02 * sum(r.length for r in rows) / 1024 + 2


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fit = [g for g in gaps if g >= n]
        if fit:
            gaps.remove(min(fit))
            gaps.append(min(fit) - n)
        else:
            gaps.append(capacity - n)
    return len(gaps)


def random_lengths(seed):
    rng = random.Random(seed)
    capacity = rng.choice([1, 7, 30, 64, 1024])
    return capacity, [rng.randint(1, capacity) if rng.random() < 0.6 else rng.choice([1, max(1, capacity // 2), capacity]) for _ in range(rng.randint(0, 400))]


def supersteps(lengths, capacity, ranges):
    """The packing of lengths by the operator's sweeps, range by range, and how many steps it took."""
    P, G, M = packing.PIECE, packing.GAP, packing.MOVE
    rows = [(P, k, 0, n, 0, 0, 0, 0) for k, n in collections.Counter(lengths).items()]
    step = 0
    while any(r[0] == P for r in rows):
        step += 1
        parts = collections.defaultdict(list)
        for r in rows:
            parts[-1 if r[0] == M else r[1] // max(1, capacity // ranges)].append(r)
        rows = packing._sweep([x for own in parts.values() for x in packing._sweep(own, capacity, False, step)], capacity, True, step)
    return [r for r in rows if r[0] == M], step


def checked(moves, lengths, capacity):
    """The number of sequences that moves (length, low, high, first, each, base) fill; all pieces are placed, without gaps and overlaps."""
    counts, used, ranks = collections.Counter(lengths), collections.defaultdict(list), collections.defaultdict(list)
    for length, low, high, first, each, base in moves:
        for r in range(low, high):
            ranks[length].append(r)
            used[first + (r - low) // each].append((base + (r - low) % each * length, length))
    assert all(sorted(v) == list(range(counts[k])) for k, v in ranks.items()) and sum(map(len, ranks.values())) == len(lengths)
    for own in used.values():
        at = 0
        for o, n in sorted(own):
            assert o == at
            at += n
        assert at <= capacity
    return len(used)


@pytest.mark.parametrize("seed", range(40))
def test_supersteps_pack_like_best_fit_decreasing(seed):
    capacity, lengths = random_lengths(seed)
    rows, steps = supersteps(lengths, capacity, 16)
    n = checked([(r[1], r[2], r[2] + r[3], r[4], r[5], r[7]) for r in rows], lengths, capacity)
    assert n <= best_fit_decreasing(lengths, capacity) + 1 and steps <= 60


def test_few_steps_for_many_pieces():
    rng = random.Random(1)
    lengths = [min(1024, int(rng.expovariate(1 / 300)) + 1) for _ in range(200_000)]
    rows, steps = supersteps(lengths, 1024, 16)
    used = len({r[4] + i for r in rows for i in range(-(-r[3] // r[5]))})
    assert steps <= 60 and len(rows) < 20_000 and used <= 1.001 * sum(lengths) / 1024 + 2


@pytest.mark.parametrize("seed", [3, 8])
def test_plan_runs_the_supersteps(spark, seed):
    capacity, lengths = random_lengths(seed)
    df = spark.createDataFrame(list(collections.Counter(lengths).items()), "length long, n long")
    moves = sorted(map(tuple, packing.plan(df, capacity).collect()))
    assert moves == sorted((r[1], r[2], r[2] + r[3], r[4], r[5], r[7]) for r in supersteps(lengths, capacity, packing.RANGES)[0])


def test_sequences(spark):
    df = spark.createDataFrame([(k, "word " * (k * 7 % 50)) for k in range(40)], "doc_id long, text string")
    packed = packing.pack_documents(df, capacity=32, with_ids=True).cache()
    ids = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    assert all(ids[r.sequence_id][r.offset : r.offset + r.length] == r.ids for r in packed.collect())


# op6


def test_quality_query(spark, texts):
    for r in run(spark, "op6_quality_rules"):
        t = texts[r.doc_id]
        w = WORD.findall(t)
        lines = t.split("\n")
        dup = sum(bool(WORD.search(x)) and x in lines[:k] for k, x in enumerate(lines))
        grams = collections.Counter(zip(w, w[1:], w[2:], strict=False))
        hit = {k + j for k, g in enumerate(zip(w, w[1:], w[2:], strict=False)) if grams[g] > 1 for j in range(3)}
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(hit))
        assert r.base_failed == (len(w) < 50 or 100 * len(hit) > 50 * len(w)) and not (r.base_failed and r.kept)


def test_forest_tells_good_from_bad(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = quality.fit(docs, labels.filter("doc_id % 2 = 0"))
    rows = quality.judge(docs, model).join(labels.filter("doc_id % 2 = 1"), "doc_id").filter("not base_failed").collect()
    good, bad = [r.kept for r in rows if r.quality], [r.kept for r in rows if not r.quality]
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.2


# op7


def plain_fingerprint(t):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[k : k + 3]).encode(), 42) for k in range(len(w) - 2)] or [xxhash.xxh64_intdigest(" ".join(w).encode(), 42)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps, limit=2):
    root = {i: i for i in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(fps)
    arr = np.array([fps[i] for i in ids], np.uint64)
    for a, i in enumerate(ids):
        for b in np.flatnonzero(np.bitwise_count(arr[a] ^ arr[a + 1 :]) <= limit) + a + 1:
            x, y = find(i), find(ids[b])
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_simhash_query(spark, texts):
    fps = {d: plain_fingerprint(t) for d, t in texts.items()}
    want = plain_components(fps)
    got = run(spark, "op7_simhash_near_dedup")
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {d: (f"{fps[d]:016x}", want[d]) for d in texts}


@pytest.mark.parametrize("leaf", [4, 128])
def test_links_of_crowded_fingerprints(spark, leaf):
    """Chains of near fingerprints in crowded runs."""
    rng = random.Random(9)
    fps, x = {}, rng.getrandbits(64)
    for k in range(1500):
        base = x if k % 3 else rng.getrandbits(64)
        for _ in range(rng.randint(0, 3)):
            base ^= 1 << rng.randrange(64)
        x = base if k % 50 else rng.getrandbits(64)
        fps[k] = base
    signed = [(k, v - (1 << 64) if v >> 63 else v) for k, v in fps.items()]
    df = spark.createDataFrame(signed, "id long, fp long")
    edges = simhash.links(df.select("fp").distinct(), leaf=leaf)
    root = {r.id: r.root for r in components(edges).collect()}
    groups = collections.defaultdict(set)
    for k, v in signed:
        groups[root.get(v, v)].add(k)
    want = collections.defaultdict(set)
    for k, v in plain_components(fps).items():
        want[v].add(k)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def in_gray_order(x):
    gray = x.copy()
    for k in (1, 2, 4, 8, 16, 32):
        gray ^= gray >> np.uint64(k)
    return x[np.argsort(gray)]


def test_links_between_runs():
    rng = np.random.default_rng(4)
    x = in_gray_order(np.unique(np.uint64(rng.integers(1 << 62)) ^ rng.integers(0, 1 << 12, 700).astype(np.uint64)))
    a, b = x[:333], x[100:]
    i, j = simhash.links_between(a, b, 2)
    p, q = np.nonzero(np.bitwise_count(a[:, None] ^ b[None, :]) <= 2)
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == set(zip(p.tolist(), q.tolist(), strict=True))


@pytest.mark.parametrize("limit", [0, 2, 5])
def test_tree_reaches_all_near_runs_and_no_others(limit):
    """Against all pairs of patterns; most nodes are left unseen, by groups."""
    rng = np.random.default_rng(5)
    x = in_gray_order(np.unique(rng.integers(0, 1 << 63, 40_000).astype(np.uint64)))
    mask, bits = simhash._patterns(np.full(len(x), ~np.uint64(0)), x, 8)
    run = np.arange(len(mask)) * 3
    tree, shuffled = simhash.Tree(run, mask, bits), rng.permutation(len(run))
    assert len(tree.levels) > 3 and all((a[1] == b[1]).all() for a, b in zip(tree.levels, simhash.Tree(run[shuffled], mask[shuffled], bits[shuffled]).levels, strict=True))
    looked = 0
    for k in range(0, len(run), 97):
        found, seen = tree.near(mask[k], bits[k], limit)
        assert found.tolist() == run[np.bitwise_count((bits ^ bits[k]) & mask & mask[k]) <= limit].tolist()
        looked += seen
    assert looked < len(run) * len(range(0, len(run), 97)) * (0.5 if limit <= 2 else 1)


def test_runs_are_the_sorted_table(spark):
    rng = random.Random(3)
    fps = sorted({rng.getrandbits(64) for _ in range(3000)})
    df = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in fps], "fp long")
    rows = simhash.runs(df, 16).orderBy("run").collect()
    members = np.array([m for r in rows for m in r.members], np.int64).view(np.uint64)
    assert (members == in_gray_order(np.array(fps, np.uint64))).all() and max(len(r.members) for r in rows) == 16
    for r in rows:
        own = np.array(r.members, np.int64).view(np.uint64)
        mask = ~(np.bitwise_and.reduce(own) ^ np.bitwise_or.reduce(own))
        assert np.int64(r.mask).view(np.uint64) == mask and np.int64(r.bits).view(np.uint64) == own[0] & mask
    n = len(rows)
    pairs = simhash.run_pairs(simhash.cut(simhash.runs(df, 16), "r")[0], 2).count()
    assert n <= pairs < n * n / 4  # whole groups of runs are left out


def test_long_texts_in_chunks(monkeypatch):
    rng = random.Random(3)
    t = " ".join("".join(rng.choice("abc") for _ in range(rng.randint(1, 9))) for _ in range(3000))
    want = plain_fingerprint(t)
    monkeypatch.setattr(simhash, "_CHUNK", 101)
    assert simhash.fingerprint(t) == want


# op8


def test_units():
    library, encode = load_tokenizer("byte_bpe_50k.json"), unit_encoder("byte_bpe_50k.json")
    rng = random.Random(7)
    cache = UnitCache(encode, limit=50)
    bits = [" ", "  ", "\n", " \n", "\t", " ", "<|endoftext|>", "a", "bc", "Wor", ".", "12", "'s", "é", "中文", "\x85", "\x1f", "🙂", "ª²", "l'an"]
    for _ in range(6000):
        t = "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))
        assert sum(cache.values(t), []) == library.encode(t, add_special_tokens=False).ids
    for k in range(0, 50_256, 7):
        for t in (library.decode([k]), " " + library.decode([k])):
            assert encode(t) == library.encode(t, add_special_tokens=False).ids


def test_token_query(spark, texts):
    library = load_tokenizer("byte_bpe_50k.json")
    for r in run(spark, "op8_token_counts"):
        n = len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len(texts[r.doc_id].encode()), n > 512)


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "word_bpe_49k.json"])
def test_other_tokenizers(spark, texts, name):
    from siltflow.llm.token_counts import token_counts

    library = load_tokenizer(name)
    df = spark.createDataFrame([(d, t[:2000]) for d, t in list(texts.items())[:20]], "doc_id long, text string")
    for r in token_counts(df, name).collect():
        t = texts[r.doc_id][:2000]
        assert r.n_tokens == (len(library.encode(t)) if name.endswith("model") else len(library.encode(t, add_special_tokens=False).ids))


# op9


def test_language_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = QUERIES["op9_language_id"](spark, SF).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r.lang == r.lang_pred for r in rows if r.held_out]
    assert np.mean(held) > 0.97


def test_grams_by_hand():
    grams = langid.Grams()
    rng = random.Random(8)
    said = ["".join(rng.choice("abC éß1,. \n中😀") for _ in range(rng.randint(0, 60))) for _ in range(50)]
    doc, gram, n = grams.counts(said)
    got = collections.defaultdict(dict)
    for d, g, c in zip(doc.tolist(), gram.tolist(), n.tolist(), strict=True):
        got[d][g] = c
    fold = lambda c: (ord(c) & 0xFFFF) ^ (ord(c) >> 16) if c else 0
    for d, t in enumerate(said):
        want = collections.Counter()
        for w in re.findall(r"[^\W\d_]+", t.lower()):
            c = [0, *map(fold, w), 0]
            for k in range(1, len(c) - 1):
                want[c[k] << 32 | 0xFFFFFFFF] += 1
                want[c[k - 1] << 32 | c[k] << 16 | c[k + 1]] += 1
            for a, b in zip(c, c[1:], strict=False):
                want[a << 32 | b << 16 | 0xFFFF] += 1
        assert got[d] == dict(want)


def test_long_text_language(monkeypatch):
    t = "ein haus und noch ein baum " * 300
    whole = langid.Grams().counts([t])
    monkeypatch.setattr(langid, "SLICE", 500)
    assert all((a == b).all() for a, b in zip(whole, langid.Grams().counts([t]), strict=True))


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64, 500])
@pytest.mark.parametrize("text", ["ein\nhaus\tund noch\x0b\nein baum\n" * 40, "\u8fd9\u662f\u4e00\u4e2a\u5f88\u957f\u7684\u6587\u672c" * 70, "abc" * 400 + " x\n" + "\u03a3\u0391\u03a3" * 90, "a1b2,c" * 99, "\u0130stanbul \U00010400\U00010401 " * 30, "\n" * 900 + "z", "1 2 3 " * 200])
def test_cuts_change_no_count(monkeypatch, text, size):
    whole = langid.Grams().counts(["", text])
    monkeypatch.setattr(langid, "SLICE", size)
    assert [x.tolist() for x in whole] == [x.tolist() for x in langid.Grams().counts(["", text])]


# op10


def test_decontamination_query(spark, texts):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    words = lambda t: " ".join(re.findall(r"[^\W_]+", t.lower()))
    exact = {(d, i) for d, t in texts.items() for i, x in items.items() if f" {words(x)} " in f" {words(t)} "}
    got = {(r.doc_id, r.item_id): r for r in run(spark, "op10_benchmark_decontamination")}
    assert exact and exact <= set(got)
    for (d, i), r in got.items():
        a = decontam._shingles(decontam.words_of(items[i]))
        assert r.overlap >= 0.8 and len(a & decontam._shingles(decontam.words_of(texts[d]))) >= 0.8 * len(a)


@pytest.mark.parametrize("block", [1, 4, 64])
def test_all_over_the_threshold_are_retrieved(block):
    rng = random.Random(6)
    vocabulary = [f"w{k}" for k in range(300)]
    pick = lambda n: [vocabulary[min(299, int(rng.expovariate(0.02)))] for _ in range(n)]
    items = [(k, " ".join(pick(rng.randint(3, 25)))) for k in range(60)]
    index = decontam.Index(items, block=block)
    windows = [pick(rng.randint(1, 50)) + (items[rng.randrange(60)][1].split() if k % 3 == 0 else []) for k in range(200)]
    window, term = zip(*sorted({(k, index.read[x]) for k, w in enumerate(windows) for x in w if x in index.read}), strict=True)
    got = {(w, i) for w, i in index.candidates(np.array(window), np.array(term)) if index.score(i, set(windows[w])) >= index.least[i] - 1e-9}
    want = {(k, i) for k, w in enumerate(windows) for i in range(60) if index.score(i, set(w)) >= index.least[i] - 1e-9}
    assert got == want and want


def test_changed_copies():
    rng = random.Random(1)
    words = [f"{rng.choice('abcdefgh')}{k}x" for k in range(40)]
    item = " ".join(words[:33]) + ". " + " ".join(words[33:]) + "."
    others = [(k, " ".join(rng.choice(words) + str(rng.randint(0, 9)) for _ in range(30))) for k in range(1, 20)]
    index = decontam.Index([(0, item), *others])
    hit = lambda w: [x[1] for x in index.search([" ".join(["pad"] * 70 + w + ["pad"] * 70)])]
    assert hit([w.upper() + ";" for w in words]) == [0] and hit([*words[:35], "other", *words[36:]]) == [0]  # a changed word in the answer
    assert hit(words[:33]) == [] and hit(words[20:]) == [] and hit(words[::-1]) == []


def test_item_slices(spark):
    docs = spark.createDataFrame([(1, "before alpha beta gamma delta epsilon zeta eta after")], "doc_id long, text string")
    items = spark.createDataFrame([(k, "alpha beta gamma delta epsilon zeta eta" if k == 5 else f"other words number {k} here and there") for k in range(9)], "item_id long, text string")
    assert [r.item_id for r in decontam.matches(docs, items, slice_items=2).collect()] == [5]


# all


def test_sql_names():
    assert set(SQL) <= set(QUERIES)


def test_pipeline(spark, texts):
    """The pipeline by brute force: what is kept after each stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r.doc_id: r.text for r in corpus_pipeline.language_id(spark, docs, SF).collect()}
    assert kept == {d: t for d, t in texts.items() if re.search(r"[^\W\d_]", t)}
    gone = brute_lines(list(kept.items()))
    kept = {d: "\n".join(x for p, x in enumerate(t.split("\n")) if p not in set(gone[d])) for d, t in kept.items()}
    group = plain_components({d: plain_fingerprint(t) for d, t in kept.items()})
    kept = {d: t for d, t in kept.items() if group[d] == d}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    words = lambda t: " ".join(re.findall(r"[^\W_]+", t.lower()))
    kept = {d: t for d, t in kept.items() if not any(f" {words(x)} " in f" {words(t)} " for _, x in items)}
    rows = corpus_pipeline.run(spark, SF).collect()
    library = load_tokenizer("byte_bpe_50k.json")
    length = collections.Counter()
    for r in rows:
        length[r.doc_id] += r.length
    assert length == {d: len(library.encode(t, add_special_tokens=False).ids) + 1 for d, t in kept.items()}
    assert docs.filter(F.col("doc_id").isin(list(kept))).count() == len(kept)
