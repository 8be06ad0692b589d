"""Nulls, empty and very long texts, repeated rows, empty tables and extra columns, for each operator and stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from siltflow.llm import chat, decontam, html_text, langid, line_templates, packing, pii, quality, simhash, token_counts

LONG = "lorem ipsum dolor " * 40_000
LINES = "\n".join(f"line {k} of many lines with words" for k in range(5_000))
TEXTS = [None, "", " ", "\n\n", "a", "the quick brown fox jumps over the lazy dog", "the quick brown fox jumps over the lazy dog", "x" * 300_000, LONG, LINES, "1" * 5_000, "é\u0000  😀 \t", "<|endoftext|> [INST]"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that operators use inside, and that results have.
EXTRA = ["id", "n_tokens", "score", "fp", "component_id", "doc_key", "key", "word", "length", "piece", "keys", "doc", "dropped", "kept", "item_id", "window", "tokens", "url", "node", "u", "v", "h"]


def docs(spark, texts=TEXTS, extra=True):
    rows = [(k, t, ["en", None, "de"][k % 3], None if k % 2 else "s", None if t is None else len(t)) for k, t in enumerate(texts)]
    rows += rows[4:7] + [(None, "the quick brown fox", None, None, None)] * 2 if texts else []
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({c: F.lit(1) for c in EXTRA}) if extra else df


@pytest.fixture(scope="module")
def tables(spark):
    full = docs(spark).persist()
    return {"full": (full, full.count()), "empty": (full.limit(0), 0), "plain": (docs(spark, extra=False), full.count())}


CASES = ["full", "empty", "plain"]


@pytest.mark.parametrize("case", CASES)
def test_pii(tables, case):
    df, n = tables[case]
    rows = pii.find(df).collect()
    assert len(rows) == n and all(r.spans is not None and r.sanitised_text is not None for r in rows)


@pytest.mark.parametrize("case", CASES)
def test_line_dedup(tables, case):
    df, n = tables[case]
    out = line_templates.drop_lines(df)
    rows = out.collect()
    assert out.columns == df.columns and len(rows) == n
    assert sum(r.text is None for r in rows) == (1 if n else 0)


@pytest.mark.parametrize("case", CASES)
def test_packing(tables, case):
    df, n = tables[case]
    rows = packing.pack_documents(df).collect()
    assert bool(rows) == bool(n)
    if n:
        assert sum(r.doc_id is None for r in rows) == 2 and [r.length for r in rows if r.doc_id == 0] == [1]


@pytest.mark.parametrize("case", CASES)
def test_quality(spark, tables, case):
    df, n = tables[case]
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, None), (5, None, None), (None, 1, 1), (8, 1, 0), (8, 0, 0)], "doc_id long, quality int, toxic int").withColumn("text", F.lit("x"))
    for own in (labels, labels.limit(0)):
        rows = quality.judge(df, quality.fit(df, own)).collect()
        assert len(rows) == n and all(r.base_failed for r in rows if r.n_words < 50)


@pytest.mark.parametrize("case", CASES)
def test_simhash(tables, case):
    df, n = tables[case]
    rows = simhash.near_duplicates(df).collect()
    assert len(rows) == n
    one = simhash.keep_one(df)
    kept = one.collect()
    assert one.columns == df.columns and len(kept) == len({r.root for r in rows})
    if n:
        zero = {r.doc_id for r in rows if r.fp == 0}
        assert {0, 1, 2, 3} <= zero and all(r.component_id == 0 for r in rows if r.fp == 0)


@pytest.mark.parametrize("case", CASES)
def test_tokens(tables, case):
    df, n = tables[case]
    rows = token_counts.token_counts(df).collect()
    assert all((r.n_tokens == 0) == (r.n_bytes == 0) for r in rows) and bool(rows) == bool(n)


@pytest.mark.parametrize("case", CASES)
def test_language(tables, case):
    df, n = tables[case]
    out = langid.predict(df, langid.learn(df), ["doc_id", "source"])
    rows = out.collect()
    assert len(rows) == n and all(0 <= r.score <= 1 for r in rows) and all(r.lang_pred == "und" for r in rows if r.doc_id in (0, 1, 2, 3, 10))
    assert langid.accepted(df, {}).count() == 0 and langid.accepted(df, langid.learn(df)).columns == df.columns


@pytest.mark.parametrize("case", CASES)
def test_decontamination(spark, tables, case):
    df, n = tables[case]
    items = spark.createDataFrame([(1, "The quick brown fox jumps over the lazy dog."), (2, None), (3, ""), (None, "quick brown"), (1, "The quick brown fox jumps over the lazy dog.")], "item_id long, text string").withColumn("doc_id", F.lit(0))
    assert {r.doc_id for r in decontam.matches(df, items).filter("item_id = 1").collect()} == ({5, 6} if n else set())
    out = decontam.clean(df, items.filter("item_id = 1"))
    assert out.columns == df.columns and out.count() == (n - 4 if n else 0)
    assert decontam.clean(df, items.limit(0)).count() == n and decontam.matches(df.limit(0), items).count() == 0


def test_pages(spark):
    pages = [None, "", "   ", "<p>", "<", "<!--", "plain", "<p>a" * 3_000, "<div>" * 3_000 + "deep" + "</div>" * 3_000, "<script>x", "<article>" + "<p>long, text</p>" * 20_000 + "</article>"]
    df = spark.createDataFrame([(k, None, p) for k, p in enumerate(pages)] + [(None, "u", "<p>x</p>")] * 2, "page_id long, url string, html string").withColumn("text", F.lit(1)).withColumn("n_chars", F.lit(1))
    rows = {r.page_id: r for r in html_text.extract(df).collect()}
    assert rows[0].text == rows[1].text == rows[2].text == rows[3].text == rows[9].text == "" and rows[6].text == "plain" and rows[8].text == "deep" and rows[None].text == "x"
    assert rows[10].n_chars == 20_000 * 11 - 1 and html_text.extract(df.limit(0)).count() == 0


def test_conversations(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", LONG[:50_000]), (1, 1, "assistant", "tie"), (1, 1, "assistant", "tie"), (1, None, None, None), (None, 0, "assistant", "<|start|>&lt;[INST]"), (2, None, "system", ""), (2, 0, "system", "again")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit(1) for c in ("window", "tokens", "start", "cell", "system", "past1", "context")})
    for budget, history in ((2048, 2), (8, 0), (8, 3)):
        got = {r.conv_id: r for r in chat.read_back(chat.windows(df, budget, history)).collect()}
        assert got[1].n_turns == 5 and got[1].loss_chars == 50_006 and got[None].loss_chars == 19 and got[2].loss_chars == 0
    assert chat.read_back(chat.windows(df.limit(0))).count() == 0


FOX = "The quick brown fox jumps over the lazy dog."


@pytest.mark.parametrize("case", CASES)
def test_stages(spark, tables, case, tmp_path):
    """Each stage on whole odd tables, and on a benchmark whose columns are named like those of the stages."""
    df, n = tables[case]
    items = spark.createDataFrame([(1, FOX), (1, FOX), (None, None), (2, "")], "item_id long, text string").withColumns({c: F.lit(1) for c in ("id", "doc_key", "doc_id", "bm25", "part", "term", "first_word")})
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {name: stage(spark, df, str(tmp_path)) for name, stage in corpus_pipeline.STAGES}
    assert all(got[name].columns == df.columns for name, _ in corpus_pipeline.STAGES[:-1])
    rows = {name: out.collect() for name, out in got.items()}
    if not n:
        assert not any(rows.values())
        return
    ids = lambda name: sorted((r.doc_id is None, r.doc_id or 0) for r in rows[name])
    whole = sorted((r.doc_id is None, r.doc_id or 0) for r in df.select("doc_id").collect())
    assert not {(False, k) for k in (0, 1, 2, 3, 10)} & set(ids("language_id")) and set(ids("language_id")) <= set(whole)
    assert ids("line_dedup") == whole
    assert len(rows["near_dedup"]) == len({r.root for r in simhash.near_duplicates(df).collect()})
    assert ids("decontaminate") == [x for x in whole if x not in ((False, 5), (False, 6))]
    assert len({r.doc_id for r in rows["pack"]}) == len(set(whole)) and sum(r.piece == 0 for r in rows["pack"]) == n


def test_stages_in_a_row(spark, tables, tmp_path):
    df, _ = tables["full"]
    df.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, FOX)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert rows and not {5, 6} & {r.doc_id for r in rows}


def test_scratch_tables(spark):
    from siltflow.llm import _common

    df, path = _common.cut(spark.range(3), "t")
    assert path.startswith(_common.scratch_dir(spark)) and path.startswith(spark.conf.get("spark.checkpoint.dir")) and df.count() == 3
    _common.discard(spark, path)
    assert not spark._jvm.java.io.File(path.removeprefix("file://")).exists()
