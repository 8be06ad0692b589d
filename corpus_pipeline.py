"""A corpus pipeline over documents: each stage is one of the operators of siltflow.llm.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame; all but the last keep the columns
of documents. Stages take any documents: empty tables, null texts and repeated rows included, as
their operators define them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltflow.llm import decontam, langid, line_templates, packing, simhash
from siltflow.llm._common import cut, discard, scoped, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in some learned language; profiles and limits come from those with a lang."""
    return langid.accepted(docs, *langid.learn_with_limits(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines of templates that recur across them."""
    return line_templates.drop_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no copy of a benchmark item."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

#: Tokens, fingerprints and profiles aren't expressible in SQL; tests/llm holds the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; each stage's rows are written and read again for the next."""
    docs, last = table(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES):
        with scoped() as made:
            out = stage(spark, docs, sf_dir)
            stored, path = cut(out, name) if k + 1 < len(STAGES) else (out, None)
        # a stage's tables go once its rows are written; those of the last stage are still to be read
        for old in [x for x in made if path and x != path] + [last] * bool(last):
            discard(spark, old)
        docs, last = stored, path
    return docs
