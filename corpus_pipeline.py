"""Corpus pipeline: documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir); ``docs`` has the columns of documents
and is what the stage before kept.  All but the last return those columns.

Defined results: a null text counts as empty; null, empty and blank texts fail
the quality rules, and a text that repeated passages leave blank goes, too.
Nulls in other columns change nothing; a null doc_id is an id like any other.
Rows that repeat are copies, of which one stays.  Further columns, whatever
their names, are kept up to the last stage.  Very long texts are taken whole.
An empty table gives no rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from footfall.llm import ngram_join, packing, pii, quality_rules, suffix_dedup
from footfall.llm.common import stored, table

PASSAGE = 51                  # words: passages of over 50 that repeat are cut


def _counted(docs):
    """n_chars follows a changed text."""
    return docs.withColumn("n_chars", F.length("text").cast("bigint"))


def quality(spark, docs, sf_dir):
    """Drop the documents that the threshold table rejects."""
    return quality_rules.keep_documents(docs)


def near_duplicates(spark, docs, sf_dir):
    """Keep one document of each class of near copies."""
    return ngram_join.keep_one(docs)


def repeated_passages(spark, docs, sf_dir):
    """Cut every passage of PASSAGE words, or of op7's length in bytes, that
    stands in two places; a document of which nothing is left goes."""
    cut = _counted(suffix_dedup.remove_repeats(docs, words=PASSAGE))
    return cut.where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))


def personal_data(spark, docs, sf_dir):
    """Replace personal data by the name of its kind."""
    return _counted(pii.redact_documents(docs))


def packed(spark, docs, sf_dir):
    """Pieces of all documents with their place in a sequence."""
    return packing.pack(packing.token_pieces(docs))


STAGES = [
    ("quality_rules", quality),
    ("ngram_join", near_duplicates),
    ("suffix_dedup", repeated_passages),
    ("pii", personal_data),
    ("packing", packed),
]

ORACLE_SQL = None          # the later stages are beyond SQL; tested against plain Python


def run(spark, sf_dir):
    """All stages over documents; each stage's result is written and read."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
