"""A training corpus from ``documents``: five stages, each of which works on all rows that the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet to the shared folder and
read again as the next one's docs. The first four keep the columns of ``documents``; the last gives the pieces of
packed sequences.

Defined cases: a null, empty or letterless text has no language and goes at the first stage; a null doc_id stays a row
of its own and is carried to the pieces; rows that repeat an id and a text are near duplicates of each other, of which
one stays; of texts that tie for a class the least doc_id (null first), then the least hash of the text, stays; very
long texts are worked on whole; an empty table gives no rows, and an empty benchmark removes nothing; columns beside
those of ``documents`` are kept as they are by the first four stages, also where their names clash with columns that a
stage adds for itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadloom.llm import decontamination, language_id, ngram_join, packing, secrets
from roadloom.llm.common import Scratch, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known and not ambiguous; the others go."""
    return language_id.keep_identified(docs)


def join_ngrams(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return ngram_join.keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with marks in place of secrets."""
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("ngram_join", join_ngrams),
    ("decontamination", decontaminate),
    ("secrets", redact_secrets),
    ("packing", pack),
]

#: Learned language codes and tokenizer ids are beyond SQL; tests hold the result against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed corpus."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = scratch.cut(stage(spark, docs, sf_dir))
    return docs
