"""Registered queries of the training-data operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontamination, language_id, lattice_lm, neighbours, ngram_join, packing, quality, secrets, substring_dedup, toxicity
from .common import table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents."""
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents."""
    return secrets.scan(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents."""
    return language_id.identify(table(spark, sf_dir, "documents"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes and links of all documents by the Jaccard similarity of their word n-grams."""
    return ngram_join.join(table(spark, sf_dir, "documents"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents that repeat earlier passages."""
    return substring_dedup.dedup(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that documents contain."""
    return decontamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP6_SQL = """
with d as (select distinct doc_id, text from documents),
dw as (select doc_id, text, regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+') as w from d),
iw as (select item_id, text, regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+') as w
       from (select distinct item_id, text from benchmark)),
i as (select distinct item_id, text, array_to_string(w[p:p + 4], ' ') as phrase
      from (select item_id, text, w, unnest(range(1, len(w) - 3)) as p from iw)),
q as (select item_id, text, count(*) as n_shingles from i group by item_id, text),
s as (select distinct doc_id, text, array_to_string(w[p:p + 4], ' ') as phrase
      from (select doc_id, text, w, unnest(range(1, len(w) - 3)) as p from dw)),
h as (select s.doc_id, i.item_id, q.n_shingles, count(*) as n_shared
      from s join i using (phrase) join q on q.item_id = i.item_id and q.text = i.text
      group by s.doc_id, s.text, i.item_id, i.text, q.n_shingles),
r as (select *, n_shared / n_shingles as containment from h where n_shared / n_shingles >= 0.8)
select doc_id, item_id, n_shingles, n_shared, containment
from (select *, row_number() over (partition by doc_id, item_id order by containment desc, n_shared desc) as k from r)
where k = 1
"""


def op7_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Likelihoods of all documents."""
    return lattice_lm.score(table(spark, sf_dir, "documents"))


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest vectors of every hundredth vector."""
    return neighbours.search(table(spark, sf_dir, "embeddings"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of all documents' pieces in sequences."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents."""
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Name to (spark, sf_dir) -> DataFrame."""
    return {f.__name__: f for f in (op1_quality, op2_secrets, op3_language_id, op4_ngram_join, op5_substring_dedup, op6_decontamination, op7_lattice_lm, op8_neighbours, op9_packing, op10_toxicity)}


def oracle_sql() -> dict[str, str]:
    """Name to DuckDB SQL, where SQL can express the operator."""
    return {"op6_decontamination": OP6_SQL}
