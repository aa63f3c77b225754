"""Corpus pipeline: language ID, near duplicates, benchmark decontamination, PII, packing.

Each stage takes (spark, docs, sf_dir), works on all rows that its
predecessor kept, and returns a DataFrame that :func:`run` writes as Parquet
under the shared folder of ``spark.checkpoint.dir`` and reads back for the next
stage.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from viewstar.llm import decontaminate, langid, ngram_join, packing, pii
from viewstar.llm.queries import held_out
from viewstar.llm.tables import table, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language (operator 6); those without one (``und``) or without a likely one go."""
    return langid.spoken(docs, langid.train(docs.where(~held_out("doc_id", 3, 1))))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (operator 3): the smallest id, each row by its own text."""
    return ngram_join.first_of_each(docs)


def contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark (operator 9)."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with personal data masked in their texts (operator 2)."""
    return pii.sanitise(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens in packed sequences (operator 10)."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", contamination),
    ("pii", personal_data),
    ("packing", packed),
]

#: No SQL can express the trained models and the tokenizer; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
