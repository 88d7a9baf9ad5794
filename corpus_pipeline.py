"""Corpus pipeline: rules, language, near copies, repeated passages, packed sequences.

Each stage takes (spark, docs, sf_dir) and gives the documents that its successor works on, with
the columns of ``documents``; the last gives the packed pieces.  ``run`` writes every stage
to the shared folder and reads it again, so a lost executor costs one stage at most; the table of a stage is
deleted when its successor's is written.

Defined cases: null and empty texts fail the rules; rows with the same doc_id, or none, are told apart by their texts in every
stage; an empty table goes through all stages; extra columns are kept until the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from aeris.llm import langid, minhash, packing, quality_rules, suffix_dedup
from aeris.llm.common import read_table
from aeris.session import materialize, remove_paths


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the current rule policy."""
    return quality_rules.keep(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is told with some certainty."""
    return langid.keep(docs, langid.fit(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies; of equal rows one too."""
    return minhash.dedup(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that also stand elsewhere."""
    return suffix_dedup.strip_repeats(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences and their places."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality),
    ("language_id", language),
    ("minhash_near_dedup", near_copies),
    ("suffix_array_dedup", repeats),
    ("best_fit_packing", sequences),
]

# Language model, signatures and tokens have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    before: list[str] = []
    for name, stage in STAGES[:-1]:
        written: list[str] = []
        docs = materialize(stage(spark, docs, sf_dir), name, written)
        remove_paths(spark, before)
        before = written
    return STAGES[-1][1](spark, docs, sf_dir)
