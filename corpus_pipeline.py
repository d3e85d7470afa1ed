"""Corpus cleaning over ``documents``: five stages, each one operator of ``tillroll.llm``.

Every stage takes (spark, docs, sf_dir), works on all rows that the stage before
kept, and returns the columns of documents; the last returns packed pieces.
``run`` writes each stage's result to the shared folder and reads it again.

Null texts have no language and go with the first stage; an empty table stays
empty through all of them.  Rows with a null id are kept by the duplicate stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import best_fit, language_id, quality_rules, sim_hash, suffix_array
from tillroll.llm.common import stored, table


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a language, or with a rejected one, go; ``lang`` becomes the language found."""
    return language_id.keep_identified(docs, language_id.train(docs.where(~language_id.held_out())), into="lang")


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that fail one go; which rules bind follows the language that was found."""
    return quality_rules.keep(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-duplicates: the document with the smallest id of each group stays."""
    return sim_hash.keep_one(docs)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Suffix array: byte strings that an earlier document has are cut out."""
    return suffix_array.remove_repeats(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing into sequences of 1024 tokens."""
    return best_fit.pack_documents(docs)


STAGES = [
    ("language_id", identified),
    ("quality_rules", good),
    ("sim_hash", distinct),
    ("suffix_array", unrepeated),
    ("best_fit", packed),
]

#: A trained model, tokenisation and a local search are beyond SQL: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
