"""A training corpus from raw documents, stage by stage.

Each stage takes the documents that its predecessor kept and returns documents with the same
columns; the last one returns token pieces and their place in packed sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallybook.llm import language, minhash, packing, secrets, spans
from tallybook.llm.common import configure, stage, table


def keep_recognised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    return language.recognised(docs)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return minhash.drop_near_duplicates(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that repeat stay where they come first."""
    return spans.without_repeats(docs)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live secrets are replaced by a mark."""
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces packed into sequences of 2048."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), width=2048, end_id=0)


STAGES = [
    ("language", keep_recognised),
    ("near_duplicates", keep_one_of_each_group),
    ("repeats", cut_repeats),
    ("secrets", hide_secrets),
    ("packing", pack),
]

#: No SQL: classifiers, signatures and tokenizers can't be said in it. Tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents; each result is stored before the next reads it."""
    docs = table(configure(spark), sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
