"""The corpus pipeline: language, near copies, repeated passages, mixture, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seqtables.llm import jaccard, langid, mixing, packing, suffixes
from seqtables.llm.common import documents, saved


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages the labels name; texts without letters and unknown languages go."""
    return langid.accepted(docs, langid.fit(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by five-word shingles the one with the least id."""
    return jaccard.representatives(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 50 words or more that stand in a document before."""
    return suffixes.without_repeats(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that the sources meet their target weights."""
    return mixing.mixed_documents(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.pack(docs)


STAGES = [
    ("language", language),
    ("near_copies", near_copies),
    ("repeated_passages", repeated_passages),
    ("mixture", mixture),
    ("sequences", sequences),
]

#: Language filters, near copies and token ids are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
