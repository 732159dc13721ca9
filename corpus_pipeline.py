"""A corpus pipeline of the operators: each stage reads what the one before has written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmart.llm.common import staged, table
from tripmart.llm.decontamination import clean_documents
from tripmart.llm.mixing import mixed
from tripmart.llm.ngram_join import one_of_each
from tripmart.llm.quality import good_documents
from tripmart.llm.sharding import shard_rows


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field, fitted on ``labels``, scores as good."""
    return good_documents(docs, table(spark, sf_dir, "labels"))


def join_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of similar documents."""
    return one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in the order of the mix."""
    return mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard and its slot there."""
    return shard_rows(docs)


STAGES = [
    ("quality_classifier", classify_quality),
    ("ngram_jaccard_join", join_near_copies),
    ("benchmark_decontamination", decontaminate),
    ("source_mix", mix_sources),
    ("sharding", shard),
]

# The classifier's training and the MinHash signatures are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
