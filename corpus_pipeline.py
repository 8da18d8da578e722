"""A training-text pipeline over ``documents``: each stage applies one operator of ``tidemark.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, language, packing, simhash, toxicity
from tidemark.llm.common import load
from tidemark.session import scratch_path

ORACLE_SQL = None  # learned stages and tokens are beyond SQL; tests compare with brute force


def identify_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents of no identifiable language go."""
    return language.keep_identified(docs)


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents predicted toxic go."""
    return toxicity.keep_clean(docs, load(spark, folder, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each SimHash component stays: the one with the smallest id."""
    return simhash.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return decontaminate.remove(docs, load(spark, folder, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The token ids of what is left, packed into sequences."""
    return packing.pack(docs, packing.default_vocabulary())


STAGES = [
    ("language", identify_language),
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = load(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, folder)
