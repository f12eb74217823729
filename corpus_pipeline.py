"""The corpus pipeline: five stages over ``documents``, each calling one operator.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame that is written as
Parquet and read again as the next stage's input. Rows that a stage rejects are gone
for the stages after it; all but the last return the columns of ``docs``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.llm import decontaminate, language_id, mixing, sharding, simhash
from tokenmill.llm.common import materialise, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in an identified language; null texts and texts without a letter go."""
    return language_id.reject_unidentified(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the smallest doc_id."""
    return simhash.drop_near_duplicates(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix to target weights; a document of a small source may occur up to three times."""
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix with ``slot`` and ``shard``."""
    return sharding.assign_shards(docs, sharding.document_key(F.col("doc_id"), F.col("text")))


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_copies),
    ("benchmark_decontamination", decontaminate_benchmark),
    ("source_mixing", mix),
    ("sharding", shard),
]

#: Language ID and SimHash cannot be expressed in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
