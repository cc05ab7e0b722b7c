"""A training corpus from raw documents: filter, deduplicate, decontaminate, mix and shard.

Every stage works on all rows its predecessor kept and is written as Parquet before
the next one reads it, so a lost executor repeats at most one stage's tasks. Rows keep
their columns, whatever these are called, up to the last stage. Null and empty texts have no words, so
the quality rules drop them; null ids, repeated rows and empty tables go through every
stage as its operator says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rankloom.llm import containment, mixing, parity, quality, sharding
from rankloom.session import prepare, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the current policy."""
    return quality.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of similar documents."""
    return parity.one_per_component(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return containment.decontaminated(docs, prepare(spark).read.parquet(f"{sf_dir}/benchmark.parquet"))


def domain_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target shares of the domains ask for."""
    return mixing.mixed_documents(docs, prepare(spark).read.parquet(f"{sf_dir}/labels.parquet"))


def hilbert_sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every remaining document."""
    return sharding.hilbert_shards(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("domain_mixture", domain_mixture),
    ("hilbert_sharding", hilbert_sharding),
]

# The fitted classifier and rates can't be expressed in SQL. Tests hold near duplicates and
# decontamination against brute force, the mixture against the copies drawn; the SQL of
# op6 covers the quality rules.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
