"""Every configuration against every judged query."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from rankloom.operators.metrics import config_metrics, query_metrics
from rankloom.plans.search import FirstStage, Index, run_queries
from rankloom.session import settled


@dataclass(frozen=True)
class Config:
    name: str
    variant: str
    mode: str


def comparisons(indexes: Mapping[str, Index]) -> list[Config]:
    """A configuration for every mode that each variant's index can do."""
    return [Config(f"{variant}-{mode}", variant, mode) for variant, index in indexes.items() for mode in index.modes]


def judged_queries(judgments: DataFrame) -> DataFrame:
    """``query_id, query``: the judged texts with numbers, which are lighter than texts in every pair of a search.

    The numbers hold for one computation, so the table has to be settled.
    """
    return judgments.select("query").distinct().select(F.monotonically_increasing_id().alias("query_id"), "query")


def evaluate(
    indexes: dict[str, Index],
    judgments: DataFrame,
    configs: list[Config],
    top: int = 10,
    bets: DataFrame | None = None,
    query_vectors: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Metrics per configuration and per query; best bets count only when given.

    The configurations of a variant share its keyword ranking and its fuzzy retry. The
    ``query_id`` of ``query_vectors`` is the text of a query.
    """
    queries = settled(judged_queries(judgments))
    if query_vectors is not None:
        query_vectors = query_vectors.withColumnRenamed("query_id", "query").join(queries, "query").drop("query")
    stages = {c.variant: FirstStage(indexes[c.variant], queries, top) for c in configs}
    results = None
    for config in configs:
        rows = run_queries(
            indexes[config.variant], queries, config.mode, top, bets, query_vectors, stage=stages[config.variant]
        ).select(F.lit(config.name).alias("config"), F.col("query_id").alias("query"), "id", "url", "rank")
        results = rows if results is None else results.unionByName(rows)
    names = [c.name for c in configs]
    numbered = judgments.withColumnRenamed("query", "text").join(queries, F.col("text").eqNullSafe(F.col("query")))
    numbered = numbered.select(F.col("query_id").alias("query"), "intended_id", "relevance")
    by_number = query_metrics(results, numbered, names)
    columns = by_number.columns
    texts = queries.withColumnRenamed("query", "text")
    named = by_number.join(texts, F.col("query") == F.col("query_id")).withColumn("query", F.col("text"))
    per_query = settled(named.select(*columns))
    return config_metrics(per_query), per_query
