"""Second-stage ranking and fusion of ranked lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from rankloom.operators.keyword import SCALE, top_k

RERANK_DEPTH = 50
RRF_K = 60  # constant of the published formula


def rerank(ranked: DataFrame, scorer: Column, depth: int = RERANK_DEPTH) -> DataFrame:
    """Reorder the first ``depth`` rows of every query by ``scorer``.

    Ties keep the first-stage order. Rows below ``depth`` follow unchanged and
    have no ``reranker_score``; the scorer sees only the rows above it.
    """
    inside = F.col("rank") <= depth
    order = W.partitionBy("query_id").orderBy(
        F.col("reranker_score").desc_nulls_last(), F.col("rank")
    )
    return (
        ranked.withColumn("reranker_score", F.when(inside, F.round(scorer, SCALE)))
        .withColumn("new_rank", F.row_number().over(order))
        .drop("rank")
        .withColumnRenamed("new_rank", "rank")
    )


def term_coverage() -> Column:
    """Default scorer: weight and idf of the query terms a document holds per field."""
    return F.col("coverage")


def fuse(lists: list[DataFrame], top: int = 10, k: int = RRF_K) -> DataFrame:
    """Reciprocal rank fusion of ranked lists ``query_id, id, rank``."""
    stacked = None
    for ranked in lists:
        part = ranked.select("query_id", "id", "rank")
        stacked = part if stacked is None else stacked.unionByName(part)
    fused = stacked.groupBy("query_id", "id").agg(
        F.round(F.sum(1.0 / (k + F.col("rank"))), SCALE + 2).alias("score")
    )
    return top_k(fused, top)
