"""Best bets: pin a known page above the ranked results."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from rankloom.functions.text import keys_of_normalised, normalise


def match_best_bets(queries: DataFrame, keyed: DataFrame, text: str = "query") -> DataFrame:
    """``query_id`` with the entry it is pinned to; at most one row per query.

    ``keyed`` comes from :func:`rankloom.sources.best_bets.bet_keys`. The spaced
    form of the query is tried before the form without spaces.
    """
    attempts = queries.select("query_id", normalise(text).alias("spaced")).select(
        "query_id", F.posexplode(keys_of_normalised("spaced")).alias("attempt", "key")
    )
    hits = attempts.join(keyed, "key")
    bet = F.struct("id", "title", "url", "note")
    return (
        hits.groupBy("query_id").agg(F.min_by(bet, "attempt").alias("bet")).select("query_id", "bet.*")
    )


def pin(results: DataFrame, matches: DataFrame, top: int = 10) -> DataFrame:
    """Matched entries first, their id removed below, every list capped at ``top``.

    ``results`` holds ``query_id, id, title, url, score, reranker_score, rank`` and
    maybe more. Pinned rows have no scores, ``curated`` set and a ``note``.
    """
    pinned_ids = matches.select("query_id", F.col("id").alias("pinned_id"))
    kept = (
        results.join(pinned_ids, "query_id", "left")
        .where(F.col("pinned_id").isNull() | ~F.col("id").eqNullSafe(F.col("pinned_id")))
        .drop("pinned_id")
        .withColumn("curated", F.lit(False))
        .withColumn("note", F.lit(None).cast("string"))
    )
    pinned = matches.select(
        "query_id",
        "id",
        "title",
        "url",
        F.lit(None).cast("double").alias("score"),
        F.lit(None).cast("double").alias("reranker_score"),
        F.lit(0).alias("rank"),
        F.lit(True).alias("curated"),
        "note",
    )
    order = W.partitionBy("query_id").orderBy("rank")
    return (
        kept.unionByName(pinned, allowMissingColumns=True)
        .withColumn("position", F.row_number().over(order))
        .where(F.col("position") <= top)
        .drop("rank")
        .withColumnRenamed("position", "rank")
    )
