"""Graded ranking metrics per query and per configuration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from rankloom.session import settled

METRIC_DEPTH = 10
SCALE = 6


def grade_map(judgments: DataFrame) -> DataFrame:
    """``query, intended_id, grade``: the best grade of every judged pair."""
    return judgments.groupBy("query", F.col("intended_id").cast("string").alias("intended_id")).agg(
        F.max("relevance").alias("grade")
    )


def representative(grades: DataFrame) -> DataFrame:
    """``query, intended_id``: the best judged document, ties to the larger id."""
    return grades.groupBy("query").agg(
        F.max(F.struct("grade", "intended_id")).alias("best")
    ).select("query", F.col("best.intended_id").alias("intended_id"))


def graded_results(results: DataFrame, grades: DataFrame) -> DataFrame:
    """Result rows with ``grade``: judged by id, else by url, else zero.

    A document judged zero by id is not looked up by url.
    """
    by_id = grades.select("query", F.col("intended_id").alias("id_key"), F.col("grade").alias("id_grade"))
    keyed = results.withColumn("id_key", F.col("id").cast("string")).join(
        by_id, ["query", "id_key"], "left"
    )
    if "url" not in results.columns:
        return keyed.withColumn("grade", F.coalesce("id_grade", F.lit(0))).drop("id_key", "id_grade")
    by_url = grades.select("query", F.col("intended_id").alias("url"), F.col("grade").alias("url_grade"))
    return (
        keyed.join(by_url, ["query", "url"], "left")
        .withColumn("grade", F.coalesce("id_grade", "url_grade", F.lit(0)))
        .drop("id_key", "id_grade", "url_grade")
    )


def discounted_gain(grade, rank) -> Column:
    return (F.pow(F.lit(2.0), grade) - 1) / F.log2(rank + 1.0)


def ideal_gain(grades: DataFrame, k: int = METRIC_DEPTH) -> DataFrame:
    """``query, ideal``: the gain of the ``k`` best grades in the best order."""
    order = W.partitionBy("query").orderBy(F.col("grade").desc(), "intended_id")
    return (
        grades.where(F.col("grade") > 0)
        .withColumn("ideal_rank", F.row_number().over(order))
        .where(F.col("ideal_rank") <= k)
        .groupBy("query")
        .agg(F.sum(discounted_gain(F.col("grade"), F.col("ideal_rank"))).alias("ideal"))
    )


def query_metrics(
    results: DataFrame, judgments: DataFrame, configs: Sequence[str], k: int = METRIC_DEPTH
) -> DataFrame:
    """``config, query, intended_id, rank, num_results, ndcg_at_10`` for every judged
    query under every configuration.

    ``results`` holds ``config, query, id[, url], rank``. Queries without results
    stay, with no rank and zero gain.

    The grades are computed once, and only those of pairs that have a result move to the
    results.
    """
    grades = settled(grade_map(judgments))
    results = settled(results)
    judged = (
        representative(grades)
        .join(ideal_gain(grades, k), "query", "left")
        .withColumn("config", F.explode(F.array(*[F.lit(c) for c in configs])))
    )
    shown = results.select("query", F.col("id").cast("string").alias("intended_id"))
    if "url" in results.columns:
        shown = shown.union(results.select("query", "url"))
    graded = graded_results(results, grades.join(shown.distinct(), ["query", "intended_id"], "left_semi"))
    found = graded.groupBy("config", "query").agg(
        F.min(F.when(F.col("grade") >= 1, F.col("rank"))).alias("rank"),
        F.count(F.lit(1)).alias("num_results"),
        F.sum(
            F.when(F.col("rank") <= k, discounted_gain(F.col("grade"), F.col("rank"))).otherwise(0.0)
        ).alias("gain"),
    )
    ndcg = F.when(F.coalesce("ideal", F.lit(0.0)) == 0, F.lit(0.0)).otherwise(
        F.coalesce("gain", F.lit(0.0)) / F.col("ideal")
    )
    return judged.join(found, ["config", "query"], "left").select(
        "config",
        "query",
        "intended_id",
        "rank",
        F.coalesce("num_results", F.lit(0)).alias("num_results"),
        F.round(ndcg, SCALE).alias("ndcg_at_10"),
    )


def config_metrics(per_query: DataFrame) -> DataFrame:
    """One row per configuration; every judged query counts in the denominator."""

    def share(condition):
        return F.round(F.avg(F.when(condition, 1.0).otherwise(0.0)), SCALE)

    rank = F.col("rank")
    return per_query.groupBy("config").agg(
        F.count(F.lit(1)).alias("num_queries"),
        share(rank == 1).alias("success_at_1"),
        share(rank <= 3).alias("success_at_3"),
        F.round(F.avg(F.when(rank <= METRIC_DEPTH, 1.0 / rank).otherwise(0.0)), SCALE).alias("mrr_at_10"),
        F.round(F.avg("ndcg_at_10"), SCALE).alias("ndcg_at_10"),
        share(rank.isNotNull()).alias("found_rate"),
        share(F.col("num_results") == 0).alias("zero_result_rate"),
    )


def lift(metrics: DataFrame, configs: Sequence[str], baseline: str) -> DataFrame:
    """The best configuration against the baseline, or no row.

    The first of ``configs`` wins ties. There is no lift when the baseline is
    missing or is the best itself.
    """
    position = F.array_position(F.array(*[F.lit(c) for c in configs]), F.col("config"))
    is_base = F.col("config") == baseline
    best = F.max(F.struct("success_at_1", (-position).alias("pos"), "config"))
    summary = metrics.agg(
        best.alias("best"),
        F.max(F.when(is_base, F.col("success_at_1"))).alias("baseline_success_at_1"),
    )
    gain = (F.col("best.success_at_1") - F.col("baseline_success_at_1")) * 100
    return summary.where(
        F.col("baseline_success_at_1").isNotNull() & (F.col("best.config") != baseline)
    ).select(
        F.lit(baseline).alias("baseline"),
        F.col("best.config").alias("best"),
        "baseline_success_at_1",
        F.col("best.success_at_1").alias("best_success_at_1"),
        F.format_string("%+.1f", gain).alias("gain_points"),
    )
