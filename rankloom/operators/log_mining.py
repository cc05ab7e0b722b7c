"""Queries of the log that found nothing or little."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rankloom.functions.text import collapse_ends

LOW_THRESHOLD = 3


def _results() -> Column:
    return F.coalesce(F.col("num_results"), F.lit(0))


def _query() -> Column:
    return collapse_ends(F.coalesce(F.col("query"), F.lit("")))


def _is_zero() -> Column:
    return _results() == 0


def _is_low(threshold: int) -> Column:
    return (_results() > 0) & (_results() < threshold)


def query_counts(log: DataFrame, condition: Column) -> DataFrame:
    """``query, count`` of the matching rows, blank queries left out.

    ``first_pos`` tells where a query was first seen, if the log carries ``pos``.
    """
    matching = log.where(condition).withColumn("query", _query()).where(F.col("query") != "")
    first = [F.min("pos").alias("first_pos")] if "pos" in log.columns else []
    return matching.groupBy("query").agg(F.count(F.lit(1)).alias("count"), *first)


def zero_result_queries(log: DataFrame) -> DataFrame:
    return query_counts(log, _is_zero())


def low_result_queries(log: DataFrame, threshold: int = LOW_THRESHOLD) -> DataFrame:
    return query_counts(log, _is_low(threshold))


def most_common(counts: DataFrame, limit: int | None = 10) -> DataFrame:
    """By count, ties in first-seen order (by text when the log has no order)."""
    ties = "first_pos" if "first_pos" in counts.columns else "query"
    ordered = counts.orderBy(F.col("count").desc(), ties)
    return ordered if limit is None else ordered.limit(limit)


def log_totals(log: DataFrame, threshold: int = LOW_THRESHOLD) -> DataFrame:
    """One row: all log rows, unique zero-result queries, unique low-result queries.

    Rows are first summed per query, so the distinct counts need no second shuffle
    and one very frequent query no large group.
    """
    per_query = (
        log.withColumn("query", _query())
        .groupBy("query")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max(_is_zero()).alias("zero"),
            F.max(_is_low(threshold)).alias("low"),
        )
    )
    named = F.col("query") != ""
    return per_query.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_queries"),
        F.count_if(named & F.col("zero")).alias("zero_result_queries"),
        F.count_if(named & F.col("low")).alias("low_result_queries"),
    )
