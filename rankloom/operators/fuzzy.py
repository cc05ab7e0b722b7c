"""One-edit term matching and the fuzzy retry of queries without results."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rankloom.functions.text import allowed_edits, case_tokens, edits_up_to_one, one_edit_keys, tokens


def one_edit_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """``term, match, edits`` for all pairs of ``left(term)`` and ``right(term)`` that
    are at most one edit apart.

    Both sides hold distinct terms. They meet on shared keys (see
    :func:`rankloom.functions.text.one_edit_keys`), whose size grows with the length of
    the words and not its square; the distance is then verified.
    """
    left_keys = left.select("term", F.explode(one_edit_keys("term", probing=True)).alias("key"))
    right_keys = right.select(F.col("term").alias("match"), F.explode(one_edit_keys("term", probing=False)).alias("key"))
    pairs = right_keys.join(left_keys, "key").select("term", "match").distinct()
    return pairs.withColumn("edits", edits_up_to_one("term", "match")).where(F.col("edits") >= 0)


def fuzzy_query_tokens(queries: DataFrame, text: str = "query") -> DataFrame:
    """``query_id, token, max_edits``: words that stay exact and words that may differ."""
    raw = queries.select("query_id", F.explode(case_tokens(text)).alias("raw")).withColumn(
        "max_edits", allowed_edits("raw")
    )
    # A token that stays exact is analysed like any text, so it may split.
    return raw.select("query_id", F.explode(tokens("raw")).alias("token"), "max_edits")


def fuzzy_query_terms(queries: DataFrame, vocabulary: DataFrame, text: str = "query") -> DataFrame:
    """Query terms for an any-term search with one edit: ``query_id, term, weight``.

    A term that differs by one edit counts ``1 - 1/length`` of the shorter word;
    of several tokens that reach one term the best counts.
    """
    words = fuzzy_query_tokens(queries, text)
    exact = words.select("query_id", F.col("token").alias("term"), F.lit(1.0).alias("weight"))
    loose = words.where(F.col("max_edits") > 0)
    pairs = one_edit_pairs(
        loose.select(F.col("token").alias("term")).distinct(), vocabulary.select("term")
    ).where(F.col("edits") > 0)
    near = loose.join(pairs, loose["token"] == pairs["term"]).select(
        "query_id",
        F.col("match").alias("term"),
        (1 - F.col("edits") / F.least(F.length("token"), F.length("match"))).alias("weight"),
    )
    return exact.unionByName(near).groupBy("query_id", "term").agg(F.max("weight").alias("weight"))


def without_results(queries: DataFrame, results: DataFrame) -> DataFrame:
    """The queries that have no row in ``results``."""
    return queries.join(results.select("query_id").distinct(), "query_id", "left_anti")


def with_fallback(results: DataFrame, retry: DataFrame | None) -> DataFrame:
    """Primary rows, and the rows of the fuzzy retry marked ``fuzzy``."""
    primary = results.withColumn("fallback", F.lit(None).cast("string"))
    if retry is None:
        return primary
    return primary.unionByName(retry.withColumn("fallback", F.lit("fuzzy")))
