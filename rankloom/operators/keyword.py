"""Keyword retrieval: BM25 over several weighted fields, top-k per query."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from rankloom.functions.dates import age_days
from rankloom.functions.text import tokens
from rankloom.operators.postings import WHOLE, document_postings, restrict_terms, term_statistics
from rankloom.session import settled

K1 = 1.2
B = 0.75
SCALE = 6  # decimals kept before ranking, so that ties are ties everywhere
MATCHES_PER_TASK = 4_000_000  # postings met by query terms; a task holds no more pairs than that


def query_terms(queries: DataFrame, text: str = "query", term_of=None) -> DataFrame:
    """``query_id, term, weight`` with the number of occurrences as weight."""
    terms = queries.select("query_id", F.explode(tokens(text)).alias("term"))
    if term_of is not None:
        terms = terms.withColumn("term", term_of(F.col("term")))
    return terms.groupBy("query_id", "term").agg(F.count(F.lit(1)).cast("double").alias("weight"))


def idf(n_docs, df) -> Column:
    return F.log(1 + (n_docs - df + 0.5) / (df + 0.5))


def bm25_gain(tf, length, mean_length) -> Column:
    """The term-frequency part of BM25."""
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean_length))


def weighted_query_terms(
    terms: DataFrame, statistics: DataFrame, weights: Mapping[str, float]
) -> DataFrame:
    """Query terms with everything scoring needs:
    ``query_id, field, term, weight, idf, mean_len``, and ``df``.

    Terms no document holds disappear here.
    """
    totals = statistics.where(F.col("term") == WHOLE).select(
        "field", F.col("df").alias("n_docs"), (F.col("total_len") / F.col("df")).alias("mean_len")
    )
    # The totals have one row per field.
    per_term = statistics.where(F.col("term") != WHOLE).join(F.broadcast(totals), "field")
    boost = F.lit(None).cast("double")
    for name, value in weights.items():
        boost = F.when(F.col("field") == name, F.lit(float(value))).otherwise(boost)
    return terms.join(per_term, "term").select(
        "query_id",
        "field",
        "term",
        (F.col("weight") * boost).alias("weight"),
        idf(F.col("n_docs"), F.col("df")).alias("idf"),
        "mean_len",
        "df",
    )


def scoring_tasks(terms: DataFrame, per_task: int | None = None) -> int:
    """Tasks that score about ``per_task`` (``MATCHES_PER_TASK``) matches each, one per core at least.

    ``terms`` has a row with the matches ``df`` per query and term, as :func:`weighted_query_terms` gives.
    """
    matches = terms.agg(F.sum("df")).first()[0] or 0
    return max(terms.sparkSession.sparkContext.defaultParallelism, -(-matches // (per_task or MATCHES_PER_TASK)))


def score_pairs(
    postings: DataFrame, terms: DataFrame, placed: bool = False, tasks: int | None = None
) -> DataFrame:
    """``query_id, id, score, coverage`` of every document with a query term.

    Postings are brought together by document unless they are ``placed`` so (a bucketed
    table). Where the query terms are small enough to be broadcast, sums and the first cut
    of a top-k then need no shuffle of pairs; otherwise the join is by term, and the
    postings of a frequent term are split by the adaptive join. The pairs of a task grow with
    its postings times the queries, which Spark cannot see when it chooses partitions by the
    size of the postings: ``tasks`` (from :func:`scoring_tasks`) fixes their number.

    ``coverage`` sums weight and idf of the matched terms, without frequencies.
    """
    if not placed:
        postings = postings.repartition(*([] if tasks is None else [tasks]), "id")
    gain = F.col("weight") * F.col("idf")
    return postings.join(terms, ["field", "term"]).groupBy("query_id", "id").agg(
        F.sum(gain * bm25_gain(F.col("tf"), F.col("len"), F.col("mean_len"))).alias("score"),
        F.sum(gain).alias("coverage"),
    )


def top_k(scored: DataFrame, k: int, score: str = "score", by=("query_id",)) -> DataFrame:
    """The ``k`` best rows per query with ``rank``; ties go to the smaller id.

    The filter on the rank lets Spark drop rows before the shuffle, so a hot
    query moves at most ``k`` rows per task.
    """
    order = W.partitionBy(*by).orderBy(F.col(score).desc_nulls_last(), F.col("id"))
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def keyword_search(
    docs: DataFrame,
    terms: DataFrame,
    fields: Mapping[str, Column | str],
    top: int | None = 10,
    weights: Mapping[str, float] | None = None,
    id_col: str = "id",
    term_of=None,
    adjust: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Best documents per query: ``query_id, id, score, coverage, rank``.

    ``terms`` is the output of :func:`query_terms` or an expansion of it. ``adjust``
    maps the scored pairs to scored pairs, for example to favour fresh documents.
    ``top=None`` returns all scored pairs without a rank.

    The documents are read once: the postings of the asked words are kept as a table
    that gives the statistics and the scores.
    """
    terms = settled(terms)
    postings = settled(document_postings(docs, fields, id_col, term_of, _asked_words(terms)))
    weights = weights or {name: 1.0 for name in fields}
    return _search(postings, terms, top, weights, adjust, False)


def search_postings(
    postings: DataFrame,
    terms: DataFrame,
    top: int | None = 10,
    weights: Mapping[str, float] | None = None,
    adjust: Callable[[DataFrame], DataFrame] | None = None,
    placed: bool = False,
) -> DataFrame:
    """:func:`keyword_search` over postings that exist already.

    ``placed`` says that they are laid out by document.
    """
    return _search(restrict_terms(postings, _asked_words(terms)), terms, top, weights, adjust, placed)


def _asked_words(terms: DataFrame) -> DataFrame:
    """The words of a query table and the empty term."""
    whole = terms.sparkSession.range(1).select(F.lit(WHOLE).alias("term"))
    return terms.select("term").distinct().union(whole)


def _search(postings, terms, top, weights, adjust, placed) -> DataFrame:
    # Settled, so that the join knows the size of the query side.
    weighted = settled(weighted_query_terms(terms, term_statistics(postings), weights))
    scored = score_pairs(postings, weighted, placed, None if placed else scoring_tasks(weighted))
    if adjust is not None:
        scored = adjust(scored)
    scored = scored.withColumn("score", F.round("score", SCALE))
    return scored if top is None else top_k(scored, top)


# How much of the extra boost is left after a share of the duration, by interpolation.
INTERPOLATIONS = {
    "constant": lambda share: F.when(share < 1, F.lit(1.0)).otherwise(F.lit(0.0)),
    "linear": lambda share: 1 - share,
    "quadratic": lambda share: 1 - share * share,
    "logarithmic": lambda share: 1 - F.log2(1 + share),
}


def freshness_factor(
    modified, as_of: Column, boost: float = 2.0, duration_days: int = 365, interpolation: str = "quadratic"
) -> Column:
    """``boost`` for a document of today, falling to one at ``duration_days``.

    ``interpolation`` names the form of the fall; dates ahead of ``as_of`` count as today.
    """
    if interpolation not in INTERPOLATIONS:
        raise ValueError(f"no interpolation named {interpolation!r}; there are {', '.join(INTERPOLATIONS)}")
    share = F.least(F.greatest(age_days(modified, as_of) / duration_days, F.lit(0.0)), F.lit(1.0))
    return 1 + (boost - 1) * INTERPOLATIONS[interpolation](share)


def freshness_boost(
    dates: DataFrame, as_of: Column, boost: float = 2.0, duration_days: int = 365, interpolation: str = "quadratic"
) -> Callable[[DataFrame], DataFrame]:
    """The freshness factor over ``dates(id, lastModified)`` as a step of a search.

    Documents without a date keep their score.
    """
    factor = freshness_factor(F.col("lastModified"), as_of, boost, duration_days, interpolation)

    def apply(scored: DataFrame) -> DataFrame:
        factors = dates.select("id", factor.alias("factor"))
        return (
            scored.join(factors, "id", "left")
            .withColumn("score", F.col("score") * F.coalesce("factor", F.lit(1.0)))
            .drop("factor")
        )

    return apply


def project_results(ranked: DataFrame, docs: DataFrame, id_col: str = "id") -> DataFrame:
    """Result rows with ``title`` and ``url`` of their document added.

    ``ranked`` should be settled: Spark then knows its size and reads the document table in
    place when it is small.
    """
    shown = docs.select(F.col(id_col).alias("id"), "title", "url")
    return shown.join(ranked, "id").withColumn("curated", F.lit(False))
