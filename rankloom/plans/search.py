"""A table of queries against a table of documents, end to end."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, functions as F

from rankloom.functions.text import stem
from rankloom.operators.compounds import add_parts
from rankloom.operators.curation import match_best_bets, pin
from rankloom.operators.fuzzy import fuzzy_query_terms, with_fallback, without_results
from rankloom.operators.keyword import (
    freshness_boost,
    keyword_search,
    project_results,
    query_terms,
)
from rankloom.operators.postings import vocabulary
from rankloom.operators.rerank import RERANK_DEPTH, fuse, rerank, term_coverage
from rankloom.operators.synonyms import expand_queries
from rankloom.operators.vectors import knn
from rankloom.session import settled
from rankloom.sources.profiles import ScoringProfile

MODES = ("keyword", "semantic", "hybrid")


@dataclass
class Index:
    """What a variant searches with.

    The baseline has plain fields only. The tuned variant adds any of: a language
    for stemming, synonym rules, compound parts, a scoring profile, vectors.
    """

    docs: DataFrame
    fields: Mapping[str, Column | str] = field(
        default_factory=lambda: {
            "title": F.col("title"),
            "body": F.col("body"),
            "tags": F.concat_ws(" ", "tags"),
        }
    )
    language: str | None = None
    rules: DataFrame | None = None
    parts: DataFrame | None = None
    profile: ScoringProfile | None = None
    as_of: Column | None = None
    vectors: DataFrame | None = None

    @property
    def modes(self) -> tuple[str, ...]:
        """The modes worth comparing: reranking needs some tuning, fusion needs vectors."""
        tuned = any(part is not None for part in (self.language, self.rules, self.parts, self.profile))
        able = {"keyword": True, "semantic": tuned, "hybrid": tuned and self.vectors is not None}
        return tuple(mode for mode, possible in able.items() if possible)

    @property
    def term_of(self) -> Callable[[Column], Column] | None:
        return (lambda t: stem(t, self.language)) if self.language else None

    def terms(self, queries: DataFrame) -> DataFrame:
        """Analysed query terms: synonyms, then compound parts, then stems."""
        terms = (
            query_terms(queries)
            if self.rules is None
            else expand_queries(queries, self.rules).drop("synonym")
        )
        if self.parts is not None:
            terms = add_parts(terms, self.parts)
        return self.analysed(terms)

    def analysed(self, terms: DataFrame) -> DataFrame:
        if self.term_of is None:
            return terms
        return (
            terms.withColumn("term", self.term_of(F.col("term")))
            .groupBy("query_id", "term")
            .agg(F.sum("weight").alias("weight"))
        )

    def search(self, terms: DataFrame, top: int | None) -> DataFrame:
        weights = {name: 1.0 for name in self.fields}
        adjust = None
        if self.profile is not None:
            weights |= {k: v for k, v in self.profile.weights.items() if k in weights}
            fresh = self.profile.freshness
            if fresh is not None and self.as_of is None:
                raise ValueError("a profile with freshness needs as_of")
            if fresh is not None:
                dates = self.docs.select("id", F.col(fresh.field).alias("lastModified"))
                adjust = freshness_boost(dates, self.as_of, fresh.boost, fresh.duration_days, fresh.interpolation)
        return keyword_search(
            self.docs, terms, self.fields, top, weights, term_of=self.term_of, adjust=adjust
        )


class FirstStage:
    """What the modes of one index share: the keyword ranking and the fuzzy retry of a query table.

    Both are computed when first asked for and kept as tables. The ranking is as deep as
    the deepest mode needs, so a shorter one is its beginning.
    """

    def __init__(self, index: Index, queries: DataFrame, top: int):
        self.index, self.queries, self.top = index, queries, top

    @cached_property
    def ranked(self) -> DataFrame:
        return settled(self.index.search(self.index.terms(self.queries), max(self.top, RERANK_DEPTH)))

    @cached_property
    def retry(self) -> DataFrame | None:
        """Rows of the fuzzy search for the queries without a row; none when all have some."""
        empty = without_results(self.queries, self.ranked)
        if empty.isEmpty():
            return None
        words = vocabulary(self.index.docs, self.index.fields)
        terms = self.index.analysed(fuzzy_query_terms(empty, words))
        found = self.index.search(terms, self.top).withColumn("reranker_score", F.lit(None).cast("double"))
        return settled(found.select(*RANKED))


RANKED = ["query_id", "id", "score", "reranker_score", "rank"]


def base_results(
    stage: FirstStage, mode: str, query_vectors: DataFrame | None = None, scorer: Column | None = None
) -> DataFrame:
    """Rows of one retrieval mode before fallback and pinning."""
    scorer = term_coverage() if scorer is None else scorer
    if mode == "keyword":
        found = stage.ranked.withColumn("reranker_score", F.lit(None).cast("double"))
    elif mode == "semantic":
        found = rerank(stage.ranked, scorer)
    elif mode == "hybrid":
        if stage.index.vectors is None or query_vectors is None:
            raise ValueError("hybrid needs vectors of documents and queries")
        by_vector = knn(stage.index.vectors, query_vectors, stage.top)
        fused = fuse([stage.ranked, by_vector], max(stage.top, RERANK_DEPTH))
        coverage = stage.ranked.select("query_id", "id", "coverage")
        found = rerank(fused.join(coverage, ["query_id", "id"], "left"), scorer)
    else:
        raise ValueError(f"queries run as keyword, semantic or hybrid, not as {mode!r}")
    return found.where(F.col("rank") <= stage.top)


def run_queries(
    index: Index,
    queries: DataFrame,
    mode: str = "keyword",
    top: int = 10,
    bets: DataFrame | None = None,
    query_vectors: DataFrame | None = None,
    scorer: Column | None = None,
    stage: FirstStage | None = None,
) -> DataFrame:
    """Final rows of every query: base, fuzzy retry, pinned page, cap.

    ``queries`` holds ``query_id, query``; ``bets`` are keyed best bets, or none to
    leave curation out. The fuzzy retry serves keyword and semantic queries that
    found nothing. Several modes of one index share a ``stage``.
    """
    mode = mode.lower()
    stage = FirstStage(index, queries, top) if stage is None else stage
    rows = settled(base_results(stage, mode, query_vectors, scorer).select(*RANKED))
    retry = stage.retry if mode in ("keyword", "semantic") else None
    shown = project_results(with_fallback(rows, retry), index.docs)
    if bets is None:
        return shown.withColumn("note", F.lit(None).cast("string"))
    return pin(shown, match_best_bets(queries, bets), top)


def query_outcomes(queries: DataFrame, base: DataFrame, mode: str, matches: DataFrame | None) -> DataFrame:
    """``query_id, query, curated, fallback`` as the query log records them.

    The fallback is recorded for every keyword or semantic query whose base search
    found nothing, whether or not the retry did.
    """
    found = base.select("query_id").distinct().withColumn("found", F.lit(True))
    out = queries.join(found, "query_id", "left").withColumn(
        "fallback",
        F.when(F.col("found").isNull() & F.lit(mode in ("keyword", "semantic")), F.lit("fuzzy")),
    )
    if matches is None:
        return out.select("query_id", "query", F.lit(False).alias("curated"), "fallback")
    pinned = matches.select("query_id", F.lit(True).alias("curated"))
    return out.join(pinned, "query_id", "left").select(
        "query_id", "query", F.coalesce("curated", F.lit(False)).alias("curated"), "fallback"
    )
