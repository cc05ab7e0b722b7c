"""Compound words cut into known words, with linking letters between them."""

from __future__ import annotations

from collections import defaultdict

import pandas as pd
from pyspark.sql import DataFrame, functions as F

MIN_PART = 4
MAX_PART = 30

# Letters that may stand between two parts, per language (fixed values).
LINKING = {
    "nl": ("s", "e", "en"),
    "de": ("s", "es", "n", "en", "er", "e"),
    "en": (),
    "fr": (),
    "es": (),
}


def known_stretches(vocabulary: DataFrame, min_part: int = MIN_PART, max_part: int = MAX_PART) -> DataFrame:
    """``term, stretches(start, size, word)``: where shorter known words may stand in a term.

    Only stretches that leave nothing or room for a part on either side are looked up,
    by equality. A part has at most ``max_part`` characters, so the rows per term grow
    with its length and not its square; they carry a hash instead of the term. Where
    two terms share a hash each is given the stretches of both.
    """
    keyed = vocabulary.select("term", F.xxhash64("term").alias("key"), F.length("term").alias("length"))
    starts = (
        keyed.where(F.col("length") >= 2 * min_part)
        .select("term", "key", "length", F.explode(F.sequence(F.lit(0), F.col("length") - min_part)).alias("start"))
        .where((F.col("start") == 0) | (F.col("start") >= min_part))
        .select(
            "key",
            "length",
            "start",
            (F.col("length") - F.col("start")).alias("rest"),
            F.substr("term", F.col("start") + 1, F.lit(max_part)).alias("ahead"),
        )
    )
    size, rest = F.col("size"), F.col("rest")
    cut = (
        starts.select(
            "*", F.explode(F.sequence(F.lit(min_part), F.least("rest", F.lit(max_part)))).alias("size")
        )
        .where((size < F.col("length")) & ((size == rest) | (size <= rest - min_part)))
        .select("key", "start", "size", F.substr("ahead", F.lit(1), size).alias("word"))
    )
    words = vocabulary.where(F.length("term").between(min_part, max_part)).select(F.col("term").alias("word"))
    # A term is there once and has a bounded number of stretches per character.
    stretches = (
        cut.join(words, "word", "left_semi")
        .groupBy("key")
        .agg(F.sort_array(F.collect_set(F.struct("start", "size", "word"))).alias("stretches"))
    )
    return keyed.join(stretches, "key").select("term", "stretches")


def _fewest(term: str, stretches, links: tuple[str, ...]) -> list[str]:
    """The words on all ways through ``term`` that use the fewest words."""
    end = len(term)
    steps = []  # (start, next start, word), ordered by start
    for stretch in stretches:
        start, word = stretch["start"], stretch["word"]
        after = start + len(word)
        if not term.startswith(word, start):  # of another term with the same hash
            continue
        steps.append((start, after, word))
        steps += [(start, after + len(x), word) for x in links if term.startswith(x, after) and after + len(x) < end]
    to, of = defaultdict(lambda: end + 1), defaultdict(lambda: end + 1)
    to[0], of[end] = 0, 0
    for start, after, _ in steps:
        to[after] = min(to[after], to[start] + 1)
    for start, after, _ in reversed(steps):
        of[start] = min(of[start], of[after] + 1)
    if of[0] > end:
        return []
    return sorted({word for start, after, word in steps if to[start] + 1 + of[after] == of[0]})


def compound_parts(
    vocabulary: DataFrame,
    min_part: int = MIN_PART,
    links: tuple[str, ...] = (),
    max_part: int = MAX_PART,
) -> DataFrame:
    """``term, part`` for terms that are two or more known words written together.

    Between two words one of ``links`` may stand. Of all ways to cut a term those with
    the fewest words count, and all of these where several tie. Parts have ``min_part``
    to ``max_part`` characters; a term is never its own part. ``vocabulary(term)`` holds
    distinct terms.
    """

    @F.pandas_udf("array<string>")
    def parts(terms: pd.Series, stretches: pd.Series) -> pd.Series:
        return pd.Series([_fewest(t, s, links) for t, s in zip(terms, stretches)], dtype="object")

    known = known_stretches(vocabulary, min_part, max_part)
    return known.select("term", F.explode(parts("term", "stretches")).alias("part"))


def add_parts(terms: DataFrame, parts: DataFrame) -> DataFrame:
    """Term rows followed by rows for the parts of compounds among them.

    Works on query terms (``query_id, term, weight``); a part that is a term of the
    query already is not added twice.
    """
    extra = terms.join(parts, "term").select(
        "query_id", F.col("part").alias("term"), "weight"
    )
    return terms.unionByName(extra).groupBy("query_id", "term").agg(F.max("weight").alias("weight"))


def posting_parts(postings: DataFrame, parts: DataFrame) -> DataFrame:
    """Postings that also list a document under the parts of its compounds."""
    extra = postings.join(parts, "term").drop("term").withColumnRenamed("part", "term")
    return (
        postings.unionByName(extra.select(*postings.columns))
        .groupBy("id", "field", "len", "term")
        .agg(F.sum("tf").alias("tf"))
    )
