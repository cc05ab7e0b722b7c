"""Completions and did-you-mean suggestions for a table of prefixes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from rankloom.functions.text import _col, allowed_edits, tokens
from rankloom.operators.fuzzy import one_edit_pairs
from rankloom.operators.keyword import scoring_tasks
from rankloom.operators.prefixes import prefix_matches
from rankloom.session import settled, stored

NO_CONTEXT = ""
MATCHES_PER_TASK = 1_500_000  # few matches are of the same prefix and document, so a task takes fewer than in a search


def prefix_table(prefixes: DataFrame, text: str = "prefix") -> DataFrame:
    """``prefix_id, words, last, context`` of every prefix with at least one word."""
    return (
        prefixes.select("prefix_id", tokens(text).alias("words"))
        .where(F.size("words") > 0)
        .select(
            "prefix_id",
            "words",
            F.element_at("words", -1).alias("last"),
            F.coalesce(F.try_element_at("words", F.lit(-2)), F.lit(NO_CONTEXT)).alias("context"),
        )
    )


def near_forms(wanted: DataFrame, known: DataFrame, fuzzy: bool = True) -> DataFrame:
    """``term, match, edits``: known forms equal to a wanted one or one edit away.

    Only words that may be mistyped are matched loosely.
    """
    exact = wanted.join(known, "term", "left_semi").select(
        "term", F.col("term").alias("match"), F.lit(0).alias("edits")
    )
    return exact.unionByName(_loose_forms(wanted, known)) if fuzzy else exact


def near_beginnings(wanted: DataFrame, vocabulary: DataFrame, fuzzy: bool = True) -> DataFrame:
    """``term, match, edits``: every wanted word itself, and beginnings of known words one edit away.

    Whether a known word begins with the wanted one is left to the match of ranges.
    Beginnings are made only in the lengths that one edit can reach, so their number
    grows with the distinct lengths of what is asked and not with the length of a term.
    """
    itself = wanted.select("term", F.col("term").alias("match"), F.lit(0).alias("edits"))
    if not fuzzy:
        return itself
    size = F.length("term")
    reached = wanted.where(allowed_edits("term") > 0).select(F.explode(F.sequence(size - 1, size + 1)).alias("n"))
    lengths = reached.agg(F.collect_set("n")).scalar()
    beginnings = (
        vocabulary.select("term", lengths.alias("lengths"))
        .select("term", F.explode("lengths").alias("n"))
        .where(F.col("n") <= size)
        .select(F.substr("term", F.lit(1), F.col("n")).alias("term"))
        .distinct()
    )
    return itself.unionByName(_loose_forms(wanted, beginnings))


def _loose_forms(wanted: DataFrame, known: DataFrame) -> DataFrame:
    loose = wanted.where(allowed_edits("term") > 0)
    return one_edit_pairs(loose, known).where(F.col("edits") > 0)


def suggestion_units(docs: DataFrame, fields: list, with_context: bool = True) -> DataFrame:
    """``context, term, df``: words, and word pairs where ``context`` is the word before.

    Each document counts once per unit; pairs do not cross fields.
    """
    units = []
    for field in fields:
        words = tokens(_col(field))
        units.append(
            F.transform(words, lambda t: F.struct(F.lit(NO_CONTEXT).alias("context"), t.alias("term")))
        )
        if with_context:
            units.append(
                F.zip_with(
                    F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))),
                    F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))),
                    lambda a, b: F.struct(a.alias("context"), b.alias("term")),
                )
            )
    return (
        docs.select(F.inline(F.array_distinct(F.concat(*units))))
        .groupBy("context", "term")
        .agg(F.count(F.lit(1)).alias("df"))
    )


def autocomplete(
    docs: DataFrame, fields: list, prefixes: DataFrame, top: int = 5, fuzzy: bool = True
) -> DataFrame:
    """``prefix_id, text, query_plus_text, rank``: the last word completed in context.

    Completions without an edit come first, then those in more documents. Only the
    ``top`` completions of every needed beginning are kept before they meet the
    prefixes: one below them cannot reach the result. A beginning is a range of the
    sorted words and is never written out.
    """
    wanted = prefix_table(prefixes)
    units = stored(suggestion_units(docs, fields), "units")
    # The empty context holds every word once, so it serves as vocabulary.
    words = units.where(F.col("context") == NO_CONTEXT).select("term")
    forms = near_beginnings(wanted.select(F.col("last").alias("term")).distinct(), words, fuzzy)
    asked = stored(
        wanted.select("context", F.col("last").alias("asked"))
        .distinct()
        .join(forms.withColumnRenamed("term", "asked"), "asked")
        .select("context", "asked", F.col("match").alias("start"), "edits"),
        "asked",
    )
    # A space sorts before all letters and digits, so the words after a context are one
    # range, and a beginning of them a range within it.
    in_context = lambda word: F.concat("context", F.lit(" "), word)
    completions = prefix_matches(
        asked.select(in_context("start").alias("prefix")).distinct(),
        units.select(in_context("term").alias("key"), "df"),
        top,
    ).select(
        F.substring_index("prefix", " ", 1).alias("context"),
        F.substring_index("prefix", " ", -1).alias("start"),
        F.substring_index("key", " ", -1).alias("term"),
        "df",
    )
    per_asked = (
        asked.join(completions, ["context", "start"])
        .groupBy("context", "asked", "term")
        .agg(F.min("edits").alias("edits"), F.max("df").alias("df"))
    )
    order = W.partitionBy("context", "asked").orderBy("edits", F.col("df").desc(), "term")
    ranked = per_asked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    before = F.slice("words", F.lit(1), F.size("words") - 1)
    return wanted.withColumnRenamed("last", "asked").join(ranked, ["context", "asked"]).select(
        "prefix_id",
        F.concat_ws(" ", F.nullif("context", F.lit(NO_CONTEXT)), "term").alias("text"),
        F.array_join(F.concat(before, F.array("term")), " ").alias("query_plus_text"),
        "rank",
    )


def did_you_mean(
    docs: DataFrame,
    fields: list,
    prefixes: DataFrame,
    top: int = 5,
    fuzzy: bool = True,
    id_col: str = "id",
) -> DataFrame:
    """``prefix_id, id, matched, edits, rank``: documents whose words fit the prefix.

    All words but the last must equal a word of the document, the last one must
    begin one; one edit is allowed where a word may be mistyped. Documents with
    more matched words come first, then those with fewer edits, then by id.
    """
    words = prefix_table(prefixes).select("prefix_id", F.posexplode("words").alias("pos", "term"), "words")
    asked = words.select(
        "prefix_id",
        "pos",
        "term",
        F.when(F.col("pos") == F.size("words") - 1, "start").otherwise("word").alias("kind"),
    )
    all_words = F.array_distinct(F.concat(*[tokens(_col(f)) for f in fields]))
    listed = docs.select(F.explode(all_words).alias("term"))
    vocabulary = stored(listed.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "words")
    full = asked.where(F.col("kind") == "word")
    matches = full.join(near_forms(full.select("term").distinct(), vocabulary, fuzzy), "term").select(
        "prefix_id", "pos", F.col("match").alias("word"), "edits"
    )
    last = asked.where(F.col("kind") == "start")
    starts = stored(near_beginnings(last.select("term").distinct(), vocabulary, fuzzy), "starts")
    begun = prefix_matches(
        starts.select(F.col("match").alias("prefix")).distinct(),
        vocabulary.select(F.col("term").alias("key"), F.lit(0).alias("df")),
    ).select(F.col("prefix").alias("match"), F.col("key").alias("word"))
    # A word reached by several beginnings counts with its fewest edits.
    last_words = starts.join(begun, "match").groupBy("term", "word").agg(F.min("edits").alias("edits"))
    matches = matches.unionByName(last.join(last_words, "term").select("prefix_id", "pos", "word", "edits"))
    # Settled, so that the join knows its size and the words of documents stay in place.
    matches = settled(matches)
    met = matches.join(vocabulary.select(F.col("term").alias("word"), "df"), "word")
    tasks = scoring_tasks(met, MATCHES_PER_TASK)
    # As in the postings, all rows of a document share a partition, and pairs of
    # prefix and document are summed and cut to the top where they arise.
    placed = docs.select(F.col(id_col).alias("id"), all_words.alias("words")).repartition(tasks, "id")
    hits = (
        placed.select("id", F.explode("words").alias("word"))
        .join(matches, "word")
        .groupBy("id", "prefix_id", "pos")
        .agg(F.min("edits").alias("edits"))
        .groupBy("id", "prefix_id")
        .agg(F.count(F.lit(1)).alias("matched"), F.sum("edits").alias("edits"))
    )
    order = W.partitionBy("prefix_id").orderBy(F.col("matched").desc(), "edits", "id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def suggestion_rows(suggestions: DataFrame, docs: DataFrame, id_col: str = "id") -> DataFrame:
    """Suggestions with the text and address a caller shows."""
    shown = docs.select(F.col(id_col).alias("id"), F.col("title").alias("text"), "title", "url")
    return suggestions.join(shown, "id").select("prefix_id", "rank", "text", "id", "title", "url")
