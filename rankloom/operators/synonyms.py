"""Synonym rules: checks, statistics and query expansion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rankloom.functions.text import tokens
from rankloom.session import settled

MAX_CLUSTER = 8


def _lowered(terms) -> Column:
    return F.transform(terms, lambda t: F.lower(t))


def trigger_overlaps(rules: DataFrame) -> DataFrame:
    """``file, term, line_no`` for every trigger that stands on more than one line.

    Triggers are compared in lower case; repeats on one line do not count and the
    right-hand side is exempt.
    """
    triggers = rules.select("file", "line_no", F.explode_outer(F.array_distinct(_lowered("left"))).alias("term")).distinct()
    repeated = (
        triggers.groupBy("file", "term")
        .agg(F.min("line_no").alias("first_line"), F.max("line_no").alias("last_line"))
        .where(F.col("first_line") < F.col("last_line"))
        .select("file", "term")
    )
    return triggers.join(repeated, ["file", "term"], "left_semi").select("file", "term", "line_no")


def _rule_checks(max_cluster: int) -> dict[str, tuple[str, Column]]:
    """Name of each check on a single rule, with its severity and condition."""
    left, right = F.size("left"), F.size("right")
    directional = F.col("kind") == "directional"
    return {
        "empty side": ("error", directional & ((left == 0) | (right == 0))),
        "single term": ("error", ~directional & (left <= 1)),
        "over-broad": ("warning", left > max_cluster),
    }


def rule_violations(rules: DataFrame, max_cluster: int = MAX_CLUSTER) -> DataFrame:
    """``file, line_no, severity, problem, term`` of all findings.

    A malformed rule is reported and still takes part in the other checks. The rules are
    parsed once and kept, as several checks read them. For a report see :func:`by_term`.
    """
    rules = settled(rules.select("file", "line_no", "kind", "left", "right"))
    findings = F.array_compact(
        F.array(
            *[
                F.when(hit, F.struct(F.lit(severity).alias("severity"), F.lit(problem).alias("problem")))
                for problem, (severity, hit) in _rule_checks(max_cluster).items()
            ]
        )
    )
    single = rules.select(
        "file", "line_no", F.inline(findings), F.lit(None).cast("string").alias("term")
    )
    overlaps = trigger_overlaps(rules).select(
        "file", "line_no", F.lit("error").alias("severity"), F.lit("shared trigger").alias("problem"), "term"
    )
    return single.unionByName(overlaps)


def by_term(violations: DataFrame) -> DataFrame:
    """Findings in the order of a report: by term, those without one last."""
    return violations.orderBy(F.col("term").asc_nulls_last(), "file", "line_no", "problem")


def rule_statistics(rules: DataFrame, max_cluster: int = MAX_CLUSTER) -> DataFrame:
    """One row per file: rules by kind, unique terms, warnings and errors.

    A trigger shared by several lines is one error.
    """
    rules = settled(rules.select("file", "line_no", "kind", "left", "right"))

    def problems(kind):
        counts = [
            F.count_if(hit) for severity, hit in _rule_checks(max_cluster).values() if severity == kind
        ]
        return sum(counts[1:], counts[0])

    per_rule = rules.groupBy("file").agg(
        F.count(F.lit(1)).alias("total_rules"),
        F.count_if(F.col("kind") == "equivalency").alias("equivalency_rules"),
        F.count_if(F.col("kind") == "directional").alias("directional_rules"),
        problems("warning").alias("warnings"),
        problems("error").alias("rule_errors"),
    )
    sides = [
        F.transform(side, lambda t: F.struct(F.lower(t).alias("term"), line.alias("line")))
        for side, line in (("left", F.col("line_no")), ("right", F.lit(None).cast("int")))
    ]
    terms = (
        rules.select("file", F.inline_outer(F.concat(*sides)))
        .groupBy("file", "term")
        .agg(F.min("line").alias("first_line"), F.max("line").alias("last_line"))
        .groupBy("file")
        .agg(
            F.count("term").alias("unique_terms"),
            F.count_if(F.col("term").isNotNull() & (F.col("first_line") < F.col("last_line"))).alias("shared"),
        )
    )
    return per_rule.join(terms, "file").select(
        "file",
        "total_rules",
        "equivalency_rules",
        "directional_rules",
        "unique_terms",
        "warnings",
        (F.col("rule_errors") + F.col("shared")).alias("errors"),
    )


def rule_phrases(rules: DataFrame) -> DataFrame:
    """``rule, kind, phrase, n, added``: what to look for and which words it brings.

    ``added`` holds the words of the other terms of an equivalency, or of the
    right-hand side of a directional rule.
    """
    rules = rules.withColumn("rule", F.struct("file", "line_no"))

    def phrases(side):
        return F.array_remove(F.transform(side, lambda t: F.array_join(tokens(t), " ")), "")

    directional = F.col("kind") == "directional"
    sided = rules.select(
        "rule",
        "kind",
        phrases(F.col("left")).alias("left"),
        F.when(directional, phrases(F.col("right"))).otherwise(phrases(F.col("left"))).alias("right"),
    )
    return sided.select("rule", "kind", F.explode("left").alias("phrase"), "right").select(
        "rule",
        "kind",
        "phrase",
        F.size(F.split("phrase", " ")).alias("n"),
        F.array_remove("right", F.col("phrase")).alias("added"),
    )


def phrase_trie(phrases: DataFrame) -> DataFrame:
    """``parent, word, node``: the edges of a trie over the words of all phrases.

    A node is the hash of the words that lead to it, so equal beginnings of phrases are
    one path; the root is the hash of no words.
    """
    words = phrases.select(F.split("phrase", " ").alias("words")).distinct()
    steps = words.select("words", F.posexplode("words").alias("at", "word"))
    prefix = lambda n: F.xxhash64(F.slice("words", F.lit(1), n))
    return steps.select(prefix(F.col("at")).alias("parent"), "word", prefix(F.col("at") + 1).alias("node")).distinct()


def phrase_hits(words: DataFrame, phrases: DataFrame) -> DataFrame:
    """``query_id, pos, n`` and the columns of ``phrases`` for every place of a phrase.

    ``words`` holds ``query_id, pos, term``. The trie is walked once for all places: a level
    joins the next word of every path that is still open, so phrases may be of any length
    and only beginnings of phrases are ever made.
    """
    edges = settled(phrase_trie(phrases))
    ends = phrases.withColumn("node", F.xxhash64(F.split("phrase", " "))).drop("n")
    words = settled(words)
    root = edges.where(F.col("parent") == F.xxhash64(F.array().cast("array<string>")))
    begin = words.join(root, F.col("term") == F.col("word"))
    paths = settled(begin.select("query_id", "pos", F.lit(1).alias("n"), "node"))
    found = None
    while not paths.isEmpty():
        level = paths.join(ends, "node").drop("node")
        found = level if found is None else found.unionByName(level)
        following = words.select("query_id", F.col("pos").alias("next"), "term")
        steps = paths.withColumn("next", F.col("pos") + F.col("n")).join(following, ["query_id", "next"])
        longer = steps.withColumnRenamed("node", "parent").join(edges.withColumnRenamed("word", "term"), ["parent", "term"])
        paths = settled(longer.select("query_id", "pos", (F.col("n") + 1).alias("n"), "node"))
    return paths.join(ends, "node").drop("node") if found is None else found


def expand_queries(queries: DataFrame, rules: DataFrame, text: str = "query") -> DataFrame:
    """Query terms after the rules: ``query_id, term, weight, synonym``.

    A matched equivalency adds the words of its other terms; a matched directional
    rule replaces the matched words. A word of the query keeps its number of
    occurrences as weight, an added word weighs one.
    """
    phrases = settled(rule_phrases(rules))
    words = queries.select("query_id", F.posexplode(tokens(text)).alias("pos", "term"))
    hits = phrase_hits(words, phrases)
    removed = (
        hits.where(F.col("kind") == "directional")
        .select("query_id", F.explode(F.sequence("pos", F.col("pos") + F.col("n") - 1)).alias("pos"))
        .distinct()
    )
    kept = (
        words.join(removed, ["query_id", "pos"], "left_anti")
        .select("query_id", "term", F.lit(1).alias("own"))
    )
    added = hits.select("query_id", F.explode("added").alias("phrase")).select(
        "query_id", F.explode(F.split("phrase", " ")).alias("term"), F.lit(0).alias("own")
    )
    return (
        kept.unionByName(added)
        .groupBy("query_id", "term")
        .agg(F.sum("own").alias("own"))
        .select(
            "query_id",
            "term",
            F.greatest("own", F.lit(1)).cast("double").alias("weight"),
            (F.col("own") == 0).alias("synonym"),
        )
    )
