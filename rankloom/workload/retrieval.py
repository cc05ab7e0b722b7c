"""Keyword retrieval, analysis, synonyms and fuzzy matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankloom.functions.text import allowed_edits, case_tokens, normalise, stem, tokens
from rankloom.operators.compounds import LINKING, add_parts, compound_parts, posting_parts
from rankloom.operators.fuzzy import one_edit_pairs
from rankloom.operators.keyword import (
    freshness_boost,
    keyword_search,
    query_terms,
    search_postings,
)
from rankloom.operators.postings import document_postings, term_statistics, vocabulary
from rankloom.operators.rerank import rerank, term_coverage
from rankloom.operators.synonyms import expand_queries, rule_statistics, rule_violations
from rankloom.plans.search import Index, run_queries
from rankloom.session import settled
from rankloom.sources.profiles import DEFAULT_PROFILE
from rankloom.sources.synonym_files import parse_rules
from rankloom.workload.tables import (
    AS_OF,
    PAGE_DOCUMENTS_SQL,
    PASSAGE_TERMS_SQL,
    as_of,
    bm25_sql,
    page_documents,
    passages,
    ranked_sql,
    table,
    words_sql,
)

TEXT = {"body": "text"}


def _documents(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def _ranked(df):
    return df.select("query_id", "id", "score", F.col("rank").cast("long").alias("rank"))


def corpus_statistics(spark, sf_dir):
    """Document frequency and total field length of every term."""
    stats = term_statistics(document_postings(_documents(spark, sf_dir), TEXT, "doc_id"))
    return stats.select("term", "df", F.col("total_len").cast("long").alias("total_len"))


CORPUS_STATISTICS_SQL = f"""
WITH d AS (SELECT doc_id, {words_sql('text')} AS toks FROM documents)
SELECT term, count(*) AS df, sum(dl)::BIGINT AS total_len
FROM (SELECT DISTINCT doc_id, len(toks) AS dl, unnest(list_append(toks, '')) AS term FROM d)
GROUP BY term
"""


def bm25_topk(spark, sf_dir):
    """The ten best documents for every whole passage."""
    return _ranked(
        keyword_search(
            _documents(spark, sf_dir), query_terms(passages(spark, sf_dir)), TEXT, 10, id_col="doc_id"
        )
    )


BM25_DOCUMENTS_SQL = bm25_sql("documents", "doc_id", {"body": ("text", 1.0)}, PASSAGE_TERMS_SQL)
BM25_TOPK_SQL = f"""
WITH {BM25_DOCUMENTS_SQL}
SELECT query_id, id, score, rank FROM {ranked_sql("scored", 10)}
"""


def field_weighted_topk(spark, sf_dir):
    """Pages by title and body, with the weights of the shipped profile."""
    weights = {k: DEFAULT_PROFILE.weights[k] for k in ("title", "body")}
    return _ranked(
        keyword_search(
            page_documents(spark, sf_dir),
            query_terms(passages(spark, sf_dir)),
            {"title": "title", "body": "body"},
            10,
            weights,
        )
    )


FIELD_WEIGHTED_SQL = f"""
WITH {PAGE_DOCUMENTS_SQL},
{bm25_sql("page_documents", "id", {"title": ("title", 3.0), "body": ("body", 1.0)}, PASSAGE_TERMS_SQL)}
SELECT query_id, id, score, rank FROM {ranked_sql("scored", 10)}
"""


def fresh_topk(spark, sf_dir):
    """Documents dated by the event of the same number, newer ones favoured."""
    dates = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("ts").alias("lastModified")
    )
    return _ranked(
        keyword_search(
            _documents(spark, sf_dir),
            query_terms(passages(spark, sf_dir)),
            TEXT,
            10,
            id_col="doc_id",
            adjust=freshness_boost(dates, as_of(), 2.0, 365),
        )
    )


FRESH_SQL = f"""
WITH {BM25_DOCUMENTS_SQL},
dated AS (
    SELECT g.query_id, g.id,
           round(sum(g.gain * g.part) * any_value(coalesce(1 + (1 - pow(least(greatest(
               (epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(e.ts)) // 86400000000 / 365.0::DOUBLE, 0), 1), 2)), 1)), 6) AS score
    FROM gains g LEFT JOIN events e ON e.event_id = g.id
    GROUP BY g.query_id, g.id
)
SELECT query_id, id, score, rank FROM {ranked_sql("dated", 10)}
"""


def stemmed_topk(spark, sf_dir):
    """Documents and passages compared by word stems."""
    term_of = lambda t: stem(t, "en")
    return _ranked(
        keyword_search(
            _documents(spark, sf_dir),
            query_terms(passages(spark, sf_dir), term_of=term_of),
            TEXT,
            10,
            id_col="doc_id",
            term_of=term_of,
        )
    )


def stem_sql(term):
    return f"regexp_replace({term}, '^(.{{4,}}?)(?:ings|ing|ed|es|s)$', '\\1')"


STEMMED_SQL = f"""
WITH {bm25_sql(
    "documents", "doc_id", {"body": ("text", 1.0)},
    f"SELECT query_id, {stem_sql('term')} AS term, sum(weight) AS weight FROM ({PASSAGE_TERMS_SQL}) GROUP BY ALL",
    stem_sql("term"),
)}
SELECT query_id, id, score, rank FROM {ranked_sql("scored", 10)}
"""


def compound_words(spark, sf_dir):
    """Words of the documents that are others of their words written together."""
    return compound_parts(vocabulary(_documents(spark, sf_dir), TEXT), links=LINKING["nl"])


VOCABULARY_SQL = f"""
vocab AS (SELECT DISTINCT unnest({words_sql('text')}) AS term FROM documents)"""
# All ways through a term are walked from its start, and the shortest kept.
_CUTS_SQL = """
spots AS (
    SELECT term, start, unnest(range(4, least(length(term) - start, 30) + 1)) AS size
    FROM (SELECT term, unnest(range(0, length(term) - 3)) AS start FROM vocab WHERE length(term) >= 8)
),
stretches AS (
    SELECT s.term, start, start + size AS after, w.term AS part
    FROM spots s JOIN vocab w ON w.term = substr(s.term, start + 1, size) WHERE w.term <> s.term
),
steps AS (
    SELECT term, start, after, part FROM stretches
    UNION ALL
    SELECT term, start, after + length(x), part FROM stretches, (VALUES ('s'), ('e'), ('en')) links(x)
    WHERE substr(term, after + 1, length(x)) = x AND after + length(x) < length(term)
),
ways AS (
    SELECT DISTINCT term, 0 AS place, []::VARCHAR[] AS parts FROM steps
    UNION
    SELECT w.term, s.after, list_append(w.parts, s.part) FROM ways w JOIN steps s ON s.term = w.term AND s.start = w.place
),
whole AS (SELECT term, parts, len(parts) AS n FROM ways WHERE place = length(term)),
parts AS (
    SELECT DISTINCT term, unnest(parts) AS part
    FROM (SELECT *, min(n) OVER (PARTITION BY term) AS least_n FROM whole) WHERE n = least_n
)"""
COMPOUNDS_SQL = f"WITH RECURSIVE {VOCABULARY_SQL}, {_CUTS_SQL} SELECT term, part FROM parts"


def decompounded_topk(spark, sf_dir):
    """Whole pages searched with compound words also listed under their parts."""
    docs = settled(page_documents(spark, sf_dir).select("id", "title", "body"))
    fields = {"title": "title", "body": "body"}
    parts = settled(compound_parts(vocabulary(docs, fields), links=LINKING["nl"]))
    postings = posting_parts(document_postings(docs, fields), parts)
    terms = add_parts(query_terms(passages(spark, sf_dir)), parts)
    return _ranked(search_postings(postings, terms, 10, {"title": 2.0, "body": 1.0}))


DECOMPOUNDED_SQL = f"""
WITH RECURSIVE {PAGE_DOCUMENTS_SQL},
toks AS (
    SELECT id, 'title' AS field, 2.0 AS w, {words_sql('title')} AS words FROM page_documents
    UNION ALL SELECT id, 'body', 1.0, {words_sql('body')} FROM page_documents
),
vocab AS (SELECT DISTINCT unnest(words) AS term FROM toks),
{_CUTS_SQL},
totals AS (SELECT field, any_value(w)::DOUBLE AS w, count(*) AS n_docs, sum(len(words))::DOUBLE / count(*) AS mean_len FROM toks GROUP BY field),
base AS (SELECT id, field, len(words) AS dl, unnest(words) AS term FROM toks),
post AS (
    SELECT id, field, dl, term, count(*)::DOUBLE AS tf
    FROM (SELECT * FROM base UNION ALL SELECT id, field, dl, part FROM base JOIN parts USING (term))
    GROUP BY ALL
),
freq AS (SELECT field, term, count(*) AS df FROM post GROUP BY ALL),
own AS ({PASSAGE_TERMS_SQL}),
q AS (
    SELECT query_id, term, max(weight) AS weight
    FROM (SELECT * FROM own UNION ALL SELECT query_id, part, weight FROM own JOIN parts USING (term))
    GROUP BY ALL
),
scored AS (
    SELECT q.query_id, p.id,
           round(sum(w * q.weight * ln(1 + (n_docs - df + 0.5) / (df + 0.5)) * tf * 2.2
                     / (tf + 1.2 * (0.25 + 0.75 * dl / mean_len))), 6) AS score
    FROM q JOIN post p USING (term) JOIN freq USING (field, term) JOIN totals USING (field)
    GROUP BY q.query_id, p.id
)
SELECT query_id, id, score, rank FROM {ranked_sql("scored", 10)}
"""


def rerank_coverage(spark, sf_dir):
    """The fifty best documents reordered by the weight of the matched words."""
    first = keyword_search(
        _documents(spark, sf_dir), query_terms(passages(spark, sf_dir)), TEXT, 50, id_col="doc_id"
    )
    return (
        rerank(first, term_coverage(), 50)
        .where("rank <= 10")
        .select("query_id", "id", "reranker_score", F.col("rank").cast("long").alias("rank"))
    )


RERANK_SQL = f"""
WITH {BM25_DOCUMENTS_SQL},
first AS (SELECT query_id, id, round(coverage, 6) AS reranker_score, rank AS first_rank FROM {ranked_sql("scored", 50)})
SELECT query_id, id, reranker_score, rank
FROM {ranked_sql("first", 10, "reranker_score DESC, first_rank")}
"""


def _document_rules(spark, sf_dir):
    """Document lines read as rule files; table cells and arrows stay on their line."""
    texts = _documents(spark, sf_dir).select(
        F.concat(F.lit("doc-"), "doc_id").alias("file"),
        F.regexp_replace("text", r"\s*\|\s*", " => ").alias("value"),
    )
    return parse_rules(texts)


def synonym_rules(spark, sf_dir):
    """Kind and term counts of every rule line."""
    return _document_rules(spark, sf_dir).select(
        "file",
        F.col("line_no").cast("long").alias("line_no"),
        "kind",
        F.size("left").cast("long").alias("n_left"),
        F.size("right").cast("long").alias("n_right"),
    )


_RULES_SQL = r"""
lines AS (
    SELECT 'doc-' || doc_id AS file, unnest(range(1, len(parts) + 1)) AS line_no, unnest(parts) AS line
    FROM (SELECT doc_id, string_split(regexp_replace(text, '\s*\|\s*', ' => ', 'g'), chr(10)) AS parts FROM documents)
),
raws AS (SELECT file, line_no, trim(line) AS raw FROM lines WHERE trim(line) <> '' AND NOT starts_with(trim(line), '#')),
rules AS (
    SELECT file, line_no,
           CASE WHEN contains(raw, '=>') THEN 'directional' ELSE 'equivalency' END AS kind,
           list_filter(list_transform(string_split(
               CASE WHEN contains(raw, '=>') THEN left(raw, strpos(raw, '=>') - 1) ELSE raw END, ','),
               lambda t: trim(t)), lambda t: t <> '') AS l,
           CASE WHEN contains(raw, '=>') THEN list_filter(list_transform(string_split(
               substr(raw, strpos(raw, '=>') + 2), ','), lambda t: trim(t)), lambda t: t <> '')
               ELSE []::VARCHAR[] END AS r
    FROM raws
)"""
SYNONYM_RULES_SQL = f"""
WITH {_RULES_SQL}
SELECT file, line_no, kind, len(l)::BIGINT AS n_left, len(r)::BIGINT AS n_right FROM rules
"""


def synonym_violations(spark, sf_dir):
    """Everything the rule check reports about those lines."""
    return rule_violations(_document_rules(spark, sf_dir)).withColumn(
        "line_no", F.col("line_no").cast("long")
    )


_VIOLATIONS_SQL = """
shared AS (
    SELECT file, term FROM (SELECT file, line_no, lower(unnest(l)) AS term FROM rules)
    GROUP BY ALL HAVING count(DISTINCT line_no) > 1
),
violations AS (
    SELECT file, line_no, 'error' AS severity, 'empty side' AS problem, NULL::VARCHAR AS term
    FROM rules WHERE kind = 'directional' AND (len(l) = 0 OR len(r) = 0)
    UNION ALL
    SELECT file, line_no, 'error', 'single term', NULL FROM rules WHERE kind = 'equivalency' AND len(l) <= 1
    UNION ALL
    SELECT file, line_no, 'warning', 'over-broad', NULL FROM rules WHERE len(l) > 8
    UNION ALL
    SELECT DISTINCT file, line_no, 'error', 'shared trigger', term
    FROM (SELECT file, line_no, lower(unnest(l)) AS term FROM rules) JOIN shared USING (file, term)
)"""
VIOLATIONS_SQL = f"WITH {_RULES_SQL}, {_VIOLATIONS_SQL} SELECT * FROM violations"


def synonym_statistics(spark, sf_dir):
    """Rule, term, warning and error counts per file."""
    return rule_statistics(_document_rules(spark, sf_dir))


STATISTICS_SQL = f"""
WITH {_RULES_SQL}, {_VIOLATIONS_SQL},
kinds AS (
    SELECT file, count(*) AS total_rules, count(*) FILTER (kind = 'equivalency') AS equivalency_rules,
           count(*) FILTER (kind = 'directional') AS directional_rules
    FROM rules GROUP BY file
),
terms AS (SELECT file, count(DISTINCT lower(term)) AS unique_terms
          FROM (SELECT file, unnest(list_concat(l, r)) AS term FROM rules) GROUP BY file),
counted AS (
    SELECT file, count(*) FILTER (severity = 'warning') AS warnings, count(*) FILTER (severity = 'error') AS errors
    FROM (SELECT DISTINCT file, severity, problem, term, CASE WHEN term IS NULL THEN line_no END FROM violations)
    GROUP BY file
)
SELECT k.*, coalesce(unique_terms, 0) AS unique_terms, coalesce(warnings, 0) AS warnings, coalesce(errors, 0) AS errors
FROM kinds k LEFT JOIN terms USING (file) LEFT JOIN counted USING (file)
"""


def synonym_expand(spark, sf_dir):
    """Passages expanded by rules made of all words of the page titles.

    A title is cut into phrases of one, two, three, four and five words, and so on from one
    again. Every first and second phrase of a pair are interchangeable, or in every second pair
    the first is sent to the second.
    """
    start = lambda j: 15 * F.floor(j / 5) + (j % 5) * (j % 5 + 1) / 2
    phrase = lambda j: F.array_join(F.slice("w", (start(j) + 1).cast("int"), j % 5 + 1), " ")
    titles = page_documents(spark, sf_dir).select("id", tokens("title").alias("w"))
    pairs = titles.select("id", "w", F.explode(F.sequence(F.lit(0), F.size("w"))).alias("j"))
    pairs = pairs.where((F.col("j") % 2 == 0) & (start(F.col("j") + 1) < F.size("w")))
    sign = F.when(F.col("j") % 4 == 0, ", ").otherwise(" => ")
    lines = pairs.select(
        F.concat_ws("-", "id", "j").alias("file"), F.concat(phrase(F.col("j")), sign, phrase(F.col("j") + 1)).alias("value")
    )
    return expand_queries(passages(spark, sf_dir), parse_rules(lines))


_PHRASE_SQL = "array_to_string(w[15 * ({0} // 5) + ({0} % 5) * ({0} % 5 + 1) // 2 + 1 : 15 * ({0} // 5) + ({0} % 5) * ({0} % 5 + 1) // 2 + {0} % 5 + 1], ' ')"
SYNONYM_EXPAND_SQL = f"""
WITH {PAGE_DOCUMENTS_SQL},
titles AS (SELECT w, unnest(range(0, len(w) + 1, 2)) AS j FROM (SELECT {words_sql('title')} AS w FROM page_documents)),
pairs AS (SELECT j, {_PHRASE_SQL.format('j')} AS a, {_PHRASE_SQL.format('(j + 1)')} AS b FROM titles),
phrases AS (
    SELECT DISTINCT a AS phrase, CASE WHEN a <> b THEN b END AS added, j % 4 = 0 AS same FROM pairs WHERE b <> ''
    UNION
    SELECT b, CASE WHEN a <> b THEN a END, true FROM pairs WHERE b <> '' AND j % 4 = 0
),
asked AS (SELECT item_id AS query_id, {words_sql('text')} AS w FROM benchmark),
words AS (SELECT query_id, unnest(range(1, len(w) + 1)) AS pos, unnest(w) AS term FROM asked),
grams AS (
    SELECT query_id, pos, n, array_to_string(w[pos : pos + n - 1], ' ') AS phrase
    FROM (SELECT query_id, w, unnest(range(1, len(w) + 1)) AS pos FROM asked) JOIN range(1, 6) AS r(n) ON pos + n - 1 <= len(w)
),
hits AS (SELECT * FROM grams JOIN phrases USING (phrase)),
gone AS (SELECT DISTINCT query_id, unnest(range(pos, pos + n)) AS pos FROM hits WHERE NOT same),
found AS (
    SELECT query_id, term, 1 AS own FROM words WHERE (query_id, pos) NOT IN (SELECT (query_id, pos) FROM gone)
    UNION ALL
    SELECT query_id, unnest(string_split(added, ' ')), 0 FROM hits WHERE added IS NOT NULL
)
SELECT query_id, term, greatest(sum(own), 1)::DOUBLE AS weight, sum(own) = 0 AS synonym
FROM found GROUP BY query_id, term
"""


def query_normalise(spark, sf_dir):
    """All turns in the form best bets are looked up by."""
    turns = table(spark, sf_dir, "conversations")
    spaced = normalise("text")
    return turns.select(
        "conv_id", "turn", spaced.alias("spaced"), F.replace(spaced, F.lit(" "), F.lit("")).alias("joined")
    )


QUERY_NORMALISE_SQL = r"""
SELECT conv_id, turn, spaced, replace(spaced, ' ', '') AS joined
FROM (
    SELECT conv_id, turn,
           trim(regexp_replace(lower(strip_accents(text)), '[^\p{L}\p{N}]+', ' ', 'g')) AS spaced
    FROM conversations
)
"""


def fuzzy_eligibility(spark, sf_dir):
    """Words of all turns with the edits each may differ by."""
    turns = table(spark, sf_dir, "conversations")
    words = turns.select("conv_id", "turn", F.posexplode(case_tokens("text")).alias("pos", "token"))
    return words.select(
        "conv_id",
        "turn",
        F.col("pos").cast("long").alias("pos"),
        "token",
        allowed_edits("token").cast("long").alias("max_edits"),
    )


ELIGIBILITY_SQL = r"""
SELECT conv_id, turn, pos, token,
       CASE WHEN regexp_matches(token, '\p{N}') OR (upper(token) = token AND lower(token) <> token) THEN 0
            WHEN regexp_full_match(token, '\p{L}{4,}') THEN 1 ELSE 0 END::BIGINT AS max_edits
FROM (
    SELECT conv_id, turn, unnest(range(0, len(t)))::BIGINT AS pos, unnest(t) AS token
    FROM (
        SELECT conv_id, turn, list_filter(string_split_regex(text, '\s+'), lambda x: x <> '') AS t
        FROM conversations
    )
)
"""


def fuzzy_terms(spark, sf_dir):
    """Passage words and document words at most one edit apart."""
    wanted = query_terms(passages(spark, sf_dir)).select("term").distinct()
    return one_edit_pairs(wanted, vocabulary(_documents(spark, sf_dir), TEXT).select("term")).withColumn(
        "edits", F.col("edits").cast("long")
    )


def one_edit_sql(left: str, right: str) -> str:
    """Pairs of terms one edit apart, character by character."""
    return f"""
    SELECT a.term, b.term AS match, 0::BIGINT AS edits FROM {left} a JOIN {right} b ON a.term = b.term
    UNION
    SELECT a.term, b.term, 1 FROM
        (SELECT term, unnest(range(1, length(term) + 1)) AS i FROM {left}) a
        JOIN (SELECT term, unnest(range(1, length(term) + 1)) AS i FROM {right}) b
        ON a.i = b.i AND length(a.term) = length(b.term)
        AND left(a.term, a.i - 1) || '|' || substr(a.term, a.i + 1) = left(b.term, b.i - 1) || '|' || substr(b.term, b.i + 1)
        AND a.term <> b.term
    UNION
    SELECT a.term, b.term, 1 FROM
        (SELECT term, unnest(range(1, length(term) + 1)) AS i FROM {left}) a
        JOIN {right} b ON left(a.term, a.i - 1) || substr(a.term, a.i + 1) = b.term
    UNION
    SELECT a.term, b.term, 1 FROM {left} a
        JOIN (SELECT term, unnest(range(1, length(term) + 1)) AS i FROM {right}) b
        ON left(b.term, b.i - 1) || substr(b.term, b.i + 1) = a.term"""


FUZZY_TERMS_SQL = f"""
WITH {VOCABULARY_SQL},
wanted AS (SELECT DISTINCT unnest({words_sql('text')}) AS term FROM benchmark)
SELECT term, match, edits FROM ({one_edit_sql("wanted", "vocab")})
"""


def _misspelt(spark, sf_dir):
    """Passages with the last letter of every word doubled."""
    doubled = F.transform(tokens("query"), lambda t: F.concat(t, F.substr(t, F.length(t), F.lit(1))))
    return passages(spark, sf_dir).select("query_id", F.array_join(doubled, " ").alias("query"))


def fuzzy_fallback(spark, sf_dir):
    """Misspelt passages over the pages: base search, then the fuzzy retry."""
    # Read by several passes, as a loaded document table would be.
    docs = settled(page_documents(spark, sf_dir))
    index = Index(docs, {"title": "title", "body": "body"})
    return run_queries(index, _misspelt(spark, sf_dir), "keyword", 10).select(
        "query_id", "id", "url", "score", "fallback", F.col("rank").cast("long").alias("rank")
    )


FALLBACK_SQL = f"""
WITH {PAGE_DOCUMENTS_SQL},
misspelt AS (
    SELECT item_id AS query_id,
           list_transform({words_sql('text')}, lambda t: t || right(t, 1)) AS words
    FROM benchmark
),
{bm25_sql("page_documents", "id", {"title": ("title", 1.0), "body": ("body", 1.0)},
          "SELECT query_id, term, count(*)::DOUBLE AS weight FROM (SELECT query_id, unnest(words) AS term FROM misspelt) GROUP BY ALL")},
empty AS (SELECT query_id, words FROM misspelt WHERE query_id NOT IN (SELECT query_id FROM scored)),
exact AS (SELECT DISTINCT query_id, unnest(words) AS term FROM empty),
loose AS (SELECT DISTINCT term FROM exact WHERE regexp_full_match(term, '\\p{{L}}{{4,}}')),
page_words AS (
    SELECT DISTINCT unnest({words_sql("title || ' ' || body")}) AS term FROM page_documents
),
near AS (SELECT * FROM ({one_edit_sql("loose", "page_words")}) WHERE edits = 1),
{bm25_sql("page_documents", "id", {"title": ("title", 1.0), "body": ("body", 1.0)},
          '''SELECT query_id, term, max(weight) AS weight FROM (
                SELECT query_id, term, 1.0::DOUBLE AS weight FROM exact
                UNION ALL
                SELECT query_id, match, 1 - 1.0::DOUBLE / least(length(near.term), length(match))
                FROM exact JOIN near ON near.term = exact.term) GROUP BY ALL''', prefix="f_")}
SELECT r.query_id, r.id, url, score, fallback, rank
FROM (
    SELECT query_id, id, score, NULL::VARCHAR AS fallback, rank FROM {ranked_sql("scored", 10)}
    UNION ALL
    SELECT query_id, id, score, 'fuzzy', rank FROM {ranked_sql("f_scored", 10)}
) r JOIN page_documents d ON d.id = r.id
"""

QUERIES = {
    "corpus_statistics": corpus_statistics,
    "bm25_topk": bm25_topk,
    "field_weighted_topk": field_weighted_topk,
    "fresh_topk": fresh_topk,
    "stemmed_topk": stemmed_topk,
    "compound_words": compound_words,
    "decompounded_topk": decompounded_topk,
    "rerank_coverage": rerank_coverage,
    "synonym_rules": synonym_rules,
    "synonym_violations": synonym_violations,
    "synonym_statistics": synonym_statistics,
    "synonym_expand": synonym_expand,
    "query_normalise": query_normalise,
    "fuzzy_eligibility": fuzzy_eligibility,
    "fuzzy_terms": fuzzy_terms,
    "fuzzy_fallback": fuzzy_fallback,
}
ORACLE = {
    "corpus_statistics": CORPUS_STATISTICS_SQL,
    "bm25_topk": BM25_TOPK_SQL,
    "field_weighted_topk": FIELD_WEIGHTED_SQL,
    "fresh_topk": FRESH_SQL,
    "stemmed_topk": STEMMED_SQL,
    "compound_words": COMPOUNDS_SQL,
    "decompounded_topk": DECOMPOUNDED_SQL,
    "rerank_coverage": RERANK_SQL,
    "synonym_rules": SYNONYM_RULES_SQL,
    "synonym_violations": VIOLATIONS_SQL,
    "synonym_statistics": STATISTICS_SQL,
    "synonym_expand": SYNONYM_EXPAND_SQL,
    "query_normalise": QUERY_NORMALISE_SQL,
    "fuzzy_eligibility": ELIGIBILITY_SQL,
    "fuzzy_terms": FUZZY_TERMS_SQL,
    "fuzzy_fallback": FALLBACK_SQL,
}
