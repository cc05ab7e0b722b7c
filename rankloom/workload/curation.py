"""Best bets on top of ranked results."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankloom.operators.curation import match_best_bets, pin
from rankloom.operators.keyword import keyword_search, query_terms
from rankloom.session import settled
from rankloom.sources.best_bets import bet_keys
from rankloom.sources.query_log import log_rows
from rankloom.workload.tables import (
    AS_OF,
    PASSAGE_TERMS_SQL,
    as_of,
    bm25_sql,
    passages,
    ranked_sql,
    table,
)


def _bets(spark, sf_dir):
    """One entry per document: its text is the trigger, together with its source.

    Texts that are copies of a passage match it, and sources collide in many entries.
    A second entry per passage with a line break pins the document of its number.
    """
    own = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("int").alias("entry_pos"),
        F.array("text", "source").alias("triggers"),
        F.col("doc_id").alias("id"),
        F.concat(F.lit("Document "), "doc_id").alias("title"),
        F.concat(F.lit("/d/"), "doc_id").alias("url"),
    )
    passage = table(spark, sf_dir, "benchmark").where(F.contains("text", F.lit("\n"))).select(
        F.lit(-1).alias("entry_pos"),
        F.array(F.replace("text", F.lit("\n"), F.lit(" -- "))).alias("triggers"),
        F.col("item_id").alias("id"),
        F.concat(F.lit("Passage "), "item_id").alias("title"),
        F.concat(F.lit("/p/"), "item_id").alias("url"),
    )
    return (
        own.unionByName(passage)
        .withColumn("note", F.lit("pinned"))
        .select("entry_pos", F.posexplode("triggers").alias("trigger_pos", "trigger"), "id", "title", "url", "note")
    )


def best_bet_keys(spark, sf_dir):
    """The entry that owns each lookup key."""
    return bet_keys(_bets(spark, sf_dir)).select("key", "id", "title")


_KEY_SQL = r"trim(regexp_replace(lower(strip_accents({0})), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"


def _keys(text):
    return _KEY_SQL.format(text)


BETS_SQL = rf"""
bets AS (
    SELECT doc_id AS entry_pos, unnest([0, 1]) AS trigger_pos, unnest([text, source]) AS trigger, doc_id AS id,
           'Document ' || doc_id AS title, '/d/' || doc_id AS url
    FROM documents
    UNION ALL
    SELECT -1, 0, replace(text, chr(10), ' -- '), item_id, 'Passage ' || item_id, '/p/' || item_id
    FROM benchmark WHERE contains(text, chr(10))
),
spaced AS (SELECT *, {_keys('trigger')} AS spaced FROM bets),
keyed AS (
    SELECT key, id, title, url FROM (
        SELECT spaced AS key, * FROM spaced
        UNION
        SELECT replace(spaced, ' ', '') AS key, * FROM spaced
    ) WHERE key <> ''
    QUALIFY row_number() OVER (PARTITION BY key ORDER BY entry_pos DESC, trigger_pos DESC) = 1
)"""
BEST_BET_KEYS_SQL = f"WITH {BETS_SQL} SELECT key, id, title FROM keyed"


def _pinned(spark, sf_dir):
    queries = passages(spark, sf_dir)
    ranked = (
        keyword_search(table(spark, sf_dir, "documents"), query_terms(queries), {"body": "text"}, 10, id_col="doc_id")
        .drop("coverage")
        .withColumn("reranker_score", F.lit(None).cast("double"))
        .withColumn("title", F.concat(F.lit("Document "), "id"))
        .withColumn("url", F.concat(F.lit("/d/"), "id"))
    )
    matches = settled(match_best_bets(queries, bet_keys(_bets(spark, sf_dir))))
    return queries, pin(ranked, matches, 10), matches


def best_bet_pin(spark, sf_dir):
    """Ranked passages with their best bet on top, capped at ten again."""
    _, rows, _ = _pinned(spark, sf_dir)
    return rows.select(
        "query_id", "id", "title", "url", "score", "curated", "note", F.col("rank").cast("long").alias("rank")
    )


PINNED_SQL = f"""
{BETS_SQL},
{bm25_sql("documents", "doc_id", {"body": ("text", 1.0)}, PASSAGE_TERMS_SQL)},
asked AS (SELECT item_id AS query_id, {_keys('text')} AS spaced FROM benchmark),
matches AS (
    SELECT query_id, id, title, url FROM (
        SELECT query_id, 0 AS attempt, spaced AS key FROM asked
        UNION ALL SELECT query_id, 1, replace(spaced, ' ', '') FROM asked
    ) JOIN keyed USING (key)
    QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY attempt) = 1
),
listed AS (
    SELECT query_id, id, title, url, NULL::DOUBLE AS score, true AS curated, 'pinned' AS note, 0 AS first_rank FROM matches
    UNION ALL
    SELECT r.query_id, r.id, 'Document ' || r.id, '/d/' || r.id, r.score, false, NULL, r.rank
    FROM {ranked_sql("scored", 10)} r
    WHERE NOT EXISTS (SELECT 1 FROM matches m WHERE m.query_id = r.query_id AND m.id = r.id)
),
final AS (SELECT * FROM {ranked_sql("listed", 10, "first_rank")})"""
BEST_BET_PIN_SQL = f"WITH {PINNED_SQL} SELECT query_id, id, title, url, score, curated, note, rank FROM final"


def query_log_rows(spark, sf_dir):
    """The log records of those searches."""
    queries, rows, matches = _pinned(spark, sf_dir)
    curated = queries.join(
        matches.select("query_id", F.lit(True).alias("curated")), "query_id", "left"
    ).withColumn("curated", F.coalesce("curated", F.lit(False)))
    return log_rows(curated, rows, "tuned", "keyword", as_of()).select(
        "timestamp",
        "query",
        "mode",
        F.col("num_results").cast("long").alias("num_results"),
        F.array_join("top_ids", ",").alias("top_ids"),
        "curated",
    )


QUERY_LOG_SQL = f"""
WITH {PINNED_SQL}
SELECT '{AS_OF.replace(" ", "T")}.000000Z' AS timestamp, b.text AS query, 'keyword' AS mode,
       count(f.id) AS num_results,
       coalesce(string_agg(f.id, ',' ORDER BY f.rank) FILTER (f.rank <= 5), '') AS top_ids,
       coalesce(bool_or(f.curated), false) AS curated
FROM benchmark b LEFT JOIN final f ON f.query_id = b.item_id
GROUP BY b.item_id, b.text
"""

QUERIES = {
    "best_bet_keys": best_bet_keys,
    "best_bet_pin": best_bet_pin,
    "query_log_rows": query_log_rows,
}
ORACLE = {
    "best_bet_keys": BEST_BET_KEYS_SQL,
    "best_bet_pin": BEST_BET_PIN_SQL,
    "query_log_rows": QUERY_LOG_SQL,
}
