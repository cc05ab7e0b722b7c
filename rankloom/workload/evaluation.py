"""Metrics of three rankings of the passages."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankloom.operators.keyword import keyword_search, query_terms
from rankloom.operators.metrics import config_metrics, grade_map, lift, query_metrics, representative
from rankloom.operators.rerank import rerank, term_coverage
from rankloom.session import settled
from rankloom.sources.sinks import detail_rows, summary_rows
from rankloom.workload.tables import PASSAGE_TERMS_SQL, bm25_sql, passages, ranked_sql, table

BASELINE = "baseline-newest"
CONFIGS = (BASELINE, "tuned-keyword", "tuned-semantic")
SENTENCE = r"[.\n]+"


def _sentences(df, key):
    parts = F.transform(F.split("text", SENTENCE), lambda s: F.trim(s))
    return df.select(key, F.explode(F.array_distinct(parts)).alias("sentence")).where(
        F.col("sentence") != ""
    )


def _judgments(spark, sf_dir):
    """A document is judged for a passage by the sentences they share, up to grade 3.

    Documents labelled toxic get grade 0. Documents of an even number are judged by
    id, the others by url.
    """
    passages_ = _sentences(table(spark, sf_dir, "benchmark"), "item_id")
    docs = _sentences(table(spark, sf_dir, "documents"), "doc_id")
    toxic = table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id", F.lit(1).alias("toxic"))
    shared = docs.join(passages_, "sentence").groupBy("item_id", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    number = F.col("doc_id").cast("string")
    return shared.join(toxic, "doc_id", "left").select(
        F.col("item_id").cast("string").alias("query"),
        F.when(F.col("doc_id") % 2 == 0, number).otherwise(F.concat(F.lit("/d/"), number)).alias("intended_id"),
        F.when(F.col("toxic").isNotNull(), 0).otherwise(F.least("n", F.lit(3))).cast("int").alias("relevance"),
    )


JUDGMENTS_SQL = """
doc_sentences AS (
    SELECT DISTINCT doc_id, trim(s) AS sentence
    FROM (SELECT doc_id, unnest(string_split_regex(text, '[.\\n]+')) AS s FROM documents) WHERE trim(s) <> ''
),
item_sentences AS (
    SELECT DISTINCT item_id, trim(s) AS sentence
    FROM (SELECT item_id, unnest(string_split_regex(text, '[.\\n]+')) AS s FROM benchmark) WHERE trim(s) <> ''
),
shared AS (
    SELECT item_id, doc_id, count(*) AS n FROM doc_sentences JOIN item_sentences USING (sentence) GROUP BY ALL
),
judgments AS (
    SELECT item_id::VARCHAR AS query,
           CASE WHEN doc_id % 2 = 0 THEN doc_id::VARCHAR ELSE '/d/' || doc_id END AS intended_id,
           CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) THEN 0 ELSE least(n, 3) END AS relevance
    FROM shared
),
grades AS (SELECT query, intended_id, max(relevance) AS grade FROM judgments GROUP BY ALL)"""


def judgment_groups(spark, sf_dir):
    """The representative document and number of judged documents per query."""
    grades = grade_map(_judgments(spark, sf_dir))
    counts = grades.groupBy("query").agg(F.count(F.lit(1)).alias("judged"))
    return representative(grades).join(counts, "query")


JUDGMENT_GROUPS_SQL = f"""
WITH {JUDGMENTS_SQL}
SELECT query, intended_id, judged FROM (
    SELECT query, intended_id, count(*) OVER (PARTITION BY query) AS judged,
           row_number() OVER (PARTITION BY query ORDER BY grade DESC, intended_id DESC) AS n
    FROM grades
) WHERE n = 1
"""


def _per_query(spark, sf_dir):
    found = settled(
        keyword_search(
            table(spark, sf_dir, "documents"), query_terms(passages(spark, sf_dir)), {"body": "text"}, 50, id_col="doc_id"
        )
    )
    newest = rerank(found, F.col("id"), 50)
    again = rerank(found, term_coverage(), 50)
    results = None
    for config, rows in zip(CONFIGS, (newest, found, again)):
        part = rows.select(
            F.lit(config).alias("config"),
            F.col("query_id").cast("string").alias("query"),
            "id",
            F.concat(F.lit("/d/"), "id").alias("url"),
            "rank",
        )
        results = part if results is None else results.unionByName(part)
    return query_metrics(results, _judgments(spark, sf_dir), CONFIGS)


def per_query_metrics(spark, sf_dir):
    """Rank of the first relevant document and NDCG of every judged passage."""
    return _per_query(spark, sf_dir).withColumn("rank", F.col("rank").cast("long"))


PER_QUERY_CTES = f"""
{JUDGMENTS_SQL},
{bm25_sql("documents", "doc_id", {"body": ("text", 1.0)}, PASSAGE_TERMS_SQL)},
found AS (SELECT query_id, id, round(coverage, 6) AS coverage, rank AS first_rank FROM {ranked_sql("scored", 50)}),
results AS (
    SELECT 'baseline-newest' AS config, query_id::VARCHAR AS query, id, rank FROM {ranked_sql("found", None, "id DESC")}
    UNION ALL
    SELECT 'tuned-keyword', query_id::VARCHAR, id, first_rank FROM found
    UNION ALL
    SELECT 'tuned-semantic', query_id::VARCHAR, id, rank FROM {ranked_sql("found", None, "coverage DESC, first_rank")}
),
graded AS (
    SELECT r.config, r.query, r.rank, coalesce(a.grade, b.grade, 0) AS grade
    FROM results r
    LEFT JOIN grades a ON a.query = r.query AND a.intended_id = r.id::VARCHAR
    LEFT JOIN grades b ON b.query = r.query AND b.intended_id = '/d/' || r.id
),
ideal AS (
    SELECT query, sum((pow(2, grade) - 1) / log2(n + 1)) AS ideal
    FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY grade DESC) AS n FROM grades WHERE grade > 0)
    WHERE n <= 10 GROUP BY query
),
best AS (
    SELECT query, intended_id FROM grades
    QUALIFY row_number() OVER (PARTITION BY query ORDER BY grade DESC, intended_id DESC) = 1
),
per_query AS (
    SELECT c.config, b.query, b.intended_id, min(g.rank) FILTER (g.grade >= 1) AS rank, count(g.rank) AS num_results,
           round(coalesce(sum(CASE WHEN g.rank <= 10 THEN (pow(2, g.grade) - 1) / log2(g.rank + 1) END)
                 / any_value(i.ideal), 0), 6) AS ndcg_at_10
    FROM best b JOIN (SELECT unnest(['baseline-newest', 'tuned-keyword', 'tuned-semantic']) AS config) c ON true
    LEFT JOIN ideal i ON i.query = b.query
    LEFT JOIN graded g ON g.query = b.query AND g.config = c.config
    GROUP BY c.config, b.query, b.intended_id
),
metrics AS (
    SELECT config, count(*) AS num_queries,
           round(avg(CASE WHEN rank = 1 THEN 1.0::DOUBLE ELSE 0 END), 6) AS success_at_1,
           round(avg(CASE WHEN rank <= 3 THEN 1.0::DOUBLE ELSE 0 END), 6) AS success_at_3,
           round(avg(CASE WHEN rank <= 10 THEN 1.0::DOUBLE / rank ELSE 0 END), 6) AS mrr_at_10,
           round(avg(ndcg_at_10), 6) AS ndcg_at_10,
           round(avg(CASE WHEN rank IS NOT NULL THEN 1.0::DOUBLE ELSE 0 END), 6) AS found_rate,
           round(avg(CASE WHEN num_results = 0 THEN 1.0::DOUBLE ELSE 0 END), 6) AS zero_result_rate
    FROM per_query GROUP BY config
)"""
PER_QUERY_SQL = f"WITH {PER_QUERY_CTES} SELECT * FROM per_query"


def configuration_metrics(spark, sf_dir):
    """All configurations over all judged passages."""
    return config_metrics(_per_query(spark, sf_dir))


CONFIG_SQL = f"WITH {PER_QUERY_CTES} SELECT * FROM metrics"


def configuration_lift(spark, sf_dir):
    """The best configuration against the baseline."""
    return lift(config_metrics(_per_query(spark, sf_dir)), CONFIGS, BASELINE)


LIFT_SQL = f"""
WITH {PER_QUERY_CTES},
best_config AS (SELECT * FROM metrics ORDER BY success_at_1 DESC, config LIMIT 1)
SELECT b.config AS baseline, t.config AS best, b.success_at_1 AS baseline_success_at_1,
       t.success_at_1 AS best_success_at_1, printf('%+.1f', (t.success_at_1 - b.success_at_1) * 100) AS gain_points
FROM metrics b JOIN best_config t ON true
WHERE b.config = 'baseline-newest' AND t.config <> 'baseline-newest'
"""


def report_summary(spark, sf_dir):
    """The configuration metrics as report text."""
    return summary_rows(config_metrics(_per_query(spark, sf_dir)))


SUMMARY_SQL = f"""
WITH {PER_QUERY_CTES}
SELECT config, num_queries, {", ".join(
    f"printf('%.4f', {m}) AS {m}" for m in
    ("success_at_1", "success_at_3", "mrr_at_10", "ndcg_at_10", "found_rate", "zero_result_rate"))}
FROM metrics
"""


def report_detail(spark, sf_dir):
    """The per-query metrics as report text."""
    return detail_rows(_per_query(spark, sf_dir))


DETAIL_SQL = f"""
WITH {PER_QUERY_CTES}
SELECT config, query, intended_id, coalesce(rank::VARCHAR, '') AS rank, num_results,
       printf('%.4f', ndcg_at_10) AS ndcg_at_10
FROM per_query
"""

QUERIES = {
    "judgment_groups": judgment_groups,
    "per_query_metrics": per_query_metrics,
    "configuration_metrics": configuration_metrics,
    "configuration_lift": configuration_lift,
    "report_summary": report_summary,
    "report_detail": report_detail,
}
ORACLE = {
    "judgment_groups": JUDGMENT_GROUPS_SQL,
    "per_query_metrics": PER_QUERY_SQL,
    "configuration_metrics": CONFIG_SQL,
    "configuration_lift": LIFT_SQL,
    "report_summary": SUMMARY_SQL,
    "report_detail": DETAIL_SQL,
}
