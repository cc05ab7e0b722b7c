"""Tables that change: versions, their statistics, and a log that grows."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankloom.plans.collection import collection_statistics, upsert_documents
from rankloom.session import scratch_path
from rankloom.sources.versions import BucketedTable
from rankloom.streaming.log_counts import update_counts
from rankloom.workload.content import UPSERT_SQL
from rankloom.workload.logs import ZERO_SQL, log_lines
from rankloom.workload.tables import table, words_sql

BUCKETS = 16


def upsert_versions(spark, sf_dir):
    """Everything but clicks as the first version, clicks on top as the second."""
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("id"),
        F.col("event_type").alias("file"),
        F.col("event_id").alias("pos"),
        "event_id",
        "value",
    )
    users = BucketedTable(spark, scratch_path(spark, "versions"), BUCKETS)
    users.upsert(events.where("file <> 'click'"))
    users.upsert(events.where("file = 'click'"))
    return users.read()


def statistics_after_upsert(spark, sf_dir):
    """Term statistics after the English documents came again with their source before the text."""
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), "text", "lang", "source", F.lit("").alias("file"), F.lit(0).alias("pos")
    )
    english = docs.where("lang = 'en'").withColumn("text", F.concat_ws(" ", "source", "text"))
    folder = scratch_path(spark, "collection")
    collection = BucketedTable(spark, f"{folder}/documents", BUCKETS)
    statistics = BucketedTable(spark, f"{folder}/statistics", BUCKETS)
    for incoming in (docs, english):
        upsert_documents(collection, statistics, incoming, {"body": "text"})
    return collection_statistics(statistics).select("term", "df", "total_len")


STATISTICS_AFTER_SQL = f"""
WITH d AS (
    SELECT doc_id, {words_sql("CASE WHEN lang = 'en' THEN concat_ws(' ', source, text) ELSE text END")} AS toks
    FROM documents
)
SELECT term, count(*) AS df, sum(dl)::BIGINT AS total_len
FROM (SELECT DISTINCT doc_id, len(toks) AS dl, unnest(list_append(toks, '')) AS term FROM d)
GROUP BY term
"""


def zero_results_stream(spark, sf_dir):
    """Queries that found nothing, counted while the log grows in three steps."""
    folder = scratch_path(spark, "log")
    lines = log_lines(spark, sf_dir)
    counts = BucketedTable(spark, f"{folder}/counts", BUCKETS)
    for step in range(3):
        lines.where(F.pmod("pos", F.lit(3)) == step).write.mode("append").parquet(f"{folder}/lines")
        stream = spark.readStream.schema(lines.schema).parquet(f"{folder}/lines")
        update_counts(stream, counts, f"{folder}/checkpoint")
    return counts.read().select("query", "count", "first_pos")


QUERIES = {
    "upsert_versions": upsert_versions,
    "statistics_after_upsert": statistics_after_upsert,
    "zero_results_stream": zero_results_stream,
}
ORACLE = {
    "upsert_versions": UPSERT_SQL,
    "statistics_after_upsert": STATISTICS_AFTER_SQL,
    "zero_results_stream": ZERO_SQL,
}
