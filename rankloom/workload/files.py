"""The tables written as the files the readers expect, and read back through them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from rankloom.functions.text import display_score
from rankloom.operators.canonical import clean_delivery, delivery_records
from rankloom.operators.log_mining import log_totals, zero_result_queries
from rankloom.operators.vectors import without_vector
from rankloom.plans.ingest import document_count, load_documents, variant_tables
from rankloom.session import scratch_path
from rankloom.sources.best_bets import bet_keys, read_best_bets
from rankloom.sources.content import read_content, read_delivery
from rankloom.sources.judgments import read_judgments
from rankloom.sources.large_json import read_large_content, write_arrays
from rankloom.sources.query_log import append_log, read_log, split_malformed
from rankloom.sources.sinks import CSV_OPTIONS, preview, write_canonical, write_reports
from rankloom.sources.synonym_files import read_rules
from rankloom.workload.content import (
    CANONICAL_RECORDS_SQL,
    DELIVERY_SQL,
    JUDGMENTS_SQL,
    canonical_records,
    page_items,
    raw_judgments,
)
from rankloom.workload.logs import ZERO_SQL, log_lines
from rankloom.workload.tables import as_of, table

SPLITS = 8


def large_export(spark, sf_dir):
    """Whole pages in files that hold one array each, every file read in several splits."""
    path = scratch_path(spark, "export")
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    write_arrays(pages, path)
    longest = spark.read.text(path).agg(F.max("_metadata.file_size")).first()[0]
    found = read_large_content(spark, path, "*.txt", split_bytes=longest // SPLITS + 1)
    return found.select(
        F.variant_get("record", "$.page_id", "bigint").alias("page_id"),
        F.variant_get("record", "$.url", "string").alias("url"),
        F.md5(F.variant_get("record", "$.html", "string").cast("binary")).alias("html_md5"),
    )


LARGE_EXPORT_SQL = "SELECT page_id, url, md5(html) AS html_md5 FROM pages"


def folder_scan(spark, sf_dir):
    """Pages from a folder of files with an object a line, each file taken as one text."""
    path = scratch_path(spark, "folder")
    table(spark, sf_dir, "pages").select("page_id", "url").write.option("maxRecordsPerFile", 1000).json(path)
    return read_content(spark, path).select(
        F.variant_get("record", "$.page_id", "bigint").alias("page_id"),
        F.variant_get("record", "$.url", "string").alias("url"),
    )


FOLDER_SCAN_SQL = "SELECT page_id, url FROM pages"


def canonical_files(spark, sf_dir):
    """Canonical documents written and loaded again."""
    path = scratch_path(spark, "canonical")
    docs = canonical_records(spark, sf_dir).withColumn("tags", F.split("tags", ","))
    write_canonical(docs, path)
    loaded = load_documents(spark, path, as_of(), read=read_large_content)
    return loaded.drop("file", "pos").withColumn("tags", F.array_join("tags", ","))


def first_documents(spark, sf_dir):
    """The first ten records of a folder, in the order of its files."""
    path = scratch_path(spark, "ordered")
    table(spark, sf_dir, "pages").select("page_id", "url").orderBy("page_id").write.json(path)
    return preview(read_large_content(spark, path), 10).select(
        F.variant_get("record", "$.page_id", "bigint").alias("page_id")
    )


FIRST_DOCUMENTS_SQL = "SELECT page_id FROM pages ORDER BY page_id LIMIT 10"


def delivery_files(spark, sf_dir):
    """Delivery responses of twenty items each, landed as files and mapped."""
    path = scratch_path(spark, "delivery")
    pages = page_items(spark, sf_dir).withColumn("response", F.floor(F.col("id").cast("long") / 20))
    responses = pages.groupBy("response").agg(
        F.collect_list(F.struct("id", "__typename", "url", "fields")).alias("results")
    )
    write_arrays(responses.select("results"), path)
    mapped = delivery_records(
        read_delivery(spark, path), "https://www.example.org/", body_fields=("Intro", "Content"), tags_field="Tags"
    )
    return clean_delivery(mapped, as_of()).withColumn("tags", F.array_join("tags", ","))


def judgment_files(spark, sf_dir):
    """Judgments written as CSV and read back."""
    path = scratch_path(spark, "judgments")
    raw_judgments(spark, sf_dir).write.options(**CSV_OPTIONS).csv(path, header=True)
    return read_judgments(spark, path).withColumn("relevance", F.col("relevance").cast("long"))


def best_bet_files(spark, sf_dir):
    """Entries for every passage in files of a hundred, with one entry that is no object."""
    path = scratch_path(spark, "bets")
    item = F.struct(
        F.array(F.concat(F.lit("Item-"), "item_id"), F.concat(F.lit("né "), "item_id")).alias("triggers"),
        F.col("item_id").cast("string").alias("id"),
        F.col("text").alias("title"),
        F.concat(F.lit("/p/"), "item_id").alias("url"),
    )
    entries = table(spark, sf_dir, "benchmark").groupBy(F.floor(F.col("item_id") / 100)).agg(
        F.array_join(F.array_append(F.collect_list(F.to_json(item)), F.lit('"no entry"')), ",").alias("list")
    )
    entries.select(F.concat(F.lit('{"entries":['), "list", F.lit("]}")).alias("value")).repartition("value").write.option(
        "maxRecordsPerFile", 1
    ).text(path)
    return bet_keys(read_best_bets(spark, path)).select("key", "id", "title", "url", "note")


BEST_BET_FILES_SQL = """
SELECT unnest(['item ' || item_id, 'item' || item_id, 'ne ' || item_id, 'ne' || item_id]) AS key,
       item_id::VARCHAR AS id, text AS title, '/p/' || item_id AS url, '' AS note
FROM benchmark
"""


def rule_files(spark, sf_dir):
    """A rule for every document in text files, between comments and blank lines."""
    path = scratch_path(spark, "rules")
    lines = table(spark, sf_dir, "documents").select(
        F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("# "), "source"))
        .when(F.col("doc_id") % 5 == 1, F.lit("  "))
        .when(F.col("doc_id") % 5 == 2, F.concat("lang", F.lit(" ,, "), "source", F.lit(" => d"), "doc_id"))
        .otherwise(F.concat(F.lit(" "), "lang", F.lit(" , d"), "doc_id"))
        .alias("value")
    )
    lines.write.option("maxRecordsPerFile", 100_000).text(path)
    rules = read_rules(spark, path)
    return rules.select(
        "raw", "kind", F.array_join("left", "|").alias("left_terms"), F.array_join("right", "|").alias("right_terms")
    )


RULE_FILES_SQL = """
SELECT lang || ' ,, ' || source || ' => d' || doc_id AS raw, 'directional' AS kind,
       lang || '|' || source AS left_terms, 'd' || doc_id AS right_terms
FROM documents WHERE doc_id % 5 = 2
UNION ALL
SELECT lang || ' , d' || doc_id, 'equivalency', lang || '|d' || doc_id, '' FROM documents WHERE doc_id % 5 > 2
"""


def log_files(spark, sf_dir):
    """Queries that found nothing, from log files with malformed lines."""
    path = scratch_path(spark, "log-files")
    log_lines(spark, sf_dir).select("value").write.text(path)
    good, _ = split_malformed(read_log(spark, path))
    return zero_result_queries(good).select("query", "count")


LOG_FILES_SQL = f"SELECT query, count FROM ({ZERO_SQL})"


def log_appended(spark, sf_dir):
    """Totals of a log that was appended to once for each type of event."""
    path = scratch_path(spark, "log-appended")
    records = table(spark, sf_dir, "events").select(
        "event_type",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.concat(F.lit("user "), "user_id").alias("query"),
        F.lit("tuned").alias("index"),
        F.lit("keyword").alias("mode"),
        (F.col("event_id") % 5).cast("int").alias("num_results"),
        F.array(F.col("event_id").cast("string")).alias("top_ids"),
        F.lit(False).alias("curated"),
        F.lit(None).cast("string").alias("fallback"),
    )
    append_log(records.where("event_type = 'click'").drop("event_type"), path)
    append_log(records.where("event_type <> 'click'").drop("event_type"), path)
    return log_totals(split_malformed(read_log(spark, path))[0])


LOG_APPENDED_SQL = """
SELECT count(*) AS total_queries,
       count(DISTINCT CASE WHEN event_id % 5 = 0 THEN user_id END) AS zero_result_queries,
       count(DISTINCT CASE WHEN event_id % 5 IN (1, 2) THEN user_id END) AS low_result_queries
FROM events
"""


def report_files(spark, sf_dir):
    """Reports on how labelled documents of every source fare, read back from their CSV files."""
    path = scratch_path(spark, "reports")
    rank = F.when(F.col("quality") == 1, 1 + F.col("doc_id") % 10)
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents"), "doc_id").select(
        F.col("source").alias("config"),
        F.concat(F.lit(' say "'), "doc_id", F.lit('", twice')).alias("query"),
        F.col("doc_id").cast("string").alias("intended_id"),
        rank.alias("rank"),
        F.lit(10).alias("num_results"),
        F.coalesce(1 / rank, F.lit(0.0)).alias("ndcg_at_10"),
    )
    share = lambda condition: F.avg(F.coalesce(condition, F.lit(False)).cast("int"))
    configs = rows.groupBy("config").agg(
        share(F.col("rank") <= 1).alias("success_at_1"),
        share(F.col("rank") <= 3).alias("success_at_3"),
        F.avg("ndcg_at_10").alias("mrr_at_10"),
        F.avg("ndcg_at_10").alias("ndcg_at_10"),
        share(F.col("rank").isNotNull()).alias("found_rate"),
        F.lit(0.0).alias("zero_result_rate"),
        F.count(F.lit(1)).alias("num_queries"),
    )
    write_reports(configs, rows, path)
    read = spark.read.option("escape", '"')
    detail = read.csv(f"{path}/relevance-per-query", header=True)
    summary = read.csv(f"{path}/relevance-summary", header=True)
    return detail.join(summary.select("config", "num_queries", "found_rate"), "config").select(
        "config", "query", "intended_id", F.coalesce("rank", F.lit("")).alias("rank"),
        F.col("ndcg_at_10").alias("ndcg"), "num_queries", "found_rate",
    )


REPORT_FILES_SQL = """
SELECT source AS config, ' say "' || doc_id || '", twice' AS query, doc_id::VARCHAR AS intended_id,
       CASE WHEN quality = 1 THEN (1 + doc_id % 10)::VARCHAR ELSE '' END AS rank,
       printf('%.4f', CASE WHEN quality = 1 THEN 1.0 / (1 + doc_id % 10) ELSE 0.0 END::DOUBLE) AS ndcg,
       (count(*) OVER (PARTITION BY source))::VARCHAR AS num_queries,
       printf('%.4f', avg((quality IS NOT DISTINCT FROM 1)::INT) OVER (PARTITION BY source)) AS found_rate
FROM labels JOIN documents USING (doc_id)
"""


def variant_counts(spark, sf_dir):
    """Documents of each variant, and those that have a vector."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("body"))
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    counts = []
    for name, variant in variant_tables(docs, vectors).items():
        plain = without_vector(variant)
        kinds = {"all": plain}
        if "contentVector" in variant.columns:
            kinds["with vector"] = variant.where("contentVector IS NOT NULL")
        for kind, rows in kinds.items():
            counts.append(
                document_count(rows).select(
                    F.lit(name).alias("variant"),
                    F.lit(kind).alias("kind"),
                    F.lit(",".join(plain.columns)).alias("columns"),
                    "documents",
                )
            )
    return reduce(DataFrame.unionByName, counts)


VARIANT_COUNTS_SQL = """
SELECT 'baseline' AS variant, 'all' AS kind, 'id,body' AS columns, count(*) AS documents FROM documents
UNION ALL
SELECT 'tuned', 'all', 'id,body', count(*) FROM documents
UNION ALL
SELECT 'tuned', 'with vector', 'id,body', count(*)
FROM documents WHERE doc_id IN (SELECT vec_id FROM embeddings WHERE embedding IS NOT NULL)
"""


def display_scores(spark, sf_dir):
    """The score shown for every order line: the discount as reranked score, else the quantity."""
    shown = display_score(F.col("l_quantity").cast("double"), F.col("l_discount").cast("double"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", shown.alias("shown"))


DISPLAY_SCORES_SQL = """
SELECT l_orderkey, l_linenumber, CASE WHEN l_discount <> 0 THEN l_discount ELSE l_quantity END::DOUBLE AS shown
FROM lineitem
"""

QUERIES = {
    "large_export": large_export,
    "folder_scan": folder_scan,
    "canonical_files": canonical_files,
    "first_documents": first_documents,
    "delivery_files": delivery_files,
    "judgment_files": judgment_files,
    "best_bet_files": best_bet_files,
    "rule_files": rule_files,
    "log_files": log_files,
    "log_appended": log_appended,
    "report_files": report_files,
    "variant_counts": variant_counts,
    "display_scores": display_scores,
}
ORACLE = {
    "large_export": LARGE_EXPORT_SQL,
    "folder_scan": FOLDER_SCAN_SQL,
    "canonical_files": CANONICAL_RECORDS_SQL,
    "first_documents": FIRST_DOCUMENTS_SQL,
    "delivery_files": DELIVERY_SQL,
    "judgment_files": JUDGMENTS_SQL,
    "best_bet_files": BEST_BET_FILES_SQL,
    "rule_files": RULE_FILES_SQL,
    "log_files": LOG_FILES_SQL,
    "log_appended": LOG_APPENDED_SQL,
    "report_files": REPORT_FILES_SQL,
    "variant_counts": VARIANT_COUNTS_SQL,
    "display_scores": DISPLAY_SCORES_SQL,
}
