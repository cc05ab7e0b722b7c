"""Mining a query log made of the events."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankloom.operators.log_mining import (
    log_totals,
    low_result_queries,
    most_common,
    zero_result_queries,
)
from rankloom.sources.query_log import parse_log, split_malformed
from rankloom.workload.tables import table


def log_lines(spark, sf_dir):
    """One log line per event.

    The number of results comes from the event properties. Some lines lack it, some
    have a blank query, and error events with a high value are cut short.
    """
    k = F.get_json_object("props", "$.k").cast("int")
    query = F.when(k % 10 == 9, " ").otherwise(F.concat(F.lit(" "), "event_type", F.lit(" "), "user_id"))
    line = F.to_json(
        F.struct(
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
            query.alias("query"),
            F.when(k % 7 != 0, k % 5).alias("num_results"),
            F.array(F.col("event_id").cast("string")).alias("top_ids"),
        )
    )
    cut = (F.col("event_type") == "error") & (F.col("value") > 30)
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("pos"),
        F.when(cut, F.substr(line, F.lit(1), F.length(line) - 5)).otherwise(line).alias("value"),
    )


def _log(spark, sf_dir):
    return split_malformed(parse_log(log_lines(spark, sf_dir)))[0]


LOG_SQL = """
log AS (
    SELECT event_id AS pos,
           CASE WHEN k % 10 = 9 THEN '' ELSE event_type || ' ' || user_id END AS query,
           CASE WHEN k % 7 <> 0 THEN k % 5 ELSE 0 END AS n
    FROM (SELECT *, (props->>'$.k')::INT AS k FROM events)
    WHERE NOT (event_type = 'error' AND value > 30)
)"""


def log_scan(spark, sf_dir):
    """Readable and malformed lines of the log."""
    good, bad = split_malformed(parse_log(log_lines(spark, sf_dir)))
    return (
        good.select(F.lit("readable").alias("kind"))
        .unionByName(bad.select(F.lit("malformed").alias("kind")))
        .groupBy("kind")
        .agg(F.count(F.lit(1)).alias("lines"))
    )


LOG_SCAN_SQL = """
SELECT CASE WHEN event_type = 'error' AND value > 30 THEN 'malformed' ELSE 'readable' END AS kind, count(*) AS lines
FROM events GROUP BY ALL
"""


def zero_results(spark, sf_dir):
    """Queries that found nothing."""
    return zero_result_queries(_log(spark, sf_dir)).select("query", "count", "first_pos")


ZERO_SQL = f"""
WITH {LOG_SQL}
SELECT query, count(*) AS count, min(pos) AS first_pos FROM log WHERE n = 0 AND query <> '' GROUP BY query
"""


def low_results(spark, sf_dir):
    """Queries that found one or two documents."""
    return low_result_queries(_log(spark, sf_dir)).select("query", "count", "first_pos")


LOW_SQL = f"""
WITH {LOG_SQL}
SELECT query, count(*) AS count, min(pos) AS first_pos FROM log WHERE n > 0 AND n < 3 AND query <> '' GROUP BY query
"""


def top_zero_results(spark, sf_dir):
    """The ten most frequent of the queries without results."""
    return most_common(zero_result_queries(_log(spark, sf_dir)), 10).select("query", "count")


TOP_ZERO_SQL = f"""
WITH {LOG_SQL}
SELECT query, count(*) AS count FROM log WHERE n = 0 AND query <> ''
GROUP BY query ORDER BY count(*) DESC, min(pos) LIMIT 10
"""


def totals(spark, sf_dir):
    """Totals of the log."""
    return log_totals(_log(spark, sf_dir))


TOTALS_SQL = f"""
WITH {LOG_SQL}
SELECT count(*) AS total_queries,
       count(DISTINCT CASE WHEN n = 0 AND query <> '' THEN query END) AS zero_result_queries,
       count(DISTINCT CASE WHEN n > 0 AND n < 3 AND query <> '' THEN query END) AS low_result_queries
FROM log
"""

QUERIES = {
    "log_scan": log_scan,
    "zero_results": zero_results,
    "low_results": low_results,
    "top_zero_results": top_zero_results,
    "log_totals": totals,
}
ORACLE = {
    "log_scan": LOG_SCAN_SQL,
    "zero_results": ZERO_SQL,
    "low_results": LOW_SQL,
    "top_zero_results": TOP_ZERO_SQL,
    "log_totals": TOTALS_SQL,
}
