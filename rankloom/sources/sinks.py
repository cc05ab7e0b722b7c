"""Writers for canonical documents, versions of them, and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rankloom.operators.canonical import latest_by_key

METRICS = (
    "success_at_1",
    "success_at_3",
    "mrr_at_10",
    "ndcg_at_10",
    "found_rate",
    "zero_result_rate",
)
# Values as they are: blanks kept, quotes doubled, nothing for empty text.
CSV_OPTIONS = {
    "escape": '"',
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_canonical(docs: DataFrame, path: str) -> None:
    """Canonical documents as JSON lines."""
    docs.write.mode("errorifexists").option("ignoreNullFields", "false").json(path)


def upserted(current: DataFrame | None, incoming: DataFrame, key: str = "id") -> DataFrame:
    """The current table with every incoming row added or put in place.

    Incoming rows carry ``file`` and ``pos``; a row sent twice counts as last sent.
    Nothing is deleted.
    """
    latest = latest_by_key(incoming, key, ["file", "pos"]).drop("file", "pos")
    if current is None:
        return latest
    kept = current.join(latest.select(key), key, "left_anti")
    return kept.unionByName(latest)


def write_version(docs: DataFrame, path: str) -> None:
    """A table version as Parquet in a folder of its own; a failed row fails it all."""
    docs.write.mode("errorifexists").parquet(path)


def summary_rows(config_metrics: DataFrame) -> DataFrame:
    """Configuration metrics as report text, four decimals each."""
    return config_metrics.select(
        "config", *[F.format_string("%.4f", m).alias(m) for m in METRICS], "num_queries"
    )


def detail_rows(query_metrics: DataFrame) -> DataFrame:
    """Per-query metrics as report text; the rank is blank when nothing was found."""
    return query_metrics.select(
        "config",
        "query",
        "intended_id",
        F.coalesce(F.col("rank").cast("string"), F.lit("")).alias("rank"),
        "num_results",
        F.format_string("%.4f", "ndcg_at_10").alias("ndcg_at_10"),
    )


def write_reports(config_metrics: DataFrame, query_metrics: DataFrame, folder: str) -> None:
    """Summary and detail as CSV below ``folder``."""
    for name, rows in (
        ("relevance-summary", summary_rows(config_metrics)),
        ("relevance-per-query", detail_rows(query_metrics)),
    ):
        rows.write.mode("overwrite").options(**CSV_OPTIONS).csv(f"{folder}/{name}", header=True)


def preview(docs: DataFrame, n: int) -> DataFrame:
    """The first ``n`` documents in source order where the table carries one."""
    order = [c for c in ("file", "pos") if c in docs.columns]
    return (docs.orderBy(*order) if order else docs).limit(n)


def read_version(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
