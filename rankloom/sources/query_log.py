"""The append-only query log: one JSON object per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

LOG_SCHEMA = (
    "timestamp string, query string, index string, mode string, num_results int, "
    "top_ids array<string>, curated boolean, fallback string"
)
CORRUPT = "_malformed"
MAX_LOGGED_IDS = 5


def parse_log(lines: DataFrame, line: str = "value") -> DataFrame:
    """Log lines as columns plus ``_malformed`` holding lines that are no JSON.

    Blank lines are skipped. ``pos`` is a column of the input and is kept when
    present, so that first-seen order survives.
    """
    keep = [c for c in ("pos",) if c in lines.columns]
    parsed = F.from_json(
        F.col(line),
        f"{LOG_SCHEMA}, {CORRUPT} string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )
    return lines.where(F.trim(F.col(line)) != "").select(*keep, parsed.alias("r")).select(*keep, "r.*")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The log at ``path``; ``pos`` orders the rows as they were written.

    Files are appended in name order, and within a file by block and row, which
    is what ``pos`` compares.
    """
    lines = spark.read.text(path).select(
        "value",
        F.struct(
            F.col("_metadata.file_name").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("pos"),
    )
    return parse_log(lines)


def split_malformed(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Readable rows, and the malformed lines."""
    good = log.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, log.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("line"))


def log_rows(
    queries: DataFrame,
    results: DataFrame,
    index: str,
    mode: str,
    written_at,
    top_ids: int = MAX_LOGGED_IDS,
) -> DataFrame:
    """One log record per query of ``queries(query_id, query[, curated, fallback])``.

    ``results`` are final rows, so ``num_results`` counts them after pinning and
    capping. The ids are the first ``top_ids`` usable ones by rank.
    """
    per_query = results.groupBy("query_id").agg(
        F.count(F.lit(1)).cast("int").alias("num_results"),
        F.slice(
            F.transform(
                F.array_sort(
                    F.collect_list(
                        F.when(F.col("id").cast("string") != "", F.struct("rank", F.col("id").cast("string").alias("id")))
                    )
                ),
                lambda r: r["id"],
            ),
            1,
            top_ids,
        ).alias("top_ids"),
    )
    curated = F.col("curated") if "curated" in queries.columns else F.lit(False)
    fallback = F.col("fallback") if "fallback" in queries.columns else F.lit(None).cast("string")
    return queries.join(per_query, "query_id", "left").select(
        F.date_format(written_at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("timestamp"),
        "query",
        F.lit(index).alias("index"),
        F.lit(mode).alias("mode"),
        F.coalesce("num_results", F.lit(0)).alias("num_results"),
        F.coalesce("top_ids", F.array().cast("array<string>")).alias("top_ids"),
        curated.alias("curated"),
        fallback.alias("fallback"),
    )


def append_log(rows: DataFrame, path: str) -> None:
    """Append the records as JSON lines; absent values are written as null."""
    rows.write.mode("append").option("ignoreNullFields", "false").json(path)
