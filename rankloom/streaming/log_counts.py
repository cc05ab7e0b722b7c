"""Counts of logged queries kept up to date as the log grows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from rankloom.operators.log_mining import zero_result_queries
from rankloom.sources.query_log import parse_log, split_malformed
from rankloom.sources.versions import BucketedTable


def update_counts(
    lines: DataFrame,
    counts: BucketedTable,
    checkpoint: str,
    count: Callable[[DataFrame], DataFrame] = zero_result_queries,
) -> None:
    """Count what a stream of log ``lines(value[, pos])`` holds since the last call.

    ``count`` maps log rows to ``query, count[, first_pos]``. Its state is kept below
    ``checkpoint``, one row per distinct query and without a time limit, as a query may
    come again at any time. Every call takes the new files and ends. Only changed counts
    are written; they are totals, so a batch that is run again after a failure does
    not count twice. Malformed lines are left out.
    """

    def write(batch: DataFrame, number: int) -> None:
        changed = batch.withColumn("file", F.lit("")).withColumn("pos", F.lit(number))
        counts.upsert(changed, "query")

    (
        count(split_malformed(parse_log(lines))[0])
        .writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
