"""Term statistics kept beside a collection that changes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from rankloom.operators.postings import held_terms
from rankloom.sources.versions import BUCKET, BucketedTable


def upsert_documents(
    docs: BucketedTable,
    statistics: BucketedTable,
    incoming: DataFrame,
    fields: Mapping[str, Column | str],
    key: str = "id",
) -> None:
    """Put documents on top and bring the statistics of their buckets up to date.

    Statistics are kept per bucket of documents, so those of replaced texts go with
    their bucket and documents in untouched buckets are not read. Both tables have the
    same number of buckets. Where this fails between the two, it is to be run again.
    """
    if docs.buckets != statistics.buckets:
        raise ValueError("documents and statistics have the same number of buckets")
    touched = docs.upsert(incoming, key)
    # A key has one row, so its terms need not meet before they are counted.
    changed = held_terms(docs.read(only=touched), fields, key).withColumn(BUCKET, docs.bucket_of("id"))
    rows = changed.groupBy(BUCKET, "field", "term").agg(
        F.count(F.lit(1)).alias("df"), F.sum(F.col("len").cast("long")).alias("total_len")
    )
    statistics.replace(rows, touched)


def collection_statistics(statistics: BucketedTable) -> DataFrame:
    """``field, term, df, total_len`` of the whole collection, summed over its buckets."""
    return statistics.read().groupBy("field", "term").agg(
        F.sum("df").alias("df"), F.sum("total_len").alias("total_len")
    )
