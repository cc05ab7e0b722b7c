"""Exact filters, facet counts and ordering by field."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F, types as T

# What each canonical field may be used for (fixed values).
FILTERABLE = ("id", "tags", "contentType", "lastModified")
FACETABLE = ("tags", "contentType")
SORTABLE = ("lastModified",)


def filter_documents(docs: DataFrame, equal: Mapping[str, object]) -> DataFrame:
    """Documents with the given value in every named field; lists must contain it."""
    for name, value in equal.items():
        if name not in FILTERABLE:
            raise ValueError(f"{name} is not filterable")
        is_list = isinstance(docs.schema[name].dataType, T.ArrayType)
        docs = docs.where(F.array_contains(name, value) if is_list else F.col(name) == value)
    return docs


def facet_counts(docs: DataFrame, field: str) -> DataFrame:
    """``value, count`` of a facet field; a document counts once per distinct value."""
    if isinstance(docs.schema[field].dataType, T.ArrayType):
        values = docs.select(F.explode(F.array_distinct(field)).alias("value"))
    else:
        values = docs.select(F.col(field).alias("value")).where(F.col("value").isNotNull())
    return values.groupBy("value").agg(F.count(F.lit(1)).alias("count"))


def newest_first(docs: DataFrame, top: int | None = None) -> DataFrame:
    """Documents by date, newest first, ties by id."""
    ordered = docs.orderBy(F.col("lastModified").desc_nulls_last(), "id")
    return ordered if top is None else ordered.limit(top)
