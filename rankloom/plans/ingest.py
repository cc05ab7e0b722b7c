"""From content folders to the document tables of both variants."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rankloom.functions.dates import parse_modified
from rankloom.operators.canonical import canonicalise, latest_by_key, require_id
from rankloom.operators.vectors import attach_vectors
from rankloom.sources.content import read_content

VARIANTS = ("baseline", "tuned")


def load_documents(
    spark: SparkSession, folder: str, as_of: Column, read: Callable[..., DataFrame] = read_content
) -> DataFrame:
    """Canonical documents of a folder in source order columns ``file, pos``.

    ``read`` is ``read_content``, a file a row, or ``read_large_content``, which cuts files.
    """
    return require_id(canonicalise(read(spark, folder), as_of))


def current_documents(docs: DataFrame) -> DataFrame:
    """One document per id, the last one sent."""
    return latest_by_key(docs, "id", ["file", "pos"]).drop("file", "pos")


def typed(docs: DataFrame) -> DataFrame:
    """Documents as loaded: ``lastModified`` becomes a timestamp."""
    return docs.withColumn("lastModified", parse_modified("lastModified"))


def variant_tables(
    docs: DataFrame, vectors: DataFrame | None = None, variants=VARIANTS
) -> dict[str, DataFrame]:
    """The document table of each variant; only ``tuned`` ever has vectors."""
    tables = {}
    for variant in variants:
        if variant not in VARIANTS:
            raise ValueError(f"unknown variant {variant!r}")
        with_vectors = variant == "tuned" and vectors is not None
        tables[variant] = attach_vectors(docs, vectors) if with_vectors else docs.drop("contentVector")
    return tables


def document_count(docs: DataFrame) -> DataFrame:
    return docs.agg(F.count(F.lit(1)).alias("documents"))
