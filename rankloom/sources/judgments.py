"""Relevance judgments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rankloom.functions.text import blank_to_null

DEFAULT_GRADE = 3
MAX_GRADE = 3


def parse_grade(value) -> Column:
    """Blank means the top grade; anything but an integer 0..3 fails the job."""
    text = blank_to_null(value)
    number = text.try_cast("int")
    return (
        F.when(text.isNull(), F.lit(DEFAULT_GRADE))
        .when(number.between(0, MAX_GRADE), number)
        .otherwise(
            F.raise_error(F.concat(F.lit("relevance must be 0 to 3, got "), text)).cast("int")
        )
    )


def clean_judgments(rows: DataFrame) -> DataFrame:
    """``query, intended_id, relevance`` from raw text columns.

    ``intended_url`` stands in where ``intended_id`` is blank; rows without a
    query or an intended document are dropped.
    """
    intended = [F.col(c) for c in ("intended_id", "intended_url") if c in rows.columns]
    first = [F.nullif(c, F.lit("")) for c in intended]
    grade = F.col("relevance") if "relevance" in rows.columns else F.lit(None).cast("string")
    return (
        rows.select(
            blank_to_null("query").alias("query"),
            blank_to_null(F.coalesce(*first)).alias("intended_id"),
            grade.alias("relevance"),
        )
        .where(F.col("query").isNotNull() & F.col("intended_id").isNotNull())
        .withColumn("relevance", parse_grade("relevance"))
    )


def read_judgments(spark: SparkSession, path: str) -> DataFrame:
    """Judgments of a CSV file with a header; an error when no row is usable."""
    judgments = clean_judgments(
        spark.read.csv(path, header=True, multiLine=True, escape='"')
    )
    if judgments.isEmpty():
        raise ValueError(f"no usable judgments in {path}: need 'query' and 'intended_id'")
    return judgments
