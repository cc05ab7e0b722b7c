"""Synonym rules, one per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rankloom.functions.text import collapse_ends, split_terms


def parse_rules(texts: DataFrame, text: str = "value", file: str = "file") -> DataFrame:
    """``file, line_no, raw, kind, left, right`` of every rule line.

    Blank lines and ``#`` comments are skipped; ``line_no`` is the physical line,
    counted from one. ``a, b => c`` is directional, a plain comma list makes its
    terms interchangeable.
    """
    lines = texts.select(
        F.col(file).alias("file"),
        F.posexplode(F.split(F.col(text), r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]")).alias("i", "line"),
    ).select("file", (F.col("i") + 1).alias("line_no"), collapse_ends("line").alias("raw"))
    rules = lines.where((F.col("raw") != "") & ~F.col("raw").startswith("#"))
    arrow = F.contains("raw", F.lit("=>"))
    sides = F.split("raw", "=>", 2)
    return rules.select(
        "file",
        "line_no",
        "raw",
        F.when(arrow, "directional").otherwise("equivalency").alias("kind"),
        split_terms(sides[0]).alias("left"),
        F.when(arrow, split_terms(F.get(sides, 1)))
        .otherwise(F.array().cast("array<string>"))
        .alias("right"),
    )


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rules of the ``*.txt`` files in a folder, or of one file."""
    texts = (
        spark.read.option("pathGlobFilter", "*.txt")
        .text(path, wholetext=True)
        .select("value", F.col("_metadata.file_name").alias("file"))
    )
    return parse_rules(texts)
