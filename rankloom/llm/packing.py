"""Rows beside keys of their own, so that no name of a column can clash."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

ROW = "row"


def packed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row, id, text_hash``: all columns of ``docs`` in one struct, the id as a long, and a hash of the text."""
    columns = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.select(columns.alias(ROW), F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(text).alias("text_hash"))


def unpacked(rows: DataFrame) -> DataFrame:
    """The columns of the packed rows."""
    return rows.select(f"{ROW}.*")
