"""Sharding along a Hilbert curve through several metadata dimensions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from rankloom.session import stored

SHARDS = 40
BITS = 6
EXTRA_BYTES = 16


def category_level(value: Column, bits: int = BITS) -> Column:
    """A level of a categorical value: equal values meet, null is level 0."""
    return F.when(value.isNull(), 0).otherwise(F.pmod(F.xxhash64(value), F.lit(1 << bits))).cast("int")


def amount_level(value: Column, bits: int = BITS) -> Column:
    """A level of a non-negative amount on a logarithmic scale, in its order; null is level 0."""
    steps = F.floor(F.log2(F.greatest(F.coalesce(value, F.lit(0)), F.lit(0)).cast("double") + 1) * (1 << bits) / 32)
    return F.least(steps, F.lit((1 << bits) - 1)).cast("int")


def hilbert_index(levels: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of points given as ``(dimensions, points)`` levels.

    Skilling's transposition: undo the excess work of the Gray code from the top bit
    down, then read the bits of all dimensions across.
    """
    x = levels.astype(np.int64).copy()
    dims = len(x)
    bit = 1 << (bits - 1)
    while bit > 1:
        low = bit - 1
        for d in range(dims):
            on = (x[d] & bit) != 0
            swap = np.where(on, 0, (x[0] ^ x[d]) & low)
            x[0] ^= np.where(on, low, swap)
            x[d] ^= swap
        bit >>= 1
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    turn = np.zeros_like(x[0])
    bit = 1 << (bits - 1)
    while bit > 1:
        turn ^= np.where((x[dims - 1] & bit) != 0, bit - 1, 0)
        bit >>= 1
    x ^= turn
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for d in range(dims):
            out = (out << 1) | ((x[d] >> b) & 1)
    return out


def curve_place(*levels: Column, bits: int = BITS) -> Column:
    """The Hilbert index of integer levels below ``2**bits``."""
    if bits * len(levels) > 62:
        raise ValueError("the curve index has to fit 62 bits")

    @F.pandas_udf(T.LongType())
    def place(*columns: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index(np.stack([c.to_numpy() for c in columns]), bits))

    return place(*levels)


def with_rank(df: DataFrame, *order: str) -> DataFrame:
    """``df`` with a gapless ``rank`` from 0 in the given order, without a single-task window.

    Rows are range-partitioned and sorted once and stored with their place in their
    partition; one count per partition gives the partition's offset.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(ordered.withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_at", 33)
    counts = placed.groupBy(part.alias("part")).count().orderBy("part").collect()  # a row per partition
    offsets, total = {}, 0
    for row in counts:
        offsets[row["part"]], total = total, total + row["count"]
    spark = df.sparkSession
    table = F.broadcast(spark.createDataFrame(list(offsets.items()) or [(0, 0)], "_part long, _offset long"))
    rank = F.col("_offset") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    ranked = placed.withColumn("_part", part).join(table, "_part").withColumn("rank", rank)
    return ranked.withColumn("total", F.lit(total).cast("long")).drop("_at", "_part", "_offset")


def hilbert_shards(
    docs: DataFrame,
    shards: int = SHARDS,
    bits: int = BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
    categories: tuple[str, ...] = ("lang", "source"),
    amounts: tuple[str, ...] = ("n_chars",),
) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard, curve, <dimensions>``.

    Rows are ordered by their place on the Hilbert curve through the dimensions, then
    by id and text, and cut into ``shards`` runs whose counts differ by at most one
    (law ``rows``); ``slot`` is the place within the shard. Rows near each other on the
    curve have similar metadata, so files of a shard have narrow ranges in every
    dimension (see :func:`shard_extents`).

    Null metadata is level 0, a null text has no bytes, null ids come first. Rows
    equal in everything take neighbouring places. An empty table gives no rows. Other
    columns are ignored; the text itself is not moved.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    named = [F.col(c).alias(f"d{k}") for k, c in enumerate((*categories, *amounts))]
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + EXTRA_BYTES).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        *named,
    )
    levels = [category_level(F.col(f"d{k}").cast("string"), bits) for k in range(len(categories))]
    levels += [amount_level(F.col(f"d{len(categories) + k}"), bits) for k in range(len(amounts))]
    ranked = with_rank(rows.withColumn("curve", curve_place(*levels, bits=bits)), "curve", "doc_id", "text_crc32", "size")
    # whole-number arithmetic: double division is off for large tables
    shard = F.expr(f"int((rank * {int(shards)}L) div total)")
    first = F.expr("(shard * total + {0} - 1) div {0}".format(int(shards)))
    return ranked.withColumn("shard", shard).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (F.col("rank") - first).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
        *(F.col(f"d{k}").alias(c) for k, c in enumerate((*categories, *amounts))),
    )


def shard_extents(placed: DataFrame, *dimensions: str) -> DataFrame:
    """Per shard the smallest and largest value of each dimension, for file pruning."""
    bounds = [f(d).alias(f"{name}_{d}") for d in dimensions for name, f in (("min", F.min), ("max", F.max))]
    return placed.groupBy("shard").agg(F.count("*").alias("n_rows"), F.sum("size").alias("bytes"), *bounds)


def write_shards(docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write ``docs`` below ``path`` in one folder ``shard=<n>`` per shard, in slot order.

    ``placed`` is what :func:`hilbert_shards` returned for them. Ids must be unique and not
    null: a place names its row by its id. Files hold the columns of ``docs`` but one named
    ``shard``, which is an error, as the folders are named so.
    """
    if "shard" in (c.lower() for c in docs.columns):
        raise ValueError("the documents have a column named shard already")
    columns = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    rows = docs.select(columns.alias("row"), F.col(f"`{id_col}`").alias("id"))
    places = placed.select(F.col("doc_id").alias("id"), F.col("shard").alias("place"), "slot")
    ordered = rows.join(places, "id").repartitionByRange("place", "slot").sortWithinPartitions("place", "slot")
    ordered.select("row.*", F.col("place").alias("shard")).write.partitionBy("shard").parquet(path)
