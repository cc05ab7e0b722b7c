"""Line deduplication by range-partitioned hashes and per-document keep bitmaps."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from rankloom.session import stored

SPACES = "\t\n\x0b\x0c\r "
MIN_LENGTH = 10
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Stands for a null id, which counts as one document before all others.
NULL_ID = -(2**63)

_SURE, _OPEN, _LAST = 0, 1, 2


def line_key(line: Column) -> Column:
    """The line without white space at its ends and with A-Z in lower case."""
    tight = F.btrim(line, F.lit(SPACES))
    # lower() equals the A-Z mapping on ASCII and is much faster there
    return F.when(F.octet_length(tight) == F.length(tight), F.lower(tight)).otherwise(
        F.translate(tight, _UPPER, _LOWER)
    )


def _ids(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("_doc"),
        F.xxhash64(text).alias("_text_hash"),
        text.alias("_text"),
    )


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows to drop from one sorted range of hashes.

    A row whose document is not the first one of its run is dropped for sure.
    Rows of the first run's first document depend on the range before and leave
    as open rows; the last run is reported for the range behind.
    """
    names = ["kind", "h1", "h2", "doc", "text_hash", "pos"]
    head = run = None  # keys of the first and the current run
    first_doc = 0

    def rows(kind, columns, keep):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(int(keep.sum()), kind, dtype=np.int32)), *(pa.array(c[keep]) for c in columns)], names=names
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(5)]
        h1, h2, doc = columns[:3]
        fresh = np.empty(len(h1), dtype=bool)
        fresh[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        fresh[0] = run != (h1[0], h2[0])
        begun = np.maximum.accumulate(np.where(fresh, np.arange(len(h1)), -1))
        first = np.where(begun >= 0, doc[np.maximum(begun, 0)], first_doc)
        if head is None:
            head = (h1[0], h2[0])
        yield rows(_SURE, columns, doc != first)
        yield rows(_OPEN, columns, (doc == first) & (h1 == head[0]) & (h2 == head[1]))
        run, first_doc = (h1[-1], h2[-1]), first[-1]
        last = [np.array([v], dtype=np.int64) for v in (*run, first_doc, 0)] + [np.zeros(1, dtype=np.int32)]
    if run is not None:
        yield rows(_LAST, last, np.ones(1, dtype=bool))


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        maps, counts = [], []
        for positions in batch.column(2):
            gone = np.asarray(positions.values)
            bits = np.ones((int(gone.max()) // 8 + 1) * 8, dtype=np.uint8)  # whole bytes, kept at the end
            bits[gone] = 0
            maps.append(zlib.compress(np.packbits(bits, bitorder="little").tobytes()))
            counts.append(len(gone))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(maps, pa.binary())],
            names=["doc_id", "text_hash", "n_dropped", "keep_bitmap"],
        )


def keep_bitmaps(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH
) -> DataFrame:
    """``doc_id, text_hash, n_dropped, keep_bitmap`` of the documents that lose lines.

    Lines with equal keys of at least ``min_length`` code points stay only in the
    smallest id holding the key (there all of them). Line hashes of 128 bits are
    range-partitioned together with the id, so a line that a third of all
    documents hold spreads over many ranges, and each sorted range is streamed
    once. ``keep_bitmap`` is a zlib-compressed bit per line, lowest bit first,
    1 for kept; lines behind its end are kept, and so is every line of a document
    without a row here. Returns no text.

    Ids are integers. A null id counts as one document before all others. Rows that
    share an id are one document; ``text_hash`` (xxhash64 of the text, null as
    empty) tells their bitmaps apart. Null and empty texts are one empty line, too
    short to be dropped. Columns other than the two named are ignored.
    """
    lines = _ids(docs, id_col, text_col).select(
        "_doc", "_text_hash", F.posexplode(F.split("_text", "\n", -1)).alias("pos", "line")
    )
    keyed = lines.withColumn("key", line_key(F.col("line"))).filter(F.length("key") >= min_length)
    hashed = keyed.select(
        F.xxhash64("key").alias("h1"),
        F.xxhash64(F.lit(1), "key").alias("h2"),
        F.col("_doc").alias("doc"),
        F.col("_text_hash").alias("text_hash"),
        "pos",
    )
    ordered = hashed.repartitionByRange("h1", "h2", "doc").sortWithinPartitions("h1", "h2", "doc", "pos")
    found = stored(
        ordered.mapInArrow(_streamed, "kind int, h1 long, h2 long, doc long, text_hash long, pos int"), "lines"
    )
    earlier = found.filter(F.col("kind") == _LAST).groupBy("h1", "h2").agg(F.min("doc").alias("earliest"))
    opened = found.filter(F.col("kind") == _OPEN).join(earlier, ["h1", "h2"]).filter("earliest < doc")
    dropped = found.filter(F.col("kind") == _SURE).select("doc", "text_hash", "pos").unionByName(
        opened.select("doc", "text_hash", "pos")
    )
    # rows repeated as a whole name the same lines again
    gone = dropped.groupBy("doc", "text_hash").agg(F.collect_set("pos").alias("positions"))
    return gone.mapInArrow(_bitmaps, "doc_id long, text_hash long, n_dropped long, keep_bitmap binary")


@F.pandas_udf(T.StringType())
def _kept(texts: pd.Series, bitmaps: pd.Series) -> pd.Series:
    def one(text, bitmap):
        if bitmap is None:
            return None
        bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), dtype=np.uint8), bitorder="little")
        return "\n".join(line for k, line in enumerate(text.split("\n")) if k >= len(bits) or bits[k])

    return pd.Series([one(t, b) for t, b in zip(texts, bitmaps)], dtype=object)


def with_kept_text(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept``: texts without the lines their bitmap drops.

    Only texts with a bitmap pass Python; a null text gives an empty ``kept``.
    """
    ids = _ids(docs, id_col, text_col)
    maps = bitmaps.select(
        F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_text_hash"), "n_dropped", "keep_bitmap"
    )
    joined = ids.join(maps, ["_doc", "_text_hash"], "left")
    touched = F.when(F.col("keep_bitmap").isNotNull(), F.col("_text"))
    return joined.select(
        F.when(F.col("_doc") != NULL_ID, F.col("_doc")).alias("doc_id"),
        (F.length("_text") - F.length(F.replace("_text", F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce(_kept(touched, F.col("keep_bitmap")), F.col("_text")).alias("kept"),
    )


def deduplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Both steps; see :func:`keep_bitmaps` and :func:`with_kept_text`."""
    return with_kept_text(docs, keep_bitmaps(docs, id_col, text_col), id_col, text_col)
