"""Approximate nearest neighbours: signed hyperplanes, several tables, near-bucket probes.

The signs of a vector's projections on ``bits`` hyperplanes are its bucket in a table. A
query looks into its own bucket and into those behind the hyperplanes it is closest to.
Everything in these buckets is compared exactly, block by block, so only neighbours in
no looked-at bucket of any table are missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rankloom.operators.keyword import top_k
from rankloom.operators.vectors import (
    _slices,
    block_search,
    even_block_rows,
    search_cells,
    unit_rows,
    vector_rows,
)

TABLES, BITS, FLIPS = 16, 6, 2
# Projections are sums of whole numbers, so they are the same in any order.
PRECISION = 1 << 20


def hyperplanes(tables: int, bits: int, width: int) -> np.ndarray:
    """Normals of ones and minus ones, ``tables * bits`` rows: the top bits of mixed counters."""
    at = np.arange(tables * bits * width, dtype=np.uint64)
    with np.errstate(over="ignore"):
        at = (at + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        at = (at ^ (at >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        at = (at ^ (at >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return np.where(at >> np.uint64(63), 1.0, -1.0).reshape(tables * bits, width)


def _projections(vectors: np.ndarray, normals: np.ndarray, tables: int) -> np.ndarray:
    """Row by table by bit."""
    width = min(vectors.shape[1], normals.shape[1])
    whole = np.floor(vectors[:, :width] * PRECISION)
    return (whole @ normals[:, :width].T).reshape(len(vectors), tables, -1)


def _buckets(projections: np.ndarray) -> np.ndarray:
    bits = projections.shape[2]
    code = ((projections >= 0) << np.arange(bits)).sum(axis=2)
    return code + (np.arange(projections.shape[1]) << bits)


def _probes(projections: np.ndarray, flips: int) -> np.ndarray:
    """The buckets a query looks into, table by table: every choice of the ``flips`` closest hyperplanes crossed."""
    closest = np.argsort(np.abs(projections), axis=2, kind="stable")[:, :, :flips]
    masks = np.zeros((*closest.shape[:2], 1 << closest.shape[2]), dtype=np.int64)
    for k in range(closest.shape[2]):
        chosen = (np.arange(masks.shape[2]) >> k) & 1
        masks ^= chosen * (1 << closest[:, :, k : k + 1])
    return (_buckets(projections)[:, :, None] ^ masks).reshape(len(projections), -1)


def knn_lsh(
    docs: DataFrame,
    queries: DataFrame,
    k: int = 10,
    exclude_same_id: bool = False,
    tables: int = TABLES,
    bits: int = BITS,
    flips: int = FLIPS,
) -> DataFrame:
    """About the ``k`` most similar documents per query: ``query_id, id, score, rank``.

    Reads ``docs(id, vec)`` and ``queries(query_id, vec)``; the score is the cosine. A
    document is compared with a query when they share a bucket in one of ``tables``
    tables of ``2**bits`` buckets, of which a query looks into ``2**flips``. More tables
    and flips find more, more bits compare less; ``bits == flips`` compares everything.
    Buckets of any size are split into blocks. One row per bucket reaches the driver.
    """
    flips = min(flips, bits)
    docs, queries = vector_rows(docs, "id"), vector_rows(queries, "query_id")
    width = docs.agg(F.max(F.size("vec"))).first()[0] or 0
    normals = hyperplanes(tables, bits, width)

    def placed(name: str, probes: bool):
        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _slices(batches):
                vectors = batch.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                found = _projections(vectors.astype(np.float64), normals, tables)
                cells = _probes(found, flips) if probes else _buckets(found)
                row = pa.array(np.repeat(np.arange(len(cells)), cells.shape[1]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(name).take(row), batch.column("vec").take(row), pa.array(cells.ravel().astype(np.int32))],
                    names=[name, "vec", "cell"],
                )

        return rows

    id_type, query_type = dict(docs.dtypes)["id"], dict(queries.dtypes)["query_id"]
    stored_rows = docs.mapInArrow(placed("id", False), f"id {id_type}, vec array<float>, cell int")
    asked = queries.mapInArrow(placed("query_id", True), f"query_id {query_type}, vec array<float>, cell int")
    counts = np.zeros(tables << bits, dtype=np.int64)
    for row in stored_rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect():  # at most a row per bucket
        counts[row["cell"]] = row["n"]
    compare = block_search(k, "cosine", unit_rows, exclude_same_id, f"query_id {query_type}, id {id_type}, score double")
    # A bucket is copied once per block of the other side, so blocks are as large as in the exact search.
    block_rows = even_block_rows(docs.sparkSession, int(counts.sum()) // tables, queries.count())
    found = search_cells(stored_rows, asked, counts, compare, block_rows)
    return top_k(found.dropDuplicates(["query_id", "id"]), k)
