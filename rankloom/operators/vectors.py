"""Exact nearest neighbours over cells of vectors.

Documents are assigned to the nearest of some pivot vectors. A query first searches
its nearest cells; the distance of its k-th hit there then rules out, by the
triangle inequality, every cell that cannot hold a closer document. Only the
remaining cells are searched, in blocks of bounded size, and each block returns
``k`` rows per query. For that, cells are packed into groups: a query is sent once to a
group that holds such a cell and is compared with the whole group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rankloom.functions.text import embedding_text
from rankloom.operators.keyword import SCALE, top_k
from rankloom.session import settled

BLOCK_ROWS = 4096
# Blocks of the second pass: rows are copied once per block of the other side, so blocks grow up to this.
MOST_BLOCK_ROWS = 32768
BLOCKS_PER_CORE = 16
MAX_CELLS = 1024
SLICE = 512  # vectors whose distances from all pivots are held at a time
CELL_SCORES = 1 << 22  # scores held at a time
COLUMNS_PER_MAXIMUM = 32  # at most
SLACK = 1e-5  # covers rounding of scores and of the bounds


def _matrix(column) -> np.ndarray:
    """A list column as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(norms == 0, 1.0, norms)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squared = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T
    return np.sqrt(np.maximum(squared, 0.0))


class _Cells:
    """Pivots, and the size and radius of each cell; at most MAX_CELLS of them."""

    def __init__(self, pivots: np.ndarray, counts=None, radii=None):
        self.pivots, self.counts, self.radii = pivots, counts, radii

    def nearest_holding(self, distances: np.ndarray, k: int) -> np.ndarray:
        """Mask of each query's nearest cells that together hold ``k`` documents."""
        order = np.argsort(distances, axis=1)
        before = np.cumsum(self.counts[order], axis=1) - self.counts[order]
        mask = np.zeros(distances.shape, dtype=bool)
        np.put_along_axis(mask, order, before < k, axis=1)
        return mask & (self.counts > 0)

    def possible(self, distances: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Mask of the cells that may hold a document within ``limit``."""
        nearest = distances.argmin(axis=1)
        near = distances[np.arange(len(distances)), nearest]
        apart = _distances(self.pivots, self.pivots)[nearest]
        # A document of another cell lies beyond the plane between the pivots.
        plane = (distances**2 - near[:, None] ** 2) / np.where(apart == 0, 1.0, 2 * apart)
        plane = np.where(apart == 0, 0.0, plane)
        bound = np.maximum(np.maximum(distances - self.radii, plane), 0.0)
        # Without a number for a bound nothing is ruled out.
        return ~(bound > limit[:, None] + SLACK) & (self.counts > 0)

    def groups(self, rows: int) -> np.ndarray:
        """The group of each cell: consecutive cells of about ``rows`` documents together."""
        starts = np.cumsum(self.counts) - self.counts
        return np.unique(starts // rows, return_inverse=True)[1]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of all batches, at most ``SLICE`` at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            yield batch.slice(start, SLICE)


def vector_rows(rows: DataFrame, name: str) -> DataFrame:
    """The id column ``name`` and ``vec`` of the rows that have a vector."""
    return rows.select(name, F.col("vec").cast("array<float>").alias("vec")).where(F.size("vec") > 0)


def choose_pivots(docs: DataFrame, cells: int) -> np.ndarray:
    """``cells`` document vectors in hash order; bounded by MAX_CELLS rows."""
    rows = docs.orderBy(F.xxhash64("id"), "id").select("vec").limit(min(cells, MAX_CELLS)).collect()
    return np.array([r["vec"] for r in rows], dtype=np.float64)


def knn(
    docs: DataFrame,
    queries: DataFrame,
    k: int = 10,
    metric: str = "cosine",
    exclude_same_id: bool = False,
    cells: int | None = None,
) -> DataFrame:
    """The ``k`` nearest documents per query: ``query_id, id, score, rank``.

    Reads ``docs(id, vec)`` and ``queries(query_id, vec)``. The score is the cosine,
    or for ``l2`` the negative distance, rounded before ranking.
    """
    if metric not in ("cosine", "l2"):
        raise ValueError(f"unknown metric {metric!r}")
    docs, queries = vector_rows(docs, "id"), vector_rows(queries, "query_id")
    if cells is None:
        n_docs = docs.count()
        # One block needs no cells.
        cells = 1 if n_docs <= BLOCK_ROWS else int(min(np.sqrt(n_docs) / 2, MAX_CELLS))
    pivots = choose_pivots(docs, cells)
    if len(pivots) == 0:
        kinds = f"query_id {dict(queries.dtypes)['query_id']}, id {dict(docs.dtypes)['id']}"
        return docs.sparkSession.createDataFrame([], f"{kinds}, score double, rank int")
    prepared = unit_rows if metric == "cosine" else (lambda m: m)
    pivots = prepared(pivots)
    id_type = dict(docs.dtypes)["id"]
    query_type = dict(queries.dtypes)["query_id"]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            away = _distances(prepared(_matrix(batch.column("vec"))), pivots)
            cell = away.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("vec"),
                    pa.array(cell.astype(np.int32)),
                    pa.array(away[np.arange(len(cell)), cell]),
                ],
                names=["id", "vec", "cell", "away"],
            )

    placed = docs.mapInArrow(assign, f"id {id_type}, vec array<float>, cell int, away double")
    # One row per cell, at most MAX_CELLS.
    sizes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("r")).collect()
    counts = np.zeros(len(pivots), dtype=np.int64)
    radii = np.zeros(len(pivots))
    for row in sizes:
        counts[row["cell"]], radii[row["cell"]] = row["n"], row["r"]
    layout = _Cells(pivots, counts, radii)
    needed = k + 1 if exclude_same_id else k

    def route(group: np.ndarray | None):
        """Queries sent to the cells that hold their first hits, or to the groups of all possible cells."""

        def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _slices(batches):
                away = _distances(prepared(_matrix(batch.column("vec"))), layout.pivots)
                if group is None:
                    mask = layout.nearest_holding(away, needed)
                else:
                    limit = batch.column("limit").to_numpy(zero_copy_only=False).astype(float)
                    limit = np.where(np.isnan(limit), np.inf, limit)
                    mask = np.zeros((batch.num_rows, group.max() + 1), dtype=bool)
                    rows, cell = np.nonzero(layout.possible(away, limit))
                    mask[rows, group[cell]] = True
                rows, cell = np.nonzero(mask)
                picked = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("query_id").take(picked),
                        batch.column("vec").take(picked),
                        pa.array(cell.astype(np.int32)),
                    ],
                    names=["query_id", "vec", "cell"],
                )

        return visit

    routed_schema = f"query_id {query_type}, vec array<float>, cell int"
    hit_schema = f"query_id {query_type}, id {id_type}, score double"
    search = block_search(k, metric, prepared, exclude_same_id, hit_schema)

    first = search_cells(placed, queries.mapInArrow(route(None), routed_schema), counts, search)
    if len(pivots) == 1:
        return top_k(first, k)
    near = settled(top_k(first, k))
    limits = near.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("score").alias("worst")
    ).select(
        "query_id",
        # Distance of the k-th hit; without k hits nothing is ruled out.
        F.when(
            F.col("n") == k,
            F.sqrt(F.greatest(2 - 2 * F.col("worst"), F.lit(0.0)) + SLACK)
            if metric == "cosine"
            else -F.col("worst"),
        ).alias("limit"),
    )
    more = queries.join(limits, "query_id", "left").select("query_id", "vec", "limit")
    block_rows = even_block_rows(docs.sparkSession, int(counts.sum()), near.select("query_id").distinct().count())
    group = layout.groups(block_rows)
    grouped = placed.withColumn("cell", F.element_at(F.array(*[F.lit(int(g)) for g in group]), F.col("cell") + 1))
    second = search_cells(
        grouped, more.mapInArrow(route(group), routed_schema), np.bincount(group, weights=counts), search, block_rows
    )
    # The first hits lie in possible cells too, so they are found again.
    return top_k(second, k)


def even_block_rows(spark, docs: int, queries: int) -> int:
    """Rows a block takes on either side so that every core gets some pairs of blocks."""
    pairs = spark.sparkContext.defaultParallelism * BLOCKS_PER_CORE
    return int(min(max((docs * queries / pairs) ** 0.5, BLOCK_ROWS), MOST_BLOCK_ROWS))


def search_cells(placed, routed, counts, search, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Search every routed query in its cells, block by block.

    A cell's documents and queries are split into blocks by hash, so a cell of any
    size is spread over many tasks.
    """
    # One row per cell, at most MAX_CELLS.
    demand = {r["cell"]: r["n"] for r in routed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not demand:
        return placed.sparkSession.createDataFrame([], search.schema)

    def blocks(sizes):
        needed = [max(1, -(-int(s) // block_rows)) for s in sizes]
        return F.element_at(F.array(*[F.lit(n) for n in needed]), F.col("cell") + 1)

    doc_blocks = blocks(counts)
    query_blocks = blocks([demand.get(c, 0) for c in range(len(counts))])
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    left = (
        placed.where(F.col("cell").isin(list(demand)))
        .withColumn("doc_block", F.pmod(F.xxhash64("id"), doc_blocks).cast("int"))
        .withColumn("query_block", every(query_blocks))
    )
    right = routed.withColumn("query_block", F.pmod(F.xxhash64("query_id"), query_blocks).cast("int")).withColumn(
        "doc_block", every(doc_blocks)
    )
    keys = ["cell", "doc_block", "query_block"]
    return (
        left.select(*keys, "id", "vec")
        .groupBy(*keys)
        .cogroup(right.select(*keys, "query_id", "vec").groupBy(*keys))
        .applyInArrow(search, search.schema)
    )


def _nearness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The negative squares of the distances."""
    near = a @ b.T
    near *= 2
    near -= (a * a).sum(1)[:, None]
    near -= (b * b).sum(1)[None, :]
    return np.minimum(near, -0.0, out=near)


def _leave_out(near: np.ndarray, names: np.ndarray, ids: np.ndarray) -> None:
    """Let no query find its own id among the sorted ``ids``."""
    if names.dtype.kind != "i" or ids.dtype.kind != "i":
        near[names[:, None] == ids[None, :]] = -np.inf
        return
    first, after = np.searchsorted(ids, names, "left"), np.searchsorted(ids, names, "right")
    for row in np.nonzero(first < after)[0]:
        near[row, first[row] : after[row]] = -np.inf


def _best(near: np.ndarray, k: int, metric: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and rounded score of the ``k`` best columns per row; ties go to the smaller column.

    The k-th largest of the maxima of disjoint columns is no more than the k-th largest
    score, so only the few scores that reach it, rounded, are put in order.
    """
    rows, width = near.shape
    maxima = near
    if (columns := min(width // (4 * k), COLUMNS_PER_MAXIMUM)) > 1:
        maxima = near[:, : width - width % columns].reshape(rows, columns, -1).max(axis=1)
    least = np.full(rows, -np.inf)
    if maxima.shape[1] >= k:
        least = np.partition(maxima, maxima.shape[1] - k, axis=1)[:, -k]
    # What rounds to the same score counts as equal to it.
    if metric == "cosine":
        least = least - 2 * 10.0**-SCALE
    else:
        least = np.minimum(least, -((np.sqrt(-least) * (1 + 1e-12) + 2 * 10.0**-SCALE) ** 2))
    row, at = np.nonzero(near >= np.maximum(least, np.finfo(float).min)[:, None])
    scores = near[row, at]
    scores = np.round(scores if metric == "cosine" else -np.sqrt(-scores), SCALE)
    order = np.lexsort((at, -scores, row))
    row, at, scores = row[order], at[order], scores[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < k], at[place < k], scores[place < k]


def block_search(k, metric, prepared, exclude_same_id, schema):
    def search(docs: pa.Table, queries: pa.Table) -> pa.Table:
        ids = docs.column("id").to_numpy()
        names = queries.column("query_id").to_numpy()
        found: list[tuple] = []
        if len(ids) and len(names):
            points = prepared(_matrix(docs.column("vec")))
            asked = prepared(_matrix(queries.column("vec")))
            by_id = np.argsort(ids, kind="stable")
            ids, points = ids[by_id], points[by_id]
            finite = np.isfinite(points).all() and np.isfinite(asked).all()
            step = max(1, CELL_SCORES // len(ids))
            for start in range(0, len(names), step):
                part = asked[start : start + step]
                near = part @ points.T if metric == "cosine" else _nearness(part, points)
                if not finite:
                    near[np.isnan(near)] = -np.inf
                if exclude_same_id:
                    _leave_out(near, names[start : start + step], ids)
                row, at, scores = _best(near, k, metric)
                found.append((names[start + row], ids[at], scores))
        # without hits plain lists, as an empty array of numbers is no array of strings
        columns = [np.concatenate(c) for c in zip(*found)] if found else [[], [], []]
        return pa.table(
            {
                "query_id": pa.array(columns[0], type=queries.schema.field("query_id").type),
                "id": pa.array(columns[1], type=docs.schema.field("id").type),
                "score": pa.array(columns[2], type=pa.float64()),
            }
        )

    search.schema = schema
    return search


def attach_vectors(docs: DataFrame, vectors: DataFrame, name: str = "contentVector") -> DataFrame:
    """Documents with their vector, matched by id; documents without one keep null."""
    return docs.join(vectors.select("id", F.col("vec").alias(name)), "id", "left")


def embed_documents(docs: DataFrame, model, name: str = "contentVector") -> DataFrame:
    """Documents with the vector ``model`` computes from title and body.

    ``model`` is a pandas UDF from text to ``array<float>``.
    """
    return docs.withColumn(name, model(embedding_text("title", "body")))


def without_vector(docs: DataFrame, name: str = "contentVector") -> DataFrame:
    return docs.drop(name)
