"""Hard negatives by best-first search in an STR-packed R-tree.

Packing (sort-tile-recursive): all rows are sorted by label, then by tiles of the
dimensions that vary most, and filled in that order into blocks of at most ``BLOCK`` rows,
so a label or a point that very many rows share spreads over blocks. A block is sorted
again by further dimensions into pages of ``PAGE`` rows; ``FAN`` pages make a node. Every
page, node and block has a minimum bounding box and a range of labels.

Search: a box bounds the inner product with a query coordinate by coordinate. A queue
gives the box with the largest bound first; a query skips boxes without a label it
wants, boxes that lie outside its window of scores, and boxes strictly below its kth score so
far, so ties are kept. The stated anchors meet all blocks in blocks of ``QUERIES``
anchors; nothing but their best rows so far is held.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from rankloom.session import stored

BLOCK, PAGE, FAN = 4096, 64, 8
QUERIES = 1024
# Tiles are cut by these dimensions; their cuts come from the SAMPLE rows of smallest hash.
TILE_DIMENSIONS, TILE_CUTS, SAMPLE = 3, 4, 10_000
SCALE = 256
ANCHORS, POSITIVES, NEGATIVES = 50, 5, 3
# Percent of the positive's score.
LEAST, MOST = 50, 95
# Products of whole numbers are exact in double precision below this.
_EXACT = 2**53


def whole_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id, label, q``: the rows that take part, components as whole numbers (in doubles)."""
    vector = F.col(vector_col).cast("array<double>")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.coalesce(fine, F.lit(False)))
    # doubles, as a whole number that large may not fit a long
    q = F.transform(vector, lambda x: F.floor(x * SCALE).cast("double"))
    one = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.struct(F.col(label_col).cast("long").alias("label"), q.alias("q")).alias("r"))
    return one.groupBy("vec_id").agg(F.min("r").alias("r")).select("vec_id", "r.label", "r.q")


def _tile(rows: DataFrame) -> Column:
    """The tile of a row: which of ``TILE_CUTS`` quantiles it falls into in each of the widest dimensions."""
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("q").toArrow().column("q").to_pylist()
    wide = max(map(len, sample), default=0)
    points = np.array([v + [0.0] * (wide - len(v)) for v in sample]).reshape(len(sample), wide)
    tile = F.lit(0)
    if wide:
        for d in np.argsort(-points.var(axis=0), kind="stable")[:TILE_DIMENSIONS].tolist():
            cuts = np.quantile(points[:, d], np.arange(1, TILE_CUTS) / TILE_CUTS).tolist()
            value = F.coalesce(F.get("q", F.lit(d)), F.lit(0.0))
            tile = tile * TILE_CUTS + sum((F.when(value > c, 1).otherwise(0) for c in cuts), F.lit(0))
    return tile


def _matrix(column: pa.Array) -> np.ndarray:
    """The vectors of a column as rows; shorter ones end in zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    out[np.arange(out.shape[1]) < sizes[:, None]] = values
    return out


def _pages(order: np.ndarray, points: np.ndarray, dims: np.ndarray, least: int) -> list[np.ndarray]:
    """``order`` cut into tiles of about ``least`` rows, one dimension after the other."""
    if len(order) <= least:
        return [order]
    here, rest = (dims[0], dims[1:]) if len(dims) else (None, dims)
    ordered = order if here is None else order[np.argsort(points[order, here], kind="stable")]
    pages = -(-len(order) // least)
    slabs = pages if len(rest) == 0 else max(2, round(pages ** (1 / (len(rest) + 1))))
    height = -(-pages // slabs) * least
    return [p for k in range(0, len(ordered), height) for p in _pages(ordered[k : k + height], points, rest, least)]


def _ipc(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _block(rows: pa.Table) -> bytes:
    """The rows of a block in page order, with the number of their page."""
    ids, labels = (rows.column(n).to_numpy() for n in ("vec_id", "label"))
    points = _matrix(rows.column("q").combine_chunks())
    dims = np.argsort(-points.var(axis=0), kind="stable")[:TILE_DIMENSIONS]
    pages = [p for label in np.unique(labels) for p in _pages(np.flatnonzero(labels == label), points, dims, PAGE)]
    order = np.concatenate(pages)
    page = np.repeat(np.arange(len(pages)), [len(p) for p in pages])
    narrow = points.astype(np.int32) if np.abs(points).max(initial=0) < 2**31 else points
    width = points.shape[1]
    values = pa.FixedSizeListArray.from_arrays(pa.array(narrow[order].ravel()), width) if width else pa.nulls(len(order))
    return _ipc(pa.table({"id": ids[order], "label": labels[order], "page": page, "q": values}))


def _packed(rows: DataFrame, order: list[str], names: list[str], size: int, encode) -> DataFrame:
    """``content``: the rows, sorted by ``order``, in blocks of ``size`` and encoded."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            held, count = [*held, batch], count + batch.num_rows
            while count >= size:
                table = pa.Table.from_batches(held)
                yield pa.RecordBatch.from_arrays([pa.array([encode(table.slice(0, size).combine_chunks())])], names=["content"])
                held, count = table.slice(size).to_batches(), count - size
        if count:
            yield pa.RecordBatch.from_arrays([pa.array([encode(pa.Table.from_batches(held).combine_chunks())])], names=["content"])

    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(*names)
    # neighbouring ranges join up to about one block a task, so few blocks are left half empty
    return ordered.coalesce(max(1, -(-rows.count() // size))).mapInArrow(blocks, "content binary")


def packed_tree(rows: DataFrame) -> DataFrame:
    """``content``: the blocks of the tree over :func:`whole_vectors`, one row each.

    Only ``SAMPLE`` rows are collected, to place the cuts; every row is packed.
    """
    placed = rows.withColumns({"tile": _tile(rows), "spread": F.xxhash64("vec_id")})
    return stored(_packed(placed, ["label", "tile", "spread"], ["vec_id", "label", "q"], BLOCK, _block), "tree")


def query_blocks(queries: DataFrame) -> DataFrame:
    """``content``: blocks of queries ``anchor_id, label, key, low, high, q`` (see :func:`searched`)."""
    names = ["anchor_id", "label", "key", "low", "high", "q"]
    return stored(_packed(queries, ["label", "anchor_id", "key"], names, QUERIES, _ipc), "queries")


@dataclass
class Box:
    """Bounding boxes of some level and their ranges of labels."""

    low: np.ndarray
    high: np.ndarray
    least: np.ndarray
    most: np.ndarray

    def over(self, starts: np.ndarray) -> Box:
        """The boxes around the runs of boxes that begin at ``starts``."""
        return Box(
            np.minimum.reduceat(self.low, starts),
            np.maximum.reduceat(self.high, starts),
            np.minimum.reduceat(self.least, starts),
            np.maximum.reduceat(self.most, starts),
        )

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Smallest and largest possible inner product of every query with every box."""
        up, down = np.maximum(queries, 0), np.minimum(queries, 0)
        return up @ self.low.T + down @ self.high.T, up @ self.high.T + down @ self.low.T


class Searcher:
    """The best rows so far of one block of queries, carried from block to block of the tree."""

    def __init__(self, content: bytes, k: int, same_label: bool):
        table = pa.ipc.open_stream(content).read_all().combine_chunks()
        self.k, self.same = k, same_label
        self.anchor, self.label, self.key, self.low, self.high = (
            table.column(n).to_numpy() for n in ("anchor_id", "label", "key", "low", "high")
        )
        q = _matrix(table.column("q").combine_chunks())
        # queries of one anchor follow each other and share its products
        new = np.concatenate([[True], (self.anchor[1:] != self.anchor[:-1])])
        self.vectors, self.vector = q[new], np.cumsum(new) - 1
        n = len(self.anchor)
        self.scores = np.full((n, k), -np.inf)
        self.ids = np.full((n, k), np.iinfo(np.int64).max)

    def _open(self, box: Box, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Which queries still need which boxes; bounds come by query vector."""
        low, high = low[self.vector], high[self.vector]
        inside = (high >= self.low[:, None]) & (low <= self.high[:, None]) & (high >= self.scores[:, -1:])
        mine = self.label[:, None]
        if self.same:
            return inside & (box.least <= mine) & (box.most >= mine)
        return inside & ((box.least != mine) | (box.most != mine))

    def _add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        """Merges the scores of a page into the best of the queries ``rows``."""
        scores = scores[self.vector[rows]]
        fits = (scores >= self.low[rows, None]) & (scores <= self.high[rows, None]) & (scores >= self.scores[rows, -1:])
        fits &= (labels == self.label[rows, None]) == self.same
        fits &= ids != self.anchor[rows, None]
        some = fits.any(axis=1)
        if not some.any():
            return
        rows, scores, fits = rows[some], scores[some], fits[some]
        every = np.concatenate([self.scores[rows], np.where(fits, scores, -np.inf)], axis=1)
        names = np.concatenate([self.ids[rows], np.where(fits, ids, np.iinfo(np.int64).max)], axis=1)
        first = np.lexsort((names, -every), axis=1)[:, : self.k]
        self.scores[rows] = np.take_along_axis(every, first, axis=1)
        self.ids[rows] = np.take_along_axis(names, first, axis=1)

    def visit(self, content: bytes) -> int:
        """Best-first search in one block of the tree; the number of pages looked into."""
        table = pa.ipc.open_stream(content).read_all().combine_chunks()
        ids, labels, page = (table.column(n).to_numpy() for n in ("id", "label", "page"))
        q = table.column("q").combine_chunks()
        points = q.flatten().to_numpy().reshape(len(ids), -1) if pa.types.is_fixed_size_list(q.type) else np.zeros((len(ids), 0))
        wide = max(points.shape[1], self.vectors.shape[1])
        points, vectors = (np.pad(m, ((0, 0), (0, wide - m.shape[1]))) for m in (points, self.vectors))
        if wide * np.abs(points).max(initial=0) * np.abs(vectors).max(initial=0) >= _EXACT:
            raise ValueError(f"components of {SCALE} times a vector are too large for exact inner products")
        starts = np.searchsorted(page, np.arange(page[-1] + 1))
        leaf = Box(points, points, labels, labels).over(starts)
        nodes = np.arange(0, len(starts), FAN)
        levels = [leaf.over(np.array([0])), leaf.over(nodes), leaf]
        children = [lambda k: range(len(nodes)), lambda k: range(k * FAN, min((k + 1) * FAN, len(starts)))]
        bounds = [box.bounds(vectors) for box in levels]
        ends = np.append(starts, len(ids))

        def best(level: int, k: int) -> float:
            return -float(bounds[level][1][:, k].max())

        queue, looked = [(best(0, 0), 0, 0)], 0
        while queue:
            _, level, k = heapq.heappop(queue)
            box = levels[level]
            one = Box(box.low[k : k + 1], box.high[k : k + 1], box.least[k : k + 1], box.most[k : k + 1])
            low, high = (b[:, k : k + 1] for b in bounds[level])
            rows = np.flatnonzero(self._open(one, low, high)[:, 0])
            if not len(rows):
                continue
            if level < 2:
                for child in children[level](k):
                    heapq.heappush(queue, (best(level + 1, child), level + 1, child))
                continue
            looked += 1
            here = slice(ends[k], ends[k + 1])
            needed = np.zeros(len(vectors), dtype=bool)
            needed[self.vector[rows]] = True
            scores = np.full((len(vectors), here.stop - here.start), -np.inf)
            scores[needed] = vectors[needed] @ points[here].T
            self._add(rows, scores, ids[here], labels[here])
        return looked

    def best(self) -> pa.RecordBatch:
        row, place = np.nonzero(self.scores > -np.inf)
        columns = (self.anchor[row], self.key[row], self.ids[row, place], self.scores[row, place].astype(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["anchor_id", "key", "found_id", "score"])


def searched(queries: DataFrame, tree: DataFrame, k: int, same_label: bool) -> DataFrame:
    """``anchor_id, key, found_id, score, rank``: the first ``k`` rows of the tree for every query.

    ``queries`` has ``anchor_id, label, key, low, high, q``; rows found have (or, without
    ``same_label``, have not) the label, another id and a score from ``low`` to ``high``.

    Every block of queries meets every block of the tree. Blocks of the tree come one after
    the other in a task, which keeps only the best of one block of queries and returns
    them once, so what is shuffled are k rows for a query and partition of the tree.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, searcher = None, None
        for batch in batches:
            for query, n, content in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2)):
                if n != number:
                    if searcher is not None:
                        yield searcher.best()
                    number, searcher = n, Searcher(query.as_py(), k, same_label)
                searcher.visit(content.as_py())
        if searcher is not None:
            yield searcher.best()

    spark = tree.sparkSession
    parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), tree.count()))
    asked = query_blocks(queries).select(F.col("content").alias("query"), F.monotonically_increasing_id().alias("n"))
    # the stated queries against all rows, both in blocks; a hint keeps either side from being broadcast
    pairs = asked.hint("shuffle_replicate_nl").crossJoin(tree.repartition(parts)).select("query", "n", "content")
    found = pairs.mapInArrow(rows, "anchor_id long, key long, found_id long, score long")
    first = Window.partitionBy("anchor_id", "key").orderBy(F.col("score").desc(), "found_id")
    return found.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame,
    anchors: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``anchors`` is a condition on ``vec_id`` of the rows that are anchors. Scores are inner
    products of ``floor(SCALE * x)``; higher ones come first, ties by smaller id. An
    anchor's positives are its first ``positives`` other rows of the same label; the
    negatives of a positive the first ``negatives`` rows of other labels with ``LEAST`` to
    ``MOST`` percent of the positive's score, so a positive with a score below 0 has none.

    Rows with a null id, label or vector or a component that is null or not finite take no
    part. An id names one row: of several with the same id the one of smallest label, then
    smallest vector counts, so repeated rows change nothing. Of vectors of different
    length the shorter ones are continued by zeros. Components so large that products may
    not be exact are an error. An empty table, or one without anchors, gives no rows.
    Other columns are ignored.
    """
    whole = stored(whole_vectors(rows, id_col, vector_col, label_col), "vectors")
    tree = packed_tree(whole)
    asked = whole.filter(anchors).select(F.col("vec_id").alias("anchor_id"), "label", "q")
    everything = [F.lit(0).cast("long").alias("key"), F.lit(float("-inf")).alias("low"), F.lit(float("inf")).alias("high")]
    near = searched(asked.select("*", *everything), tree, positives, same_label=True)
    near = stored(near.select("anchor_id", F.col("found_id").alias("key"), "score"), "positives")
    # scores are whole, so are the ends of the window
    low = F.expr(f"double((score * {LEAST} + 99) div 100)").alias("low")
    high = F.expr(f"double(score * {MOST} div 100)").alias("high")
    windows = near.filter("score >= 0").select("anchor_id", "key", low, high)
    hard = searched(asked.join(windows, "anchor_id"), tree, negatives, same_label=False)
    return hard.join(near.withColumnRenamed("score", "positive_score"), ["anchor_id", "key"]).select(
        "anchor_id",
        F.col("key").alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        F.col("found_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
