"""Benchmark decontamination: size-partitioned MinHash containment search.

An item is contaminating when a document holds at least ``percent`` of its distinct
five-word shingles. Documents may be thousands of times longer, so their own
signatures say nothing about a short item. Instead the sketch of an item is its k
smallest shingle hashes (a bottom-k MinHash), with k set by the size class of the
item: an item of n shingles can miss at most n - ceil(percent * n / 100) of them, so
one more than that for the largest n of the class leaves no true pair unfound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rankloom.llm.bytework import distinct_by_row, mixed, parts, shingles
from rankloom.llm.packing import packed, unpacked
from rankloom.session import stored

PERCENT = 80
# The filter of item hashes is a bit table of fixed size (256 KB) with two probes.
FILTER_BITS = 1 << 21


def _probes(hashes: np.ndarray) -> list[np.ndarray]:
    spread = mixed(hashes)
    return [(spread & np.uint64(FILTER_BITS - 1)).astype(np.int64), ((spread >> np.uint64(32)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)]


def _shingle_rows(table: np.ndarray | None):
    """Distinct shingles of each row with its two leading columns; with ``table`` only those it may hold."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in parts(batch.column(2)):
                hashes, owners = shingles(data, offsets)
                if table is not None:
                    first, second = _probes(hashes)
                    hit = table[first] & table[second]
                    hashes, owners = hashes[hit], owners[hit]
                hashes, owners = distinct_by_row(hashes, owners)
                index = pa.array(owners + low)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(index), batch.column(1).take(index), pa.array(hashes.view(np.int64))],
                    names=["id", "text_hash", "h"],
                )

    return rows


def _keyed(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return rows.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


_ROWS = "id long, text_hash long, h long"


def item_sketches(benchmark: DataFrame, percent: int = PERCENT, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item_id, text_hash, h, n_item, in_sketch``: the shingles of all items, sketch ones marked.

    Size class p holds the items of 2**p to 2**(p+1) - 1 shingles.
    """
    rows = _keyed(benchmark, id_col, text_col).distinct().mapInArrow(_shingle_rows(None), _ROWS)
    sets = rows.groupBy("id", "text_hash").agg(F.sort_array(F.collect_set("h")).alias("hs"))
    n = F.size("hs")
    largest = F.expr("bigint(2 * power(2, floor(log2(size(hs))))) - 1")
    length = (largest - F.expr(f"(({percent} * (bigint(2 * power(2, floor(log2(size(hs))))) - 1)) + 99) div 100") + 1).cast("int")
    placed = sets.select(F.col("id").alias("item_id"), "text_hash", n.alias("n_item"), length.alias("k"), F.posexplode("hs").alias("at", "h"))
    return placed.select("item_id", "text_hash", "h", "n_item", (F.col("at") < F.col("k")).alias("in_sketch"))


def _filter_table(items: DataFrame) -> np.ndarray:
    """A bit table of all item hashes; at most ``FILTER_BITS`` places reach the driver."""

    def places(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(_probes(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))))], names=["place"]
            )

    found = items.select("h").mapInArrow(places, "place long").distinct().toArrow().column("place")
    table = np.zeros(FILTER_BITS, dtype=bool)
    table[found.to_numpy()] = True
    return table


def contaminations(
    docs: DataFrame,
    benchmark: DataFrame,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
) -> DataFrame:
    """``doc_id, text_hash, item_id, n_item, n_shared``: every document and item it contains.

    Whole texts are scanned once. Document shingles that may belong to an item (a bit
    table of fixed size tells) leave the scan; those equal to a sketch hash give the
    candidate pairs, and a candidate counts its exact shared shingles. A large
    benchmark fills the bit table, which costs speed but no pair.

    A-Z are lower-cased. A text of one to four words has its whole sequence as its one
    shingle; null and empty texts have none and match nothing. Equal ids with different
    texts are told apart by ``text_hash`` (xxhash64 of the text); repeated rows are
    reported once; null ids stay null. Other columns are ignored.
    """
    items = stored(item_sketches(benchmark, percent, item_col, text_col), "items")
    table = _filter_table(items)
    hits = _keyed(docs, id_col, text_col).mapInArrow(_shingle_rows(table), _ROWS)
    hits = stored(hits.withColumnsRenamed({"id": "doc_id"}), "hits")
    sketch = items.filter("in_sketch").select("h", "item_id", F.col("text_hash").alias("item_hash"))
    pair = ["doc_id", "text_hash", "item_id", "item_hash"]
    candidates = hits.join(sketch, "h").select(*pair).distinct()
    members = items.select("item_id", F.col("text_hash").alias("item_hash"), "n_item", "h")
    # ids are compared null-safely by way of a string key
    wanted = candidates.withColumn("c", F.struct(*pair)).select("c", F.to_json(F.struct("item_id", "item_hash")).alias("item_key"))
    listed = members.select(F.to_json(F.struct("item_id", "item_hash")).alias("item_key"), "n_item", "h")
    needed = wanted.join(listed, "item_key").select("c", "n_item", "h", F.to_json(F.struct("c.doc_id", "c.text_hash")).alias("doc_key"))
    present = hits.select(F.to_json(F.struct("doc_id", "text_hash")).alias("doc_key"), "h").distinct()
    shared = needed.join(present, ["doc_key", "h"]).groupBy("c", "n_item").agg(F.count("*").alias("n_shared"))
    found = shared.filter(F.col("n_shared") * 100 >= F.col("n_item") * percent)
    return found.select("c.doc_id", "c.text_hash", "c.item_id", F.col("n_item").cast("long").alias("n_item"), "n_shared").distinct()


def decontaminated(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that contain no item, with their own columns, whatever their names.

    Null and empty texts contain nothing and stay; of rows that share an id, or have none,
    each is judged by its own text; repeated rows stay or go together. An empty benchmark
    keeps everything.
    """
    found = contaminations(docs, benchmark, percent, id_col, text_col)
    found = found.select(F.col("doc_id").alias("found_id"), F.col("text_hash").alias("found_hash")).distinct()
    same = F.col("id").eqNullSafe(F.col("found_id")) & (F.col("text_hash") == F.col("found_hash"))
    return unpacked(packed(docs, id_col, text_col).join(found, same, "left_anti"))
