"""Repeated byte strings by a distributed suffix sort at sampled places.

Only the first ``LENGTH`` bytes of a suffix matter, and equal strings have to be compared
at one common place only, so few suffixes are sorted:

0. Of equal texts only those of the smallest document are sorted; all others are
   repeats as a whole.
1. Places are sampled by content (a string synchronizing set, where a difference cover would
   sample by number): every string of ``LENGTH`` bytes has the place of its ``GRAM`` bytes of
   smallest hash. Equal strings have it at the same distance, so each one is met through one
   sampled place instead of one for every offset of a cover. Neighbouring strings share it.
2. A string can only repeat if its own gram is the smallest one in a string of another
   document too; the other runs of strings are left out, which is exact.
3. The suffixes at the sampled places that are left are sorted, and the reversed
   prefixes before them. The longest common prefixes of neighbours give the classes of equal
   bytes of any number behind and before a place.
4. The strings are merged by their distance: those that start d bytes before their sampled
   places are equal where d bytes before and ``LENGTH`` - d bytes behind are of one class
   each. The first document of every class keeps the string.

Sampled places of one gram are merged in one task. Grams of more than ``CROWDED``
places are not: each of their strings is grouped by itself, its bytes being the key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rankloom.llm.bytework import mixed, parts, powers, prefix_hashes
from rankloom.session import remove, scratch_path, stored

LENGTH = 50
GRAM = 18
CROWDED = 1 << 16
_BEHIND = LENGTH - GRAM  # the largest distance of a string from its gram
_PART = 1 << 18
_PIECE = 1 << 14  # sampled places merged at once, at least
_PLACE_BITS = np.uint64(24)
_NULL_ID = -(2**63)


def _ids(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc, text, copied, tag``: ``copied`` where a smaller document has the same text.

    ``tag`` tells the texts of one document apart and is 0 where it has only one, so that
    the places sorted later carry nothing for it. Texts are the same when 128 bits of
    hashes agree.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL_ID)).alias("doc"),
        F.xxhash64(text).alias("text_hash"),
        F.xxhash64(F.lit(1), text).alias("text_check"),
        text.alias("text"),
    )
    copies = rows.groupBy("text_hash", "text_check").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    copies = stored(copies.filter("first < last").select("text_hash", "text_check", "first"), "copies")
    several = rows.groupBy("doc").agg(F.min("text_hash").alias("lo"), F.max("text_hash").alias("hi"))
    several = stored(several.filter("lo < hi").select("doc", F.lit(True).alias("several")), "several")
    joined = rows.join(copies, ["text_hash", "text_check"], "left").join(several, "doc", "left")
    return joined.select(
        "doc",
        "text",
        F.coalesce(F.col("doc") > F.col("first"), F.lit(False)).alias("copied"),
        F.when(F.col("several"), F.col("text_hash")).otherwise(F.lit(0)).cast("long").alias("tag"),
    )


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` over every run of ``width`` values, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = pick(out[: len(out) - step], out[step:])
        have += step
    return out


def _runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of strings with the same smallest gram: its hash, the first start, how many start, the gram's distance.

    Smallest are the upper bits of a hash, then the first place. Long rows are cut into
    stretches, and a run at such a cut is given in two.
    """
    found = [(np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3)))]
    for at in range(0, len(data) - LENGTH + 1, 1 << 20):
        piece = data[at : at + (1 << 20) + LENGTH - 1]
        sums = prefix_hashes(piece)
        with np.errstate(over="ignore"):
            grams = mixed((sums[GRAM:] - sums[:-GRAM]) * powers(len(sums))[1][: len(sums) - GRAM])
        places = np.arange(len(grams), dtype=np.uint64)
        least = _sliding((grams >> _PLACE_BITS << _PLACE_BITS) | places, _BEHIND + 1, np.minimum)
        least = (least & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)
        inside = np.ones(len(least), dtype=bool)
        for end in offsets[np.searchsorted(offsets, at, side="right") :] - at:
            if end >= len(least) + LENGTH:
                break
            inside[max(0, end - LENGTH + 1) : end] = False
        starts = np.flatnonzero(inside)
        least = least[starts]
        fresh = np.ones(len(starts), dtype=bool)
        fresh[1:] = (least[1:] != least[:-1]) | (starts[1:] != starts[:-1] + 1)
        first = np.flatnonzero(fresh)
        begins = starts[first]
        found.append((grams[least[first]], begins + at, np.diff(first, append=len(starts)), least[first] - begins))
    return tuple(np.concatenate(column) for column in zip(*found))


def _run_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, _, data, offsets in parts(batch.column(2), _PART):
            grams, starts, counts, distances = _runs(data, offsets)
            row = np.searchsorted(offsets, starts, side="right") - 1
            index = pa.array(row + low)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(grams.view(np.int64)),
                    batch.column(0).take(index),
                    batch.column(1).take(index),
                    pa.array((starts - offsets[row]).astype(np.int32)),
                    pa.array(counts.astype(np.int8)),
                    pa.array(distances.astype(np.int8)),
                ],
                names=["gram", "doc", "tag", "start", "n", "distance"],
            )


def _candidates(texts: DataFrame) -> DataFrame:
    """``doc, tag, runs``: the runs of strings of every text whose gram several documents select.

    ``crowded`` tells runs of grams that more than ``CROWDED`` runs have.
    """
    spark = texts.sparkSession
    path = scratch_path(spark, "runs")
    rows = texts.select("doc", "tag", "text").mapInArrow(
        _run_rows, "gram long, doc long, tag long, start int, n byte, distance byte"
    )
    rows = stored(rows, path=path)
    grams = rows.groupBy("gram").agg(F.min("doc").alias("a"), F.max("doc").alias("b"), F.count(F.lit(1)).alias("held"))
    shared = stored(grams.filter("a < b").select("gram", (F.col("held") > CROWDED).alias("crowded")), "grams")
    kept = stored(rows.join(shared, "gram"), "kept")
    remove(spark, path)
    run = F.struct("gram", "start", "n", "distance", "crowded")
    return stored(kept.groupBy("doc", "tag").agg(F.collect_set(run).alias("runs")), "found")


def _slices(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, step: int = 1) -> pa.Array:
    """``lengths`` bytes from every start, or backwards from it with a ``step`` of -1."""
    ends = np.concatenate([[0], np.cumsum(lengths)])
    index = np.repeat(starts - step * ends[:-1], lengths) + step * np.arange(ends[-1])
    buffers = [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data[index])]
    return pa.Array.from_buffers(pa.binary(), len(starts), buffers)


def _run_slices(batches: Iterator[pa.RecordBatch], crowded: bool):
    """``data, index of the rows, start in data, start in the text, n, distance, gram`` of a few thousand runs at a time."""
    for batch in batches:
        lists = batch.column(3)
        ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        runs = lists.flatten()
        values = {k: runs.field(k).to_numpy(zero_copy_only=False) for k in ("gram", "start", "n", "distance", "crowded")}
        for low, high, data, offsets in parts(batch.column(2), _PART):
            mine = slice(ends[low], ends[high])
            row = np.repeat(np.arange(high - low), np.diff(ends[low : high + 1]))
            chosen = np.flatnonzero(values["crowded"][mine] == crowded)
            for at in range(0, len(chosen), 1 << 13):
                some = chosen[at : at + (1 << 13)]
                gram, start, n, distance = (values[k][mine][some] for k in ("gram", "start", "n", "distance"))
                start = start.astype(np.int64)
                index = row[some]
                yield batch, data, index + low, offsets[index] + start, start, n.astype(np.int64), distance.astype(np.int64), gram


def _sample_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sampled places with the bytes behind and, backwards, before them that their strings reach."""
    for batch, data, index, begins, starts, n, distance, gram in _run_slices(batches, False):
        taken = pa.array(index)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(gram),
                batch.column(0).take(taken),
                batch.column(1).take(taken),
                pa.array(starts.astype(np.int32)),
                _slices(data, begins + distance - 1, distance, -1),
                _slices(data, begins + distance, n + LENGTH - 1 - distance),
            ],
            names=["gram", "doc", "tag", "start", "before", "behind"],
        )


def _string_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The strings of crowded grams, one by one."""
    for batch, data, index, begins, starts, n, _, _ in _run_slices(batches, True):
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        taken = pa.array(np.repeat(index, n))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(taken),
                batch.column(1).take(taken),
                pa.array((np.repeat(starts, n) + step).astype(np.int32)),
                _slices(data, np.repeat(begins, n) + step, np.full(len(step), LENGTH)),
            ],
            names=["doc", "tag", "start", "string"],
        )


def _padded(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of every row, filled up with zeros to ``width``, and how many they were."""
    _, where, content = column.buffers()
    ends = np.frombuffer(where, dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    lengths = np.diff(ends).astype(np.int64)
    out = np.zeros((len(column), width), dtype=np.uint8)
    if content is not None:
        out[np.arange(width) < lengths[:, None]] = np.frombuffer(content, dtype=np.uint8)[ends[0] : ends[-1]]
    return out, lengths


def _common(rows: np.ndarray) -> np.ndarray:
    """Length of the common prefix of every row with the one before; -1 for the first."""
    same = np.ones((len(rows), rows.shape[1] + 1), dtype=bool)
    same[1:, :-1] = rows[1:] == rows[:-1]
    same[:, -1] = False
    out = same.argmin(axis=1)
    out[0] = -1
    return out


def _merged(piece: pa.Table) -> pa.RecordBatch:
    """Runs of strings that a smaller document holds too; ``piece`` holds whole grams, sorted by them and ``behind``."""
    gram, doc, starts = (piece.column(k).to_numpy() for k in ("gram", "doc", "start"))
    behind, lengths = _padded(piece.column("behind").combine_chunks(), LENGTH)
    before, far = _padded(piece.column("before").combine_chunks(), _BEHIND)
    near = LENGTH - lengths
    after = _common(behind)
    after[1:][gram[1:] != gram[:-1]] = -1
    backwards = np.lexsort(np.ascontiguousarray(before).view(">u8").T[::-1].astype(np.uint64))
    ahead = _common(before[backwards])
    again = np.zeros((len(gram), _BEHIND + 3), dtype=bool)  # a column without repeats at either end
    classes = np.zeros(len(gram), dtype=np.int64)
    for d in range(_BEHIND + 1):
        mine = np.flatnonzero((near <= d) & (d <= far))
        if not len(mine):
            continue
        classes[backwards] = np.cumsum(ahead < d)
        key = (np.cumsum(after < LENGTH - d)[mine] << 32) | classes[mine]
        order = np.argsort(key)
        mine, key = mine[order], key[order]
        heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        first = np.repeat(np.minimum.reduceat(doc[mine], heads), np.diff(heads, append=len(key)))
        again[mine, d + 1] = doc[mine] > first
    row, nearest = np.nonzero(again[:, 1:] & ~again[:, :-1])
    farthest = np.nonzero(again[:, :-1] & ~again[:, 1:])[1] - 1
    taken = pa.array(row)
    return pa.RecordBatch.from_arrays(
        [
            piece.column("doc").combine_chunks().take(taken),
            piece.column("tag").combine_chunks().take(taken),
            pa.array((starts[row] + far[row] - farthest).astype(np.int32)),
            pa.array((farthest - nearest + 1).astype(np.int8)),
        ],
        names=["doc", "tag", "start", "n"],
    )


def _merged_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        gram = held.column("gram").to_numpy()
        whole = int(np.searchsorted(gram, gram[-1]))
        if whole >= _PIECE:
            yield _merged(held.slice(0, whole))
            held = held.slice(whole)
    if held is not None:
        yield _merged(held)


def _repeats(texts: DataFrame) -> DataFrame:
    """``doc, tag, start, n``: runs of starts of strings that a document with a smaller id holds too."""
    found = _candidates(texts)
    sampled = texts.join(found, ["doc", "tag"]).select("doc", "tag", "text", "runs")
    places = sampled.mapInArrow(
        _sample_rows, "gram long, doc long, tag long, start int, before binary, behind binary"
    )
    by_gram = places.repartition("gram").sortWithinPartitions("gram", "behind")
    repeats = by_gram.mapInArrow(_merged_rows, "doc long, tag long, start int, n byte")
    if found.select(F.explode("runs.crowded").alias("crowded")).filter("crowded").isEmpty():
        return repeats
    path = scratch_path(texts.sparkSession, "strings")
    strings = stored(sampled.mapInArrow(_string_rows, "doc long, tag long, start int, string binary"), path=path)
    firsts = strings.groupBy("string").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).filter("first < last")
    later = strings.join(stored(firsts.select("string", "first"), "firsts"), "string").filter("doc > first")
    later = stored(later.select("doc", "tag", "start", F.lit(1).cast("byte").alias("n")), "crowded")
    remove(texts.sparkSession, path)
    return repeats.unionByName(later)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    for batch in batches:
        columns: list[list] = [[] for _ in names]
        for doc, text, copied, starts in zip(*(batch.column(k) for k in range(4))):
            data = np.frombuffer(text.as_py().encode(), dtype=np.uint8)
            gone = np.zeros(len(data) + 1, dtype=np.int64)
            if copied.as_py():
                gone[0] = len(data) >= LENGTH
            elif starts.is_valid:
                at, n = (starts.values.field(k).to_numpy() for k in ("start", "n"))
                np.add.at(gone, at, 1)
                np.add.at(gone, at + n + (LENGTH - 1), -1)
            removed = np.cumsum(gone)[:-1] > 0
            kept = data[~removed].tobytes()
            spans = int((removed & ~np.concatenate([[False], removed[:-1]])).sum()) if len(data) else 0
            for column, value in zip(
                columns, (doc.as_py(), len(data), int(removed.sum()), spans, hashlib.sha256(kept).hexdigest(), kept)
            ):
                column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` for every row of ``docs``.

    Bytes covered by a string of ``LENGTH`` bytes that also starts in a document with a
    smaller id are removed; all strings are judged on the input. ``kept`` are the
    remaining bytes (removal may cut a character), ``n_spans`` the maximal removed runs.

    Rows that share an id are one document, so they never remove each other's bytes;
    repeated rows are returned as often as given. A null id is a document before all
    others and is returned as null. Null and empty texts have no bytes. Other columns
    are ignored.
    """
    texts = _ids(docs, id_col, text_col)
    starts = _repeats(texts.filter("not copied")).groupBy("doc", "tag").agg(F.collect_set(F.struct("start", "n")).alias("starts"))
    starts = stored(starts, "starts")
    joined = texts.join(starts, ["doc", "tag"], "left").select("doc", "text", "copied", "starts")
    rows = joined.mapInArrow(_cut, "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return rows.withColumn("doc_id", F.when(F.col("doc") != _NULL_ID, F.col("doc"))).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"
    )
