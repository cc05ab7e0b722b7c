"""Jaccard join of word n-gram sets through parity sketches.

Every set is thrown into parts by a hash, and a part is the exclusive-or of its
members. A member that only one of two sets has changes one part, so sketches differ
in no more parts (and their bits in no more places) than the symmetric difference
counts; sets of a size band whose difference is below the number of parts must agree
in one (pigeonhole), and agree in many when the difference falls at random. Documents
meet in the parts they agree on; pairs are verified exactly.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rankloom.llm.bytework import distinct_by_row, mixed, parts, shingles
from rankloom.llm.components import connected_components
from rankloom.llm.packing import packed, unpacked
from rankloom.session import stored

PERCENT = 80
# Two bands cover sizes that differ by the factor 100/80 twice.
RATIO = (100 / PERCENT) ** 2
# Members of a part at the upper end of a band.
PART_SIZE = 6
MISS = 1e-8
SKETCH_WORDS = 8
# Buckets up to this size compare all pairs at once, larger ones by way of one member first.
SMALL_BUCKET = 4
# Members of a block when what is left of a large bucket is compared.
BLOCK = 1000


def band_floor(band: int) -> int:
    """The smallest set size of a band."""
    return math.ceil(RATIO**band)


def most_different(total: int) -> int:
    """The largest symmetric difference of two linked sets with ``total`` members together."""
    return total * (100 - PERCENT) // (100 + PERCENT)


def _occupied(throws: int, cells: int) -> np.ndarray:
    """Probabilities of 0..cells occupied cells after uniform throws."""
    chance = np.zeros(cells + 1)
    chance[0] = 1.0
    share = np.arange(cells + 1) / cells
    for _ in range(throws):
        chance = chance * share + np.concatenate([[0.0], (chance * (1 - share))[:-1]])
    return chance


def _no_common_part(size: int, cells: int) -> float:
    """Chance that two linked sets of ``size`` members agree in no part that holds a member."""
    different = most_different(2 * size)
    common = size - different // 2
    touched = np.arange(cells + 1)
    return float((_occupied(different, cells) * (touched / cells) ** common).sum())


@functools.lru_cache(maxsize=None)
def layout(band: int) -> tuple[int, int, int]:
    """``(parts a set is thrown into, parts used, repetitions)`` for a band.

    The chance to miss a pair at exactly the threshold stays below ``MISS``; large sets
    need only a share of their parts for that.
    """
    top = band_floor(band + 1) - 1
    if most_different(2 * top) == 0:
        return 0, 0, 0
    cells = max(2, math.ceil(top / PART_SIZE))
    agree = (1 - 1 / cells) ** most_different(2 * top) * (1 - math.exp(-PART_SIZE * RATIO**-1.5))
    used = math.ceil(math.log(MISS) / math.log(1 - agree))
    if cells > used:
        return cells, used, 1
    sizes = range(max(1, int(band_floor(band) * PERCENT / 100)), top + 1)
    worst = max(_no_common_part(n, cells) for n in sizes if most_different(2 * n))
    return cells, cells, max(1, math.ceil(math.log(MISS) / math.log(min(max(worst, 1e-300), 1 - 1e-9))))


def _bands(sizes: np.ndarray) -> np.ndarray:
    top = int(sizes.max(initial=1))
    floors = [band_floor(b) for b in range(int(math.log(max(top, 2)) / math.log(RATIO)) + 3)]
    return np.searchsorted(np.array(floors), sizes, side="right") - 1


def _part_keys(hashes: np.ndarray, owners: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket keys and their owners for the sets of one band; empty parts give none."""
    cells, used, repeats = layout(band)
    keys, of = [], []
    names, local = np.unique(owners, return_inverse=True)
    for repeat in range(repeats):
        seed = np.uint64((band * 1009 + repeat + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        spread = mixed(hashes ^ seed)
        cell = ((spread >> np.uint64(20)) % np.uint64(cells)).astype(np.int64)
        chosen = cell < used
        place = local[chosen] * used + cell[chosen]
        sketch = np.zeros(len(names) * used, dtype=np.uint64)
        np.bitwise_xor.at(sketch, place, mixed(spread[chosen]))
        filled = np.flatnonzero(sketch)
        tag = mixed((filled % used).astype(np.uint64) ^ seed)
        keys.append(mixed(sketch[filled] ^ tag))
        of.append(names[filled // used])
    if not keys:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    return np.concatenate(keys), np.concatenate(of)


def _row_totals(values: np.ndarray, owners: np.ndarray, rows: int, by=np.add) -> np.ndarray:
    out = np.zeros(rows, dtype=np.uint64)
    by.at(out, owners, values)
    return out


def _lists(values: np.ndarray, owners: np.ndarray, rows: int, kind) -> pa.Array:
    order = np.argsort(owners, kind="stable")
    ends = np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=rows))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values[order].view(np.int64), kind))


_SIGNED = "doc_id long, n_shingles long, f1 long, f2 long, sketch array<long>, keys array<long>"


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size, fingerprint, bit sketch and bucket keys of every text."""
    for batch in batches:
        for low, high, data, offsets in parts(batch.column(1)):
            rows = high - low
            hashes, owners = distinct_by_row(*shingles(data, offsets))
            sizes = np.bincount(owners, minlength=rows)
            spread = mixed(hashes)
            bits = np.zeros(rows * SKETCH_WORDS, dtype=np.uint64)
            place = (spread & np.uint64(64 * SKETCH_WORDS - 1)).astype(np.int64)
            np.bitwise_xor.at(bits, owners * SKETCH_WORDS + (place >> 6), np.uint64(1) << (place & 63).astype(np.uint64))
            bands = _bands(sizes)
            keys, of = [], []
            for shift in (0, 1):
                # a set also meets those of the band above that may be 100/80 of its size
                near = sizes > 0 if shift == 0 else 100 * sizes + PERCENT >= PERCENT * np.array([band_floor(b + 1) for b in bands])
                for band in np.unique(bands[near & (sizes > 0)]):
                    mine = ((bands == band) & near & (sizes > 0))[owners]
                    k, o = _part_keys(hashes[mine], owners[mine], int(band) + shift)
                    keys.append(k)
                    of.append(o)
            keys = np.concatenate(keys) if keys else np.zeros(0, dtype=np.uint64)
            of = np.concatenate(of) if of else np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(low, rows),
                    pa.array(sizes.astype(np.int64)),
                    pa.array(_row_totals(mixed(spread), owners, rows).view(np.int64)),
                    pa.array(_row_totals(mixed(~spread), owners, rows).view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * SKETCH_WORDS), pa.array(bits.view(np.int64))),
                    _lists(keys, of, rows, pa.int64()),
                ],
                names=["doc_id", "n_shingles", "f1", "f2", "sketch", "keys"],
            )


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted shingle hashes of every text as little-endian bytes, with its fingerprint."""
    for batch in batches:
        for low, high, data, offsets in parts(batch.column(1)):
            rows = high - low
            hashes, owners = distinct_by_row(*shingles(data, offsets))
            ends = np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=rows))])
            members = [hashes[ends[k] : ends[k + 1]].tobytes() for k in range(rows)]
            spread = mixed(hashes)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(low, rows),
                    pa.array(_row_totals(mixed(spread), owners, rows).view(np.int64)),
                    pa.array(_row_totals(mixed(~spread), owners, rows).view(np.int64)),
                    pa.array(members, pa.binary()),
                ],
                names=["doc_id", "f1", "f2", "members"],
            )


_KIND_PAIR, _KIND_OPEN, _KIND_EDGE = 0, 1, 2


def _bucket_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate pairs from one sorted range of ``(key, node)``.

    A bucket pairs every member with its first one, a small bucket all its members.
    Members of larger buckets are also reported as open, to be compared across
    components later; so are those of the buckets at both ends of the range, which may
    go on in the ranges beside, together with their first member.
    """
    head = held_key = held = None

    def table(kind, key, a, b):
        kinds = pa.array(np.full(len(a), kind, dtype=np.int32))
        return pa.RecordBatch.from_arrays([kinds, pa.array(key), pa.array(a), pa.array(b)], names=["kind", "key", "a", "b"])

    for batch in batches:
        key = batch.column(0).to_numpy(zero_copy_only=False)
        node = batch.column(1).to_numpy(zero_copy_only=False)
        if not len(key):
            continue
        known = 0
        if head is None:
            head = key[0]
            yield table(_KIND_EDGE, key[:1], node[:1], node[:1])
        else:  # the first members of the last bucket so far stand before this batch
            known = len(held)
            key, node = np.concatenate([held_key, key]), np.concatenate([held, node])
        begins = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        sizes = np.diff(np.concatenate([begins, [len(key)]]))
        start = np.repeat(begins, sizes)
        at = np.arange(len(key)) - start
        new = np.arange(len(key)) >= known
        star = new & (at > 0)
        yield table(_KIND_PAIR, key[star], node[start[star]], node[star])
        for back in range(1, SMALL_BUCKET - 1):
            near = np.flatnonzero(new & (at > back) & (at < SMALL_BUCKET))
            yield table(_KIND_PAIR, key[near], node[near - back], node[near])
        # members known from the batch before are reported when their bucket turns large
        late = (at[known - 1] < SMALL_BUCKET and key[0] != head) if known else False
        out = (np.repeat(sizes > SMALL_BUCKET, sizes) | (key == head)) & (new | late)
        yield table(_KIND_OPEN, key[out], node[out], node[out])
        last = begins[-1]
        held_key, held = key[last : last + SMALL_BUCKET + 1], node[last : last + SMALL_BUCKET + 1]
    if held is not None:
        yield table(_KIND_EDGE, held_key[:1], held[:1], held[:1])
        if len(held) <= SMALL_BUCKET and held_key[0] != head:
            yield table(_KIND_OPEN, held_key, held, held)


def _shared_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = [
            len(np.intersect1d(np.frombuffer(x.as_py(), "<u8"), np.frombuffer(y.as_py(), "<u8"), assume_unique=True))
            for x, y in zip(batch.column(4), batch.column(5))
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column(k) for k in range(4)] + [pa.array(counts, pa.int64())], names=["a", "b", "n_a", "n_b", "n_shared"]
        )


def _plausible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs whose sizes and parity bits allow a link."""
    a = classes.select(F.col("node").alias("a"), F.col("n_shingles").alias("n_a"), F.col("sketch").alias("sketch_a"))
    b = classes.select(F.col("node").alias("b"), F.col("n_shingles").alias("n_b"), F.col("sketch").alias("sketch_b"))
    flipped = F.zip_with("sketch_a", "sketch_b", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    distance = F.aggregate(flipped, F.lit(0), lambda s, x: s + x)
    small = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * PERCENT
    allowed = F.expr(f"((n_a + n_b) * {100 - PERCENT}) div {100 + PERCENT}")
    return pairs.join(a, "a").join(b, "b").filter(small).filter(distance <= allowed).select("a", "b", "n_a", "n_b")


def _block_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Plausible pairs across components within every cell ``(key, x, y)`` of sorted rows.

    A cell holds two blocks of a bucket's members, or one; sketches are compared as bit
    matrices and only pairs that sizes and bits allow leave the task.
    """
    held = None

    def pairs(columns):
        node, label, size, own, bits = columns[3:]
        n = len(node)
        different = np.zeros((n, n), dtype=np.int32)
        for word in bits.T:
            different += np.bitwise_count(word[:, None] ^ word[None, :])
        total = size[:, None] + size[None, :]
        fits = different * (100 + PERCENT) <= total * (100 - PERCENT)
        fits &= 100 * np.minimum(size[:, None], size[None, :]) >= PERCENT * np.maximum(size[:, None], size[None, :])
        fits &= label[:, None] != label[None, :]
        fits &= node[:, None] < node[None, :]
        if columns[1][0] != columns[2][0]:
            fits &= own[:, None] != own[None, :]
        a, b = np.nonzero(fits)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (node[a], node[b], size[a], size[b])], names=["a", "b", "n_a", "n_b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(7)]
        columns.append(batch.column(7).flatten().to_numpy().view(np.uint64).reshape(-1, SKETCH_WORDS))
        if held is not None:
            columns = [np.concatenate([h, c]) for h, c in zip(held, columns)]
        fresh = np.zeros(len(columns[0]), dtype=bool)
        for cell in columns[:3]:
            fresh[1:] |= cell[1:] != cell[:-1]
        begins = [0, *np.flatnonzero(fresh)]
        for begin, end in zip(begins, begins[1:]):
            yield pairs([c[begin:end] for c in columns])
        held = [c[begins[-1] :] for c in columns]
    if held is not None:
        yield pairs(held)


def _across(labelled: DataFrame, classes: DataFrame) -> DataFrame:
    """Plausible pairs of members of one bucket that are in different components.

    The members of a bucket are dealt into blocks of about ``BLOCK``, and every two
    blocks are compared in a cell of their own.
    """
    held = labelled.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("members"))
    rest = labelled.join(stored(held.filter("lo <> hi").select("key", "members"), "mixed"), "key")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    dealt = rest.withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    cells = dealt.select("key", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "node", "label", "own")
    rows = cells.join(classes.select("node", "n_shingles", "sketch"), "node").dropDuplicates(["key", "x", "y", "node"])
    rows = rows.select("key", "x", "y", "node", "label", "n_shingles", "own", "sketch")
    sorted_rows = rows.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")
    return sorted_rows.mapInArrow(_block_pairs, "a long, b long, n_a long, n_b long").distinct()


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """``a, b`` of the plausible pairs whose exact Jaccard similarity reaches the threshold."""
    pairs = stored(pairs, "pairs")
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = nodes.join(classes.select("node", "doc_id", "f1", "f2"), "node")
    texts = docs.join(wanted.select("doc_id").distinct(), "doc_id").select("doc_id", "text")
    sets = texts.mapInArrow(_set_rows, "doc_id long, f1 long, f2 long, members binary")
    # rows that share an id are told apart by the fingerprint
    sets = sets.dropDuplicates(["doc_id", "f1", "f2"]).join(wanted, ["doc_id", "f1", "f2"]).select("node", "members")
    sets = stored(sets, "sets")
    both = pairs.join(sets.withColumnsRenamed({"node": "a", "members": "members_a"}), "a").join(
        sets.withColumnsRenamed({"node": "b", "members": "members_b"}), "b"
    )
    counted = both.select("a", "b", "n_a", "n_b", "members_a", "members_b").mapInArrow(
        _shared_counts, "a long, b long, n_a long, n_b long, n_shared long"
    )
    union = F.col("n_a") + F.col("n_b") - F.col("n_shared")
    return stored(counted.filter(F.col("n_shared") * 100 >= union * PERCENT).select("a", "b"), "links")


def _candidates(classes: DataFrame) -> DataFrame:
    """``kind, key, a, b`` rows of all buckets (see :func:`_bucket_rows`), stored."""
    members = classes.select(F.explode("keys").alias("key"), "node")
    ordered = members.repartitionByRange("key", "node").sortWithinPartitions("key", "node")
    return stored(ordered.mapInArrow(_bucket_rows, "kind int, key long, a long, b long"), "buckets")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct()


def _same_ids(signed: DataFrame, named: DataFrame) -> DataFrame:
    """Links between the classes of rows that share an id."""
    nodes = signed.select("doc_id", "f1", "f2").join(named, ["f1", "f2"]).select("doc_id", "node")
    spread = nodes.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b"), F.collect_set("node").alias("s"))
    return spread.filter("a <> b").select("a", F.explode("s").alias("b")).filter("a <> b")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, class_id`` for every row of ``docs``.

    A text's set are its distinct five-word shingles, A-Z lower-cased; with one to four
    words the whole sequence as one. Texts link when their intersection is at least
    ``PERCENT`` of their union; ``component_id`` is the smallest id reachable by links.

    Texts with equal sets form a class with one representative, so copies cost one row
    each. Buckets are ranges of sorted keys: a bucket that very many sets share spreads
    over ranges. In a bucket all members are first compared with one member; members of
    a large bucket that then are still in different components are compared with each
    other, so no link between sets that meet in a bucket is lost.

    Null and empty texts have no shingles and link with nothing. Rows that share an id
    are one document, linked through each of its texts; rows are returned as often as
    given. A null id counts as one document smaller than all others, so it also names
    its component. Other columns are ignored.
    """
    narrow = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("doc_id"), F.col(text_col).alias("text"))
    signed = stored(narrow.mapInArrow(_signed, _SIGNED), "signed")
    nonempty = signed.filter("n_shingles > 0")
    first = nonempty.groupBy("f1", "f2").agg(F.min("doc_id").alias("node"))
    named = stored(first, "classes")
    heads = nonempty.join(named.withColumnRenamed("node", "doc_id"), ["f1", "f2", "doc_id"]).dropDuplicates(["f1", "f2"])
    classes = stored(heads.withColumn("node", F.col("doc_id")), "heads")

    buckets = _candidates(classes)
    pairs = buckets.filter(F.col("kind") == _KIND_PAIR).select("a", "b")
    # buckets cut by a range end: link their first members in order
    ends = buckets.filter(F.col("kind") == _KIND_EDGE).select("key", "a").distinct()
    crossing = ends.groupBy("key").agg(F.array_sort(F.collect_set("a")).alias("s")).filter(F.size("s") > 1)
    crossing = crossing.select(F.col("s")[0].alias("a"), F.explode("s").alias("b"))
    first_pairs = _plausible(_ordered(pairs.unionByName(crossing)), classes)
    links = _verified(first_pairs, narrow, classes).unionByName(_same_ids(nonempty, named))
    labels = stored(connected_components(links), "labels")

    opened = buckets.filter(F.col("kind") == _KIND_OPEN).select("key", F.col("a").alias("node")).distinct()
    labelled = opened.join(labels, "node", "left").select("key", "node", F.coalesce("component", "node").alias("label"))
    more = _verified(_across(stored(labelled, "open"), classes), narrow, classes)
    component = connected_components(links.unionByName(more).distinct())

    of_class = named.join(component, "node", "left").select("f1", "f2", F.col("node").alias("class_id"), F.coalesce("component", "node").alias("component_id"))
    of_class = stored(of_class, "components")
    found = signed.join(of_class, ["f1", "f2"], "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return found.select(
        F.when(F.col("doc_id") != -(2**63), F.col("doc_id")).alias("doc_id"),
        "n_shingles",
        F.when(own != -(2**63), own).alias("component_id"),
        F.when(F.coalesce("class_id", "doc_id") != -(2**63), F.coalesce("class_id", "doc_id")).alias("class_id"),
    )


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their component, with their own columns, whatever their names.

    Null and empty texts link with nothing and stay. All rows of an id stay or go
    together, so repeated rows do too; rows without an id are one document, smaller than
    all others.
    """
    kept = jaccard_components(docs, id_col, text_col).filter("doc_id <=> component_id").select(F.col("doc_id").alias("kept")).distinct()
    rows = packed(docs, id_col, text_col)
    return unpacked(rows.join(kept, F.col("id").eqNullSafe(F.col("kept")), "left_semi"))
