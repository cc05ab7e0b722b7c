"""Vectorised work on the bytes of whole texts inside Arrow batches.

Every function takes plain numpy arrays for one part of a batch: ``data``, the
UTF-8 bytes of its rows one after another, and ``offsets``, where each row
starts (one entry more than rows). Nothing here knows about Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PART_BYTES = 1 << 22
# Rows of a part are numbered in 12 bits beside a 52-bit hash (see distinct_by_row).
PART_ROWS = 1 << 12
HASH_BITS = 52
HASH_MASK = np.uint64((1 << HASH_BITS) - 1)
SHINGLE_WORDS = 5


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values (splitmix64's finaliser)."""
    with np.errstate(over="ignore"):
        v = values.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
        v = (v ^ (v >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        v = (v ^ (v >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return v ^ (v >> np.uint64(31))


_BYTE_CODES = mixed(np.arange(256, dtype=np.uint64)) | np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER_CODES = _BYTE_CODES[_LOWER]
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = np.uint64(0x5851F42D4C957F2D)
_UNBASE = np.uint64(pow(0x5851F42D4C957F2D, -1, 1 << 64))
_WORD_FACTORS = mixed(np.arange(100, 100 + SHINGLE_WORDS, dtype=np.uint64)) | np.uint64(1)
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the hash base and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _UNBASE)):
            steps = np.full(max(n, PART_BYTES + 2), base, dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def parts(column: pa.Array, limit: int = PART_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, row after the last, data, offsets)`` of bounded parts; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return
    filled = column.cast(pa.large_binary())
    filled = pc.fill_null(filled, b"") if filled.null_count else filled
    _, where, content = filled.buffers()
    ends = np.frombuffer(where, dtype=np.int64)[filled.offset : filled.offset + len(filled) + 1]
    data = np.frombuffer(content, dtype=np.uint8) if content is not None else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < len(filled):
        last = int(np.searchsorted(ends, ends[row] + limit, side="right")) - 1
        last = min(max(last, row + 1), row + PART_ROWS, len(filled))
        yield row, last, data[ends[row] : ends[last]], ends[row : last + 1] - ends[row]
        row = last


def prefix_hashes(data: np.ndarray, codes: np.ndarray = _BYTE_CODES) -> np.ndarray:
    """Running polynomial sums; the hash of a slice is a difference of two of them."""
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(codes[data] * powers(len(data) + 1)[0][:-1], out=sums[1:])
    return sums


def slice_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``data[start:end]`` that do not depend on the place."""
    with np.errstate(over="ignore"):
        return mixed((sums[ends] - sums[starts]) * powers(len(sums))[1][starts])


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ``[^\\x20\\x09-\\x0D]`` and where each row's words begin."""
    inside = ~_IS_SPACE[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def shingles(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all five-word shingles and their rows, in text order.

    A row of one to four words has its whole sequence as its only shingle.
    """
    starts, ends, first = words(data, offsets)
    hashes = slice_hashes(prefix_hashes(data, _LOWER_CODES if lower else _BYTE_CODES), starts, ends)
    counts = np.diff(first)
    rows = np.repeat(np.arange(len(counts)), counts)
    n = max(0, len(hashes) - SHINGLE_WORDS + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(n, dtype=np.uint64)
        for j in range(SHINGLE_WORDS):
            sums += hashes[j : j + n] * _WORD_FACTORS[j]
        whole = rows[:n] == rows[SHINGLE_WORDS - 1 :] if n else np.zeros(0, dtype=bool)
        short = np.flatnonzero((counts > 0) & (counts < SHINGLE_WORDS))
        tails = np.zeros(len(short), dtype=np.uint64)
        for j in range(SHINGLE_WORDS - 1):
            has = counts[short] > j
            tails[has] += hashes[first[short[has]] + j] * _WORD_FACTORS[j]
        tails += counts[short].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    values = np.concatenate([sums[whole], tails])
    owners = np.concatenate([rows[:n][whole], short])
    return mixed(values) & HASH_MASK, owners


def distinct_by_row(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct 52-bit hashes of every row, sorted by row and hash, and their rows."""
    keys = np.unique((rows.astype(np.uint64) << np.uint64(HASH_BITS)) | hashes)
    return keys & HASH_MASK, (keys >> np.uint64(HASH_BITS)).astype(np.int64)
