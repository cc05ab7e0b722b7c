"""Periodic runs of words, found on a grammar of the text.

A run is a stretch of words with smallest period q (words q apart are equal) and at
least ``MIN_LENGTH`` and ``MIN_EXPONENT * q`` words that no neighbour extends.

1. Words in no five-word gram that the text repeats can't lie in a run (see ``GRAM``)
   and are left out; runs never reach across them.
2. The word ids of the rest are compressed by Re-Pair in rounds: of overlapping pairs the
   more frequent one is replaced, equal pairs by the same nonterminal, until no pair
   occurs twice. What then is left is joined two by two.
3. A run lies across the boundary of exactly one lowest node of this tree, so for every
   nonterminal the runs across the boundary of its two halves are computed once, at its
   first place, from common extensions of both sides.
4. They are carried over to every place where the nonterminal was put in; stretches
   inside a longer one of the same period are merged into it.

Each text is compressed by itself or beside others of its Arrow batch, in bounded parts,
so nothing is shuffled and a lost executor costs its partitions only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rankloom.llm.bytework import mixed, parts, powers, prefix_hashes, slice_hashes, words

MIN_LENGTH = 6
MIN_EXPONENT = 4
# The widest gram that every run holds twice for each of its words: a run of period q has
# at least max(MIN_LENGTH, MIN_EXPONENT * q) - GRAM + 1 >= 2 * q grams.
GRAM = min(max(MIN_LENGTH, MIN_EXPONENT * q) - 2 * q + 1 for q in range(1, MIN_LENGTH + 1))
# Pairs of nonterminal and period looked at together.
_CHUNK = 1 << 21


def repeated_words(ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """True for words inside a gram that their row repeats."""
    n = len(ids) - GRAM + 1
    live = np.zeros(len(ids) + 1, dtype=np.int64)
    if n > 0:
        factors = mixed(np.arange(GRAM, dtype=np.uint64)) | np.uint64(1)
        with np.errstate(over="ignore"):
            grams = rows[:n].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            for k in range(GRAM):
                grams = grams + ids[k : k + n] * factors[k]
        at = np.flatnonzero(rows[:n] == rows[GRAM - 1 :])
        order = at[np.argsort(mixed(grams[at]), kind="stable")]
        same = grams[order][1:] == grams[order][:-1]
        again = np.zeros(len(order), dtype=bool)
        again[1:] |= same
        again[:-1] |= same
        np.add.at(live, order[again], 1)
        np.add.at(live, order[again] + GRAM, -1)
    return np.cumsum(live)[:-1] > 0


@dataclass(frozen=True)
class Grammar:
    """Nonterminals by number and all places where they were put in, in word numbers."""

    first: np.ndarray  # first place of each nonterminal
    middle: np.ndarray  # where its right half begins there
    end: np.ndarray
    used: np.ndarray  # nonterminal of every use
    at: np.ndarray  # place of every use


def _alternating(same: np.ndarray) -> np.ndarray:
    """True at every second place of a stretch; ``same`` tells where a place continues the one before."""
    at = np.arange(len(same))
    begin = np.maximum.accumulate(np.where(same, 0, at))
    return (at - begin) % 2 == 1


def _frequent(key: np.ndarray, ok: np.ndarray) -> np.ndarray:
    """Places of repeated pairs that are more frequent than the pairs they overlap."""
    cand = np.flatnonzero(ok)
    pairs, which, count = np.unique(key[cand], return_inverse=True, return_counts=True)
    rank = np.zeros(len(pairs), dtype=np.int64)
    rank[np.lexsort((mixed(pairs), count))] = np.arange(1, len(pairs) + 1)
    rank[count < 2] = 0
    weight = np.zeros(len(key) + 2, dtype=np.int64)
    weight[cand + 1] = rank[which]
    # a a a: the pairs at odd places overlap equal ones
    weight[_alternating(np.concatenate([[False], (weight[1:] == weight[:-1]) & (weight[1:] > 0)]))] = 0
    inner = weight[1:-1]
    return np.flatnonzero((inner > weight[:-2]) & (inner > weight[2:]))


def repair_grammar(ids: np.ndarray, rows: np.ndarray, live: np.ndarray) -> Grammar:
    """The grammar of the live words; no nonterminal reaches across a row or a word left out."""
    place = np.flatnonzero(live)
    symbol = np.unique(ids[place], return_inverse=True)[1].astype(np.int64)
    row, length = rows[place], np.ones(len(place), dtype=np.int64)
    following = int(symbol.max()) + 1 if len(symbol) else 0
    shift, frequent = following, True
    found: dict[str, list[np.ndarray]] = {k: [] for k in ("first", "middle", "end", "used", "at")}
    while len(symbol) > 1:
        ok = (place[:-1] + length[:-1] == place[1:]) & (row[:-1] == row[1:])
        key = np.where(ok, symbol[:-1] * following + symbol[1:], -1)
        if frequent:
            chosen = _frequent(key, ok)
            if not len(chosen):
                frequent = False
                continue
        else:
            chosen = np.flatnonzero(ok & ~_alternating(np.concatenate([[False], ok[:-1]])))
            if not len(chosen):
                break
        _, begin, which = np.unique(key[chosen], return_index=True, return_inverse=True)
        left, right = length[chosen], length[chosen + 1]
        at = place[chosen]
        found["first"].append(at[begin])
        found["middle"].append((at + left)[begin])
        found["end"].append((at + left + right)[begin])
        found["used"].append(which + following - shift)
        found["at"].append(at)
        symbol[chosen] = which + following
        length[chosen] = left + right
        following += len(begin)
        keep = np.ones(len(symbol), dtype=bool)
        keep[chosen + 1] = False
        symbol, place, row, length = symbol[keep], place[keep], row[keep], length[keep]
    none = np.zeros(0, dtype=np.int64)
    return Grammar(**{k: np.concatenate([none, *v]) for k, v in found.items()})


def _common(sums: np.ndarray, x: np.ndarray, y: np.ndarray, limit: np.ndarray, back: bool) -> np.ndarray:
    """How far the words from x and from y agree, at most ``limit``; ``back``: of those before x and y."""
    low, high = np.zeros(len(x), dtype=np.int64), np.maximum(limit, 0)
    while len(x) and (low < high).any():
        mid = (low + high + 1) // 2
        a, b = (x - mid, y - mid) if back else (x, y)
        agree = slice_hashes(sums, a, a + mid) == slice_hashes(sums, b, b + mid)
        low, high = np.where(agree, mid, low), np.where(agree, high, mid - 1)
    return low


def _smallest_periods(owner: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Places of the smallest period of every stretch of an owner."""
    order = np.lexsort((period, end, start, owner))
    o, s, e = owner[order], start[order], end[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (o[1:] != o[:-1]) | (s[1:] != s[:-1]) | (e[1:] != e[:-1])
    return order[new]


def _crossing(ids: np.ndarray, sums: np.ndarray, grammar: Grammar, some: np.ndarray) -> tuple[np.ndarray, ...]:
    """``nonterminal, start, end, period`` of the stretches across the boundaries of ``some`` nonterminals.

    At least half of a run's MIN_EXPONENT periods lie on one side of the boundary, so the
    words next to it agree with those a period further on that side.
    """
    most = (grammar.end[some] - grammar.first[some]) // MIN_EXPONENT
    which = np.repeat(some, most)
    q = np.arange(len(which)) - np.repeat(np.cumsum(most) - most, most) + 1
    s, m, e = grammar.first[which], grammar.middle[which], grammar.end[which]
    out = []
    for right in (True, False):
        side = np.flatnonzero((e - m if right else m - s) >= 2 * q)
        step = q[side] if right else -q[side]
        mid = m[side]
        side = side[(ids[mid - 1] == ids[mid - 1 + step]) & (ids[mid] == ids[mid + step])]
        period, low, mid, high = q[side], s[side], m[side], e[side]
        a, b = (mid, mid + period) if right else (mid - period, mid)
        start = a - _common(sums, a, b, a - low, back=True)
        end = b + _common(sums, a, b, high - b, back=False)
        long = end - start >= np.maximum(MIN_LENGTH, MIN_EXPONENT * period)
        out.append([v[long] for v in (which[side], start, end, period)])
    owner, start, end, period = (np.concatenate(v) for v in zip(*out))
    kept = _smallest_periods(owner, start, end, period)
    return owner[kept], start[kept], end[kept], period[kept]


def _translated(grammar: Grammar, owner: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """The stretches of every nonterminal at every place of its use."""
    order = np.argsort(owner, kind="stable")
    sorted_owner = owner[order]
    low, high = (np.searchsorted(sorted_owner, grammar.used, side=side) for side in ("left", "right"))
    many = high - low
    use = np.repeat(np.arange(len(many)), many)
    which = order[np.arange(len(use)) - np.repeat(np.cumsum(many) - many, many) + low[use]]
    moved = grammar.at[use] - grammar.first[grammar.used[use]]
    start, end, period = (c[which] for c in columns)
    return start + moved, end + moved, period


def _merged(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, ...]:
    """Stretches inside another one of the same period go; of equal ones the smallest period stays.

    A whole run is among the stretches, as it is found at the lowest node that holds it.
    """
    order = np.lexsort((-end, start, period))
    start, end, period = start[order], end[order], period[order]
    if len(start):
        reach = np.cumsum(np.concatenate([[0], period[1:] != period[:-1]])) * (int(end.max()) + 1) + end
        new = np.concatenate([[True], reach[1:] > np.maximum.accumulate(reach)[:-1]])
        start, end, period = start[new], end[new], period[new]
    kept = _smallest_periods(np.zeros(len(start), dtype=np.int64), start, end, period)
    return start[kept], end[kept], period[kept]


def _checked(ids: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> np.ndarray:
    """``start, end, period`` rows after comparing the words themselves; hashes can only agree too far."""
    out = []
    for s, e, q in zip(start.tolist(), end.tolist(), period.tolist()):
        wrong = np.flatnonzero(ids[s : e - q] != ids[s + q : e])
        begins, ends = [s, *(wrong + s + 1).tolist()], [*(wrong + s + q).tolist(), e]
        out += [(a, b, q) for a, b in zip(begins, ends) if b - a >= max(MIN_LENGTH, MIN_EXPONENT * q)]
    return np.array(out, dtype=np.int64).reshape(-1, 3)


def word_runs(ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """``start, end, period`` of all runs by start, then period; ``rows`` tells which words belong together."""
    grammar = repair_grammar(ids, rows, repeated_words(ids, rows))
    sums = np.zeros(len(ids) + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((mixed(ids) | np.uint64(1)) * powers(len(ids) + 1)[0][:-1], out=sums[1:])
    size = grammar.end - grammar.first
    large = np.flatnonzero(size >= MIN_LENGTH)
    cuts = np.flatnonzero(np.diff(np.cumsum(size[large]) // (_CHUNK * MIN_EXPONENT))) + 1
    found = [_crossing(ids, sums, grammar, some) for some in np.split(large, cuts) if len(some)]
    if not found:
        return np.zeros((0, 3), dtype=np.int64)
    stretches = _translated(grammar, *(np.concatenate(c) for c in zip(*found)))
    runs = _checked(ids, *_merged(*stretches))
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray, n_rows: int) -> pa.Array:
    """The given words of each row, joined by one space."""
    size = ends - starts
    size[:-1] += rows[1:] == rows[:-1]
    at = np.cumsum(size) - size
    source = np.arange(int(size.sum())) - np.repeat(at - starts, size)
    out = np.append(data, np.uint8(0))[source]
    spaced = np.flatnonzero(size > ends - starts)
    out[(at + size - 1)[spaced]] = 0x20
    begins = np.append(at, len(out))[np.searchsorted(rows, np.arange(n_rows + 1))].astype(np.int32)
    return pa.StringArray.from_buffers(n_rows, pa.py_buffer(begins), pa.py_buffer(np.ascontiguousarray(out)))


def _run_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high, data, offsets in parts(batch.column(1)):
            starts, ends, first = words(data, offsets)
            ids = slice_hashes(prefix_hashes(data), starts, ends)
            rows = np.repeat(np.arange(high - low), np.diff(first))
            runs = word_runs(ids, rows)
            gone = np.zeros(len(ids) + 1, dtype=np.int64)
            np.add.at(gone, runs[:, 0] + runs[:, 2], 1)
            np.add.at(gone, runs[:, 1], -1)
            keep = np.flatnonzero(np.cumsum(gone)[:-1] == 0)
            owner = rows[runs[:, 0]]
            listed = pa.StructArray.from_arrays(
                [pa.array(runs[:, 0] - first[owner]), pa.array(runs[:, 1] - runs[:, 0]), pa.array(runs[:, 2])],
                names=["start", "length", "period"],
            )
            ends_of = np.searchsorted(owner, np.arange(high - low + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(low, high - low),
                    pa.array(np.diff(first)),
                    pa.ListArray.from_arrays(pa.array(ends_of), listed),
                    _joined(data, starts[keep], ends[keep], rows[keep], high - low),
                ],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for every row of ``docs``.

    ``runs`` are the start (a word's number), length and period of every run, by start,
    then period. ``collapsed`` is the text without the words that some run holds after
    its first period, the other words joined by one space. Words are the runs of
    characters other than 0x20 and 0x09 to 0x0D; A and a differ.

    Null and empty texts have no words and no runs; a text may be as long as a value can
    be. Rows are judged one by one, so repeated rows and ids are returned as often as
    given and null ids stay null. An empty table gives no rows. Other columns are ignored.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return narrow.mapInArrow(_run_rows, schema)
