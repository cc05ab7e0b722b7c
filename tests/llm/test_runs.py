"""Periodic runs against brute force."""

import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from rankloom import llm
from rankloom.llm import runs
from rankloom.llm.bytework import mixed

SF_DIR = "/root/testdata/sf0.001"
SPACES = " \t\n\v\f\r"


def words_of(text):
    return "".join(" " if c in SPACES else c for c in text or "").split(" ") if text else []


def brute(words):
    """All runs by comparing the words with themselves at every distance."""
    names = {w: k for k, w in enumerate(dict.fromkeys(words))}
    ids = np.array([names[w] for w in words], dtype=np.int64)
    found, seen = [], set()
    for q in range(1, len(ids) // 4 + 1):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], ids[q:] == ids[:-q], [0]]).astype(int)))
        for start, end in zip(edges[::2].tolist(), (edges[1::2] + q).tolist()):
            if end - start >= max(6, 4 * q) and (start, end) not in seen:
                seen.add((start, end))
                found.append((start, end - start, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query_against_brute_force(spark):
    rows = {r["doc_id"]: r for r in llm.queries()["op11_grammar_runs"](spark, SF_DIR).collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    assert len(rows) == len(docs)
    some = 0
    for doc in docs:
        words = planted(doc["doc_id"], [w for w in words_of(doc["text"]) if w])
        found, row = brute(words), rows[doc["doc_id"]]
        some += bool(found)
        assert row["n_runs"] == len(found)
        assert row["runs_sha256"] == sha("".join(f"{s},{n},{q}\n" for s, n, q in found))
        assert row["collapsed_sha256"] == sha(collapsed(words, found))
        best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        wanted = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (row["start"], row["length"], row["period"], row["exponent_milli"]) == wanted
    assert some > 5


@settings(max_examples=150, deadline=None)
@given(
    st.lists(
        st.tuples(st.lists(st.integers(0, 3), max_size=40), st.lists(st.integers(0, 3), max_size=12), st.integers(0, 9)),
        min_size=1,
        max_size=3,
    )
)
def test_runs_of_small_alphabets(texts):
    texts = [head + stretch * times + head[:5] for head, stretch, times in texts]
    ids = mixed(np.array([w for t in texts for w in t], dtype=np.uint64))
    rows = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    wanted, low = [], 0
    for t in texts:
        wanted += [[low + s, low + s + n, q] for s, n, q in brute(t)]
        low += len(t)
    assert runs.word_runs(ids, rows).tolist() == wanted


def test_hashes_that_agree_too_far_are_corrected():
    ids = np.arange(40, dtype=np.uint64) % np.uint64(5)
    ids[20] = 99
    got = runs._checked(ids, np.array([0]), np.array([40]), np.array([5]))
    assert got.tolist() == [[0, 20, 5]]  # 19 words remain behind the odd one


def test_odd_rows(spark):
    long = "x " * 200_000
    clash = "doc_id long, text string, runs string, collapsed int, n_words int"
    rows = [
        (1, None, "a", 1, 1),
        (2, "", "a", 1, 1),
        (3, " \n\t ", "a", 1, 1),
        (None, "a a a a a a b", "a", 1, 1),
        (4, "a a a a a", "a", 1, 1),
        (5, long, "a", 1, 1),
        (5, long, "a", 1, 1),
        (6, "a b " * 4 + "a b", None, None, None),
    ]
    got = runs.periodic_runs(spark.createDataFrame(rows, clash)).collect()
    by_id = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows) and sum(r["doc_id"] == 5 for r in got) == 2
    assert [by_id[k]["n_words"] for k in (1, 2, 3, 4, 6)] == [0, 0, 0, 5, 9]
    assert [tuple(r) for r in by_id[None]["runs"]] == [(0, 6, 1)] and by_id[None]["collapsed"] == "a b"
    assert by_id[4]["runs"] == [] and by_id[4]["collapsed"] == "a a a a a"
    assert [tuple(r) for r in by_id[5]["runs"]] == [(0, 200_000, 1)] and by_id[5]["collapsed"] == "x"
    assert [tuple(r) for r in by_id[6]["runs"]] == [(0, 8, 2)] and by_id[6]["collapsed"] == "a b a b"


def test_empty_table(spark):
    assert runs.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("period", [1, 2, 7, 400])
def test_long_periods(period):
    rng = np.random.default_rng(period)
    stretch = rng.integers(0, 2**60, period).astype(np.uint64)
    ids = np.concatenate([rng.integers(0, 2**60, 11).astype(np.uint64), np.tile(stretch, 9), stretch[: period // 2]])
    got = runs.word_runs(ids, np.zeros(len(ids), dtype=np.int64))
    assert got.tolist() == [[11, len(ids), period]]
