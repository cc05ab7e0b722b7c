"""Ranges of sorted terms against comparing every prefix with every term."""

import random

import pytest

from rankloom.operators.prefixes import prefix_matches, range_cuts
from rankloom.operators.suggest import autocomplete, near_beginnings


def brute(prefixes, terms, top):
    rows = set()
    for p in prefixes:
        best = sorted((-df, t) for t, df in terms.items() if t.startswith(p))
        rows |= {(p, t, -n) for n, t in (best if top is None else best[:top])}
    return rows


@pytest.mark.parametrize("top", [None, 3])
@pytest.mark.parametrize("block_rows", [20, 50_000])
def test_ranges_over_any_number_of_blocks(spark, top, block_rows):
    draw = random.Random(5)
    word = lambda n: "".join(draw.choice("abé日😀") for _ in range(draw.randint(1, n)))
    # A third of the terms begin alike, so that cuts lie inside the range of a prefix.
    terms = {("aaa" if i % 3 == 0 else "") + word(7): draw.randint(1, 4) for i in range(400)}
    prefixes = {word(4) for _ in range(80)} | {"a", "aa", "aaa", "zz"}
    stored = spark.createDataFrame(list(terms.items()), "key string, df long")
    asked = spark.createDataFrame([(p,) for p in prefixes], "prefix string")
    assert bool(range_cuts(stored, block_rows)) == (block_rows == 20)
    found = prefix_matches(asked, stored, top, block_rows)
    rows = [tuple(r) for r in found.select("prefix", "key", "df").collect()]
    assert len(rows) == len(set(rows)) and set(rows) == brute(prefixes, terms, top)


def test_empty_sides_and_the_empty_prefix(spark):
    none = spark.createDataFrame([], "key string, df long")
    terms = spark.createDataFrame([("b", 1), ("a", 1)], "key string, df long")
    prefix = spark.createDataFrame([("",)], "prefix string")
    assert prefix_matches(prefix, none).count() == 0
    assert prefix_matches(prefix.limit(0), terms).count() == 0
    assert [r["key"] for r in prefix_matches(prefix, terms, 1).collect()] == ["a"]


def test_very_long_words_are_not_spelled_out(spark):
    long = "x" * 100_000
    words = spark.createDataFrame([(long,), ("paspoort",)], "term string")
    asked = spark.createDataFrame([("paspo",), ("12345",), (long[:-1],)], "term string")
    found = {(r["term"][:8], r["match"][:8], r["edits"]) for r in near_beginnings(asked, words).collect()}
    assert {("paspo", "paspo", 0), ("paspo", "pasp", 1), ("12345", "12345", 0)} <= found
    docs = spark.createDataFrame([(1, f"een {long}"), (2, "een paspoort")], "id int, title string")
    typed = spark.createDataFrame([(1, "een " + long[:50_000]), (2, "een pasp"), (3, "")], "prefix_id int, prefix string")
    rows = {(r["prefix_id"], r["text"]) for r in autocomplete(docs, ["title"], typed).collect()}
    assert rows == {(1, f"een {long}"), (2, "een paspoort")}
