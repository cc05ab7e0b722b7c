"""Retrieval, ranking, curation and suggestion, edge by edge."""

import json
import math
import random

import numpy as np
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from rankloom.functions import text
from rankloom.operators import vectors
from rankloom.operators.compounds import compound_parts
from rankloom.operators.curation import match_best_bets, pin
from rankloom.operators.facets import facet_counts, filter_documents, newest_first
from rankloom.operators.fuzzy import fuzzy_query_terms, one_edit_pairs
from rankloom.operators.keyword import (
    freshness_factor,
    keyword_search,
    query_terms,
    score_pairs,
    search_postings,
    top_k,
    weighted_query_terms,
)
from rankloom.operators.postings import (
    document_postings,
    load_postings,
    save_postings,
    term_statistics,
    vocabulary,
)
from rankloom.operators.rerank import fuse, rerank
from rankloom.operators.suggest import autocomplete, did_you_mean, suggestion_rows
from rankloom.operators.synonyms import by_term, expand_queries, phrase_hits, rule_statistics, rule_violations
from rankloom.operators.vectors import knn
from rankloom.plans.search import Index, run_queries
from rankloom.session import settled
from rankloom.sources.best_bets import bet_keys, parse_best_bets, read_best_bets
from rankloom.sources.profiles import DEFAULT_PROFILE, Freshness, load_profile
from rankloom.sources.synonym_files import read_rules


def queries_of(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "query_id int, query string")


def documents_of(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, body string")


def brute_bm25(docs, query, k1=1.2, b=0.75):
    words = [d.lower().split() for d in docs]
    n, mean = len(docs), sum(map(len, words)) / len(docs)
    scores = {}
    for i, w in enumerate(words):
        total = 0.0
        for term in query.lower().split():
            df = sum(term in x for x in words)
            tf = w.count(term)
            if tf:
                total += math.log(1 + (n - df + 0.5) / (df + 0.5)) * tf * (k1 + 1) / (
                    tf + k1 * (1 - b + b * len(w) / mean)
                )
        if any(t in w for t in query.lower().split()):
            scores[i] = round(total, 6)
    return sorted(scores.items(), key=lambda s: (-s[1], s[0]))


@pytest.fixture(scope="module")
def corpus():
    """Every text holds the word "the"; a third of them are one copied text."""
    rng = random.Random(1)
    words = [f"w{i}" for i in range(40)]
    texts = ["the " + " ".join(rng.choices(words, k=rng.randint(1, 12))) for _ in range(60)]
    texts[::3] = ["the w1 w2 w3"] * len(texts[::3])
    return texts


QUERIES = ("the w1", "w2 w2 w7 missing", "the", "nothing here")


def test_bm25_against_brute_force(spark, corpus):
    found = keyword_search(documents_of(spark, *corpus), query_terms(queries_of(spark, *QUERIES)), {"body": "body"}, 7)
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["id"], r["score"]))
    for i, query in enumerate(QUERIES):
        assert got.get(i, []) == brute_bm25(corpus, query)[:7]


def test_large_query_tables_score_the_same(spark, corpus):
    docs, terms = documents_of(spark, *corpus), query_terms(queries_of(spark, *QUERIES))
    rows = lambda df: sorted((r["query_id"], r["rank"], r["id"], r["score"]) for r in df.collect())
    expected = rows(keyword_search(docs, terms, {"body": "body"}, 10))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(keyword_search(docs, terms, {"body": "body"}, 10)) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_texts_are_read_once_and_not_shuffled(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    made = document_postings(docs, {"body": "text"}, "doc_id", wanted=docs.select(F.lit("x").alias("term")).distinct())
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == 1 and plan.count("text:string") == 1
    moved = [line for line in plan.splitlines() if "Exchange" in line or "Sort " in line]
    assert moved and not any("text#" in line or "toks#" in line for line in moved)


def test_no_shuffle_between_document_and_pair_sums(spark, corpus):
    docs, terms = documents_of(spark, *corpus), query_terms(queries_of(spark, *QUERIES))
    postings = document_postings(docs, {"body": "body"})
    weighted = settled(weighted_query_terms(terms, term_statistics(postings), {"body": 1.0}))
    ranked = top_k(score_pairs(postings, weighted), 3)
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    head = plan[: plan.index("BroadcastHashJoin")]
    assert head.count("Exchange hashpartitioning") == 1  # the one by query, after the first cut
    assert "WindowGroupLimit" in head


def test_pairs_of_a_task_do_not_grow_with_the_documents(spark, corpus, monkeypatch):
    docs, terms = documents_of(spark, *corpus), query_terms(queries_of(spark, *QUERIES))
    rows = lambda df: sorted((r["query_id"], r["id"], r["score"]) for r in df.collect())
    expected = rows(keyword_search(docs, terms, {"body": "body"}, None))
    words = [set(text.lower().split()) for text in corpus]
    matches = sum(w in text for q in QUERIES for w in set(q.split()) for text in words)
    monkeypatch.setattr("rankloom.operators.keyword.MATCHES_PER_TASK", 2)
    found = keyword_search(docs, terms, {"body": "body"}, None)
    assert found.rdd.getNumPartitions() == -(-matches // 2) > 8
    assert rows(found) == expected


@pytest.mark.parametrize("metric", ["cosine", "l2"])
@pytest.mark.parametrize("width", [3, 9, 11, 5000])
def test_best_of_a_block_are_those_of_a_whole_sort(metric, width):
    rng = np.random.default_rng(width)
    # whole numbers give many ties
    asked, points = rng.integers(-3, 4, (40, 6)).astype(float), rng.integers(-3, 4, (width, 6)).astype(float)
    near = vectors.unit_rows(asked) @ vectors.unit_rows(points).T if metric == "cosine" else vectors._nearness(asked, points)
    near[:, 1] = -np.inf
    scores = np.round(near if metric == "cosine" else -np.sqrt(-near), vectors.SCALE)
    order = np.argsort(-scores, axis=1, kind="stable")[:, :10]
    expected = [(i, j, scores[i, j]) for i in range(40) for j in order[i] if scores[i, j] > -np.inf]
    assert [*zip(*vectors._best(near, 10, metric), strict=True)] == expected


def test_queries_are_sent_to_groups_of_cells(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(300, 32)))]
    docs = spark.createDataFrame(rows, "id int, vec array<float>")
    sent = []
    kept = vectors.search_cells
    monkeypatch.setattr(vectors, "search_cells", lambda placed, routed, *more: sent.append(routed.count()) or kept(placed, routed, *more))
    found = knn(docs, docs.withColumnRenamed("id", "query_id"), 4, "cosine", True, cells=20).collect()
    # nothing can be ruled out here: 20 cells, but one group
    assert sent[1] == 300
    unit = vectors.unit_rows(np.array([v for _, v in rows], dtype=np.float32).astype(float))
    scores = np.round(unit @ unit.T, vectors.SCALE)
    np.fill_diagonal(scores, -np.inf)
    best = np.argsort(-scores, axis=1, kind="stable")[:, :4]
    assert sorted((r["query_id"], r["rank"], r["id"]) for r in found) == [
        (i, n + 1, j) for i in range(300) for n, j in enumerate(best[i])
    ]


def test_saved_postings_need_no_shuffle(spark, corpus, tmp_path):
    docs, terms = documents_of(spark, *corpus), query_terms(queries_of(spark, *QUERIES))
    save_postings(document_postings(docs, {"body": "body"}), "saved_postings", str(tmp_path / "p"), 4)
    stored = load_postings(spark, "saved_postings")
    weighted = settled(weighted_query_terms(terms, term_statistics(stored), {"body": 1.0}))
    scored = score_pairs(stored, weighted, placed=True)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[: plan.index("BroadcastHashJoin")]
    direct = keyword_search(docs, terms, {"body": "body"}, 5)
    again = search_postings(stored, terms, 5, {"body": 1.0}, placed=True)
    assert sorted(map(tuple, direct.select("query_id", "id", "score", "rank").collect())) == sorted(
        map(tuple, again.select("query_id", "id", "score", "rank").collect())
    )
    spark.sql("DROP TABLE saved_postings")


def test_weights_and_field_order(spark):
    docs = spark.createDataFrame([(1, "cat", "dog"), (2, "dog", "cat")], "id int, title string, body string")
    found = keyword_search(
        docs, query_terms(queries_of(spark, "cat")), {"title": "title", "body": "body"}, 10, DEFAULT_PROFILE.weights
    )
    assert [r["id"] for r in found.orderBy("rank").collect()] == [1, 2]


def test_freshness(spark):
    as_of = F.lit("2026-01-01").cast("timestamp")
    dates = ["2026-01-01", "2026-06-01", "2025-01-01", "2020-01-01"]
    df = spark.createDataFrame(list(enumerate(dates)), "i int, d string").select(
        "i", F.col("d").cast("timestamp").alias("d")
    )
    got = [r[0] for r in df.orderBy("i").select(freshness_factor("d", as_of)).collect()]
    assert got == [2.0, 2.0, 1.0, 1.0]


def test_rerank_and_fusion(spark):
    ranked = spark.createDataFrame(
        [(1, "a", 9.0, 1.0, 1), (1, "b", 8.0, 5.0, 2), (1, "c", 7.0, 5.0, 3), (1, "d", 6.0, 9.0, 4)],
        "query_id int, id string, score double, coverage double, rank int",
    )
    again = rerank(ranked, F.col("coverage"), 3).orderBy("rank").collect()
    assert [r["id"] for r in again] == ["b", "c", "a", "d"] and again[3]["reranker_score"] is None
    other = spark.createDataFrame([(1, "c", 1), (1, "z", 2)], "query_id int, id string, rank int")
    fused = fuse([ranked, other], 3).orderBy("rank").collect()
    assert [r["id"] for r in fused] == ["c", "a", "b"]
    assert fused[0]["score"] == round(1 / 63 + 1 / 61, 8)


@pytest.mark.parametrize("metric", ["cosine", "l2"])
@pytest.mark.parametrize("cells", [1, 9])
def test_knn_against_brute_force(spark, monkeypatch, metric, cells):
    """Clusters, one vector copied into a third of the rows, and blocks of five."""
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 5)
    rng = np.random.default_rng(3)
    points = np.concatenate([rng.normal(c * 4, 1, (30, 6)) for c in range(4)]).astype(np.float32)
    points[::3] = points[0]
    docs = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(points)], "id int, vec array<float>")
    asked = docs.withColumnRenamed("id", "query_id")
    got = {}
    for r in knn(docs, asked, 4, metric, True, cells).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["id"], r["score"]))
    exact = points.astype(float)
    if metric == "cosine":
        exact = exact / np.linalg.norm(exact, axis=1, keepdims=True)
    for i in range(len(points)):
        scores = exact @ exact[i] if metric == "cosine" else -np.linalg.norm(exact - exact[i], axis=1)
        scores = np.round(scores, 6)
        best = sorted((j for j in range(len(points)) if j != i), key=lambda j: (-scores[j], j))[:4]
        assert [g[0] for g in got[i]] == best
        np.testing.assert_allclose([g[1] for g in got[i]], scores[best], atol=2e-6)


def edits_up_to_one(a, b):
    """0 or 1 when one edit or none turns ``a`` into ``b``, else None."""
    if a == b:
        return 0
    if len(a) == len(b):
        return 1 if sum(x != y for x, y in zip(a, b)) == 1 else None
    short, long = sorted((a, b), key=len)
    return 1 if len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long))) else None


def test_phrases_of_any_length(spark):
    rng = random.Random(4)
    text = [rng.choice("abc") for _ in range(60)]
    known = sorted({" ".join(rng.choice("abc") for _ in range(rng.randint(1, 7))) for _ in range(60)} | {" ".join(text[3:40])})
    phrases = spark.createDataFrame([(k, p) for k, p in enumerate(known)], "rule int, phrase string").withColumn("n", F.lit(0))
    words = spark.createDataFrame([(1, i, w) for i, w in enumerate(text)] + [(2, 0, "d")], "query_id int, pos int, term string")
    got = sorted((r["query_id"], r["pos"], r["n"], r["phrase"]) for r in phrase_hits(words, phrases).collect())
    spans = [(i, n) for i in range(60) for n in range(1, 61 - i)]
    assert got == sorted((1, i, n, " ".join(text[i : i + n])) for i, n in spans if " ".join(text[i : i + n]) in known)
    assert phrase_hits(words, phrases.limit(0)).count() == 0


def test_findings_by_term(spark):
    rows = [("f", 1, "error", "x", None), ("f", 2, "error", "x", "b"), ("f", 3, "error", "x", "a")]
    found = by_term(spark.createDataFrame(rows, "file string, line_no int, severity string, problem string, term string"))
    assert [r["line_no"] for r in found.collect()] == [3, 2, 1]


@pytest.mark.parametrize("long_word", [64, -1])
def test_one_edit_of_words_of_all_lengths(spark, monkeypatch, long_word):
    monkeypatch.setattr(text, "_LONG_WORD", long_word)
    rng = random.Random(3)
    words = {"", "a", "b", "é"}
    for length in range(1, 16):
        for _ in range(12):
            words.add("".join(rng.choice("abé") for _ in range(length)))
    for word in list(words)[:60]:  # neighbours on both sides of the limit of short words
        at = rng.randrange(len(word) + 1)
        words |= {word[:at] + "c" + word[at:], word[:at] + word[at + 1 :], word[:at] + "c" + word[at + 1 :]}
    words = sorted(words)
    table = spark.createDataFrame([(w,) for w in words], "term string")
    got = {(r["term"], r["match"]): r["edits"] for r in one_edit_pairs(table, table).collect()}
    wanted = {(a, b): e for a in words for b in words if (e := edits_up_to_one(a, b)) is not None}
    assert got == wanted


def test_one_edit_of_a_very_long_word(spark):
    long = "".join(random.Random(1).choice("abcdefgh") for _ in range(100_000))
    known = [long, long[:50_000] + "x" + long[50_000:], long[1:], long[:-1] + "z", long[::-1]]
    table = spark.createDataFrame([(w,) for w in known], "term string")
    asked = spark.createDataFrame([(long,)], "term string")
    got = {r["match"]: r["edits"] for r in one_edit_pairs(asked, table).collect()}
    assert got == {known[0]: 0, known[1]: 1, known[2]: 1, known[3]: 1}


def test_one_edit(spark):
    words = ["huis", "huid", "huisje", "uis", "thuis", "hius", "é", ""]
    table = spark.createDataFrame([(w,) for w in words], "term string")
    got = {(r["term"], r["match"]): r["edits"] for r in one_edit_pairs(table, table).collect()}
    assert got[("huis", "huid")] == got[("huis", "uis")] == got[("huis", "thuis")] == 1
    assert ("huis", "hius") not in got and ("huis", "huisje") not in got  # two edits
    assert got[("", "é")] == 1 and got[("huis", "huis")] == 0


def test_fuzzy_query_terms(spark):
    known = spark.createDataFrame([(w,) for w in ("kaart", "kaarten", "nen", "abc1e", "idkaart")], "term string")
    terms = fuzzy_query_terms(queries_of(spark, "kaarte NEN abc1d id-kaart nex"), known).collect()
    found = {r["term"]: r["weight"] for r in terms}
    assert found["kaart"] == 1.0  # as a part of "id-kaart" it is exact
    assert found["kaarten"] == pytest.approx(1 - 1 / 6)
    assert set(found) == {"kaarte", "kaart", "kaarten", "nen", "abc1d", "id", "nex"}


def test_vocabulary_and_compounds(spark):
    docs = documents_of(spark, "parkeer vergunning parkeervergunning", "vergunning vergunning", "parkeerve", "")
    words = vocabulary(docs, {"body": "body"})
    assert {r["term"]: r["df"] for r in words.collect()} == {
        "parkeer": 1, "vergunning": 2, "parkeervergunning": 1, "parkeerve": 1,
    }
    parts = compound_parts(words).collect()
    assert sorted(map(tuple, parts)) == [("parkeervergunning", "parkeer"), ("parkeervergunning", "vergunning")]


def test_compounds_of_any_number_of_parts(spark):
    words = [
        "stad", "huis", "deur", "knop", "stadhuis", "stadhuisdeurknop",  # three words beat four
        "leven", "verzekering", "levensverzekering", "levenssverzekering",  # one linking letter, not two
        "huisdeuren", "deuren", "huisen",  # a word does not end in linking letters
        "aaaa", "aaaaaaaa", "x" * 20_000,
    ]
    known = spark.createDataFrame([(w,) for w in words], "term string")
    found = {}
    for term, part in compound_parts(known, links=("s", "en")).collect():
        found.setdefault(term, set()).add(part)
    assert found == {
        "stadhuis": {"stad", "huis"},
        "stadhuisdeurknop": {"stadhuis", "deur", "knop"},
        "levensverzekering": {"leven", "verzekering"},
        "huisdeuren": {"huis", "deuren"},
        "aaaaaaaa": {"aaaa"},
    }
    plain = compound_parts(known).where("term like 'leven%'")
    assert plain.count() == 0 and compound_parts(known.limit(0)).count() == 0


@pytest.fixture()
def rules(spark, tmp_path):
    lines = [
        "# comment", "", "kaart, id-kaart, idkaart", "reisdocument, pas => paspoort", "Kaart, plan",
        "alleen", " => x", "x =>", "a,b,c,d,e,f,g,h,i", "twee, twee, TWEE", "p => paspoort", "q => r => s",
    ]
    (tmp_path / "nl.txt").write_text("\r\n".join(lines), encoding="utf-8")
    return read_rules(spark, str(tmp_path))


def test_rule_checks(rules):
    found = sorted((r["line_no"], r["severity"], r["problem"], r["term"] or "") for r in rule_violations(rules).collect())
    assert found == [
        (3, "error", "shared trigger", "kaart"),
        (5, "error", "shared trigger", "kaart"),
        (6, "error", "single term", ""),
        (7, "error", "empty side", ""),
        (8, "error", "empty side", ""),
        (9, "warning", "over-broad", ""),
    ]
    stats = rule_statistics(rules).first()
    assert (stats["total_rules"], stats["equivalency_rules"], stats["directional_rules"]) == (10, 5, 5)
    assert (stats["warnings"], stats["errors"]) == (1, 4)
    last = {r["line_no"]: (r["left"], r["right"]) for r in rules.collect()}
    assert last[12] == (["q"], ["r => s"]) and last[4] == (["reisdocument", "pas"], ["paspoort"])


def test_expansion(spark, rules):
    rows = expand_queries(queries_of(spark, "id kaart nodig", "reisdocument kaarten", "plan plan"), rules).collect()
    got = {}
    for r in rows:
        got.setdefault(r["query_id"], {})[r["term"]] = (r["weight"], r["synonym"])
    assert got[0] == {
        "id": (1.0, False), "kaart": (1.0, False), "nodig": (1.0, False), "idkaart": (1.0, True), "plan": (1.0, True),
    }
    assert got[1] == {"paspoort": (1.0, True), "kaarten": (1.0, False)}
    assert got[2] == {"plan": (2.0, False), "kaart": (1.0, True)}


def test_best_bets(spark, tmp_path):
    entries = [
        {"triggers": ["Café Zon", "shared"], "id": "a", "title": "A", "url": "/a", "note": "n"},
        "no object",
        {"triggers": ["shared", "--"], "id": "b", "title": "B", "url": "/b"},
    ]
    path = tmp_path / "bets.json"
    path.write_text(json.dumps({"description": "d", "entries": entries}, indent=1), encoding="utf-8")
    keyed = bet_keys(read_best_bets(spark, str(path)))
    assert {r["key"]: r["id"] for r in keyed.collect()} == {"cafe zon": "a", "cafezon": "a", "shared": "b"}
    matches = match_best_bets(queries_of(spark, "cafe-zon!", "CAFEZON", "shared", "other", ""), keyed)
    assert {r["query_id"]: (r["id"], r["note"]) for r in matches.collect()} == {
        0: ("a", "n"), 1: ("a", "n"), 2: ("b", ""),
    }
    assert read_best_bets(spark, str(tmp_path / "none.json")).count() == 0
    assert parse_best_bets(spark.createDataFrame([("{}",)], "value string")).count() == 0


def test_pin(spark):
    results = spark.createDataFrame(
        [(q, i, i.upper(), f"/{i}", 9.0 - n, None, n + 1) for q in (1, 2, 4) for n, i in enumerate("abc")],
        "query_id int, id string, title string, url string, score double, reranker_score double, rank int",
    )
    matches = spark.createDataFrame(
        [(1, "b", "B!", "/b", "why"), (2, "z", "Z", "/z", ""), (3, "z", "Z", "/z", "")],
        "query_id int, id string, title string, url string, note string",
    )
    rows = {}
    for r in pin(results, matches, 3).orderBy("query_id", "rank").collect():
        rows.setdefault(r["query_id"], []).append((r["rank"], r["id"], r["curated"], r["score"]))
    assert rows[1] == [(1, "b", True, None), (2, "a", False, 9.0), (3, "c", False, 7.0)]
    assert [r[1] for r in rows[2]] == ["z", "a", "b"]
    assert [r[1] for r in rows[3]] == ["z"]
    assert [r[1] for r in rows[4]] == ["a", "b", "c"]


@pytest.fixture(scope="module")
def site(spark):
    rows = [
        (1, "Paspoort aanvragen", "Vraag een paspoort aan bij de balie", "/p", ["reizen"], "2026-01-01"),
        (2, "Parkeervergunning", "Een vergunning om te parkeren", "/v", ["auto"], "2025-01-01"),
        (3, "Paspoort verlengen", "Verleng het paspoort op tijd", "/w", ["reizen", "oud"], "2020-01-01"),
    ]
    return spark.createDataFrame(
        rows, "id int, title string, body string, url string, tags array<string>, lastModified string"
    ).withColumn("lastModified", F.col("lastModified").cast("timestamp"))


def outcome(rows):
    out = {}
    for r in rows.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["id"], r["fallback"], r["curated"]))
    return out


def test_run_queries(spark, site):
    asked = queries_of(spark, "paspoort", "paspoordt", "onvindbaar", "paspoort verlengen")
    found = outcome(run_queries(Index(site), asked, "keyword", 10))
    assert {r[0] for r in found[0]} == {1, 3} and {r[1] for r in found[0]} == {None}
    assert {r[0] for r in found[1]} == {1, 3} and {r[1] for r in found[1]} == {"fuzzy"}
    assert 2 not in found and found[3][0][0] == 3
    bets = bet_keys(
        spark.createDataFrame(
            [(0, 0, "paspoort", 2, "Pinned", "/v", "")],
            "entry_pos int, trigger_pos int, trigger string, id int, title string, url string, note string",
        )
    )
    pinned = outcome(run_queries(Index(site), asked, "semantic", 2, bets))
    assert pinned[0][0] == (2, None, True) and len(pinned[0]) == 2 and not pinned[0][1][2]
    with pytest.raises(ValueError, match="queries run as keyword, semantic or hybrid"):
        run_queries(Index(site), asked, "other")
    with pytest.raises(ValueError, match="hybrid needs"):
        run_queries(Index(site), asked, "hybrid")


def test_tuned_index(spark, site, tmp_path):
    (tmp_path / "r.txt").write_text("vergunning, ontheffing")
    parts = spark.createDataFrame([("parkeervergunning", "vergunning")], "term string, part string")
    tuned = Index(
        site,
        language="nl",
        rules=read_rules(spark, str(tmp_path)),
        parts=parts,
        profile=DEFAULT_PROFILE,
        as_of=F.lit("2026-01-01").cast("timestamp"),
    )
    found = outcome(run_queries(tuned, queries_of(spark, "ontheffing", "paspoorten"), "keyword"))
    assert found[0][0][:2] == (2, None)  # through the synonym
    assert [r[0] for r in found[1]] == [1, 3]  # through the stem; the fresher page first


def test_hybrid(spark, site):
    vecs = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.7, 0.7])], "id int, vec array<float>")
    asked = queries_of(spark, "onvindbaar")
    index = Index(site, vectors=vecs)
    rows = run_queries(
        index, asked, "hybrid", 2, query_vectors=spark.createDataFrame([(0, [0.1, 1.0])], "query_id int, vec array<float>")
    )
    assert outcome(rows) == {0: [(2, None, False), (3, None, False)]}


def test_autocomplete(spark, site):
    typed = spark.createDataFrame(
        [(1, "pas"), (2, "Paspoort ve"), (3, "pasport"), (4, "zzz"), (5, "een paspoort a"), (6, "!")],
        "prefix_id int, prefix string",
    )
    rows = autocomplete(site, ["title", F.concat_ws(" ", "tags")], typed, 5).orderBy("prefix_id", "rank").collect()
    got = {}
    for r in rows:
        got.setdefault(r["prefix_id"], []).append((r["text"], r["query_plus_text"]))
    assert got == {
        1: [("paspoort", "paspoort")],
        2: [("paspoort verlengen", "paspoort verlengen")],
        3: [("paspoort", "paspoort")],
        5: [("paspoort aanvragen", "een paspoort aanvragen")],
    }
    assert 3 not in {r["prefix_id"] for r in autocomplete(site, ["title"], typed, 5, fuzzy=False).collect()}


def test_did_you_mean(spark, site):
    typed = spark.createDataFrame([(1, "pasprt"), (2, "paspoort verl"), (3, "parkeer"), (4, "pasport")], "prefix_id int, prefix string")
    found = suggestion_rows(did_you_mean(site, ["title"], typed, 2), site).orderBy("prefix_id", "rank").collect()
    assert [(r["prefix_id"], r["id"]) for r in found] == [(2, 3), (2, 1), (3, 2), (4, 1), (4, 3)]
    assert found[0]["text"] == "Paspoort verlengen" and found[0]["url"] == "/w"


def test_words_of_documents_meet_prefixes_in_place(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"paspoort verlengen {i}") for i in range(30)], "id int, title string")
    typed = spark.createDataFrame([(1, "paspoort verl"), (2, "verlengen pas")], "prefix_id int, prefix string")
    rows = lambda df: sorted((r["prefix_id"], r["rank"], r["id"], r["matched"]) for r in df.collect())
    expected = [(p, i + 1, i, 2) for p in (1, 2) for i in range(3)]
    monkeypatch.setattr("rankloom.operators.suggest.MATCHES_PER_TASK", 4)
    found = did_you_mean(docs, ["title"], typed, 3)
    assert rows(found) == expected
    plan = found._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan ==")[0]
    # two words of 30 documents for either prefix
    assert ", 30), REPARTITION_BY_NUM" in plan and plan.count("Exchange hashpartitioning") == 2


def test_facets_filters_order(spark, site):
    assert {r["value"]: r["count"] for r in facet_counts(site, "tags").collect()} == {"reizen": 2, "auto": 1, "oud": 1}
    assert [r["id"] for r in newest_first(filter_documents(site, {"tags": "reizen"})).collect()] == [1, 3]
    with pytest.raises(ValueError, match="not filterable"):
        filter_documents(site, {"title": "x"})


def test_profiles(spark, tmp_path):
    path = tmp_path / "p.json"
    weights = {"title": 3, "body": 1.5}
    path.write_text(
        json.dumps(
            {
                "profiles": [{"name": "n", "freshness": {"field": "lastModified"}}, {"name": "w", "text_weights": weights, "description": "x"}],
                "default_profile": "n",
            }
        )
    )
    assert load_profile(spark, str(path)).freshness == Freshness("lastModified", 2.0, 365, "quadratic")
    assert load_profile(spark, str(path), "w").weights == {"title": 3.0, "body": 1.5}
    assert load_profile(spark, str(path), "w").freshness is None
    with pytest.raises(ValueError, match="no profiles"):
        load_profile(spark, str(path), "x")
    with pytest.raises(AnalysisException):
        load_profile(spark, str(tmp_path / "none"))
