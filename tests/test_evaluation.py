"""Judgments, metrics, reports and the query log, edge by edge."""

import json
import math

import pytest
from pyspark.sql import functions as F

from rankloom.operators.log_mining import (
    log_totals,
    low_result_queries,
    most_common,
    zero_result_queries,
)
from rankloom.operators.metrics import config_metrics, lift, query_metrics
from rankloom.plans import evaluation
from rankloom.plans.evaluation import comparisons, evaluate
from rankloom.plans.search import Index, query_outcomes, run_queries
from rankloom.sources.judgments import clean_judgments, read_judgments
from rankloom.sources.query_log import append_log, log_rows, read_log, split_malformed
from rankloom.sources.sinks import write_reports

RESULTS = "config string, query string, id string, url string, rank int"
JUDGED = "query string, intended_id string, relevance int"


def test_read_judgments(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text(
        "﻿query,intended_id,intended_url,relevance\n"
        " a ,d1,,\n"
        "a,d1,,1\n"
        '"b, c",,/u,2\n'
        ",d2,,3\n"
        "e,,,3\n",
        encoding="utf-8",
    )
    assert sorted(map(tuple, read_judgments(spark, str(path)).collect())) == [
        ("a", "d1", 1), ("a", "d1", 3), ("b, c", "/u", 2),
    ]
    (tmp_path / "empty.csv").write_text("query,intended_id\n,x\n")
    with pytest.raises(ValueError, match="no usable judgments"):
        read_judgments(spark, str(tmp_path / "empty.csv"))


@pytest.mark.parametrize("grade", ["4", "-1", "x", "1.5"])
def test_bad_grade(spark, grade):
    rows = spark.createDataFrame([("q", "d", grade)], "query string, intended_id string, relevance string")
    with pytest.raises(Exception, match="relevance must be 0 to 3"):
        clean_judgments(rows).collect()


def metrics_of(spark, results, judged, configs=("c",)):
    rows = query_metrics(
        spark.createDataFrame(results, RESULTS), spark.createDataFrame(judged, JUDGED), configs
    ).collect()
    return {(r["config"], r["query"]): r for r in rows}


def test_query_metrics(spark):
    judged = [
        ("best", "a", 3), ("best", "a", 1), ("best", "b", 2), ("best", "c", 0),
        ("zero", "a", 0), ("none", "a", 3), ("url", "/u", 2), ("late", "z", 3),
        ("byid", "x", 0), ("byid", "/x", 3), ("twice", "a", 1),
    ]
    results = [
        ("c", "best", "a", "/a", 1), ("c", "best", "b", "/b", 2), ("c", "best", "c", "/c", 3),
        ("c", "zero", "a", "/a", 1),
        ("c", "url", "q", "/q", 1), ("c", "url", "w", "/u", 2),
        *[("c", "late", f"n{i}", f"/n{i}", i) for i in range(1, 11)], ("c", "late", "z", "/z", 11),
        ("c", "byid", "x", "/x", 1),
        ("c", "twice", "a", "/a", 1), ("c", "twice", "a", "/a", 2),
        ("c", "unjudged", "a", "/a", 1),
    ]
    got = metrics_of(spark, results, judged)
    assert {k[1]: (r["rank"], r["num_results"]) for k, r in got.items()} == {
        "best": (1, 3), "zero": (None, 1), "none": (None, 0), "url": (2, 2),
        "late": (11, 11), "byid": (None, 1), "twice": (1, 2),
    }
    ndcg = {k[1]: r["ndcg_at_10"] for k, r in got.items()}
    assert ndcg["best"] == 1.0 and ndcg["zero"] == ndcg["none"] == ndcg["late"] == ndcg["byid"] == 0.0
    assert ndcg["url"] == round(1 / math.log2(3), 6)
    assert ndcg["twice"] > 1  # duplicates are not clamped
    assert got[("c", "best")]["intended_id"] == "a" and got[("c", "byid")]["intended_id"] == "/x"


def test_config_metrics_and_lift(spark, tmp_path):
    judged = [("q1", "a", 3), ("q2", "b", 3)]
    results = [("base", "q1", "a", "/a", 2), ("base", "q1", "x", "/x", 1), ("tuned", "q1", "a", "/a", 1), ("tuned", "q2", "b", "/b", 1), ("same", "q1", "a", "/a", 1), ("same", "q2", "b", "/b", 1)]
    configs = ["base", "tuned", "same"]
    per_query = query_metrics(spark.createDataFrame(results, RESULTS), spark.createDataFrame(judged, JUDGED), configs)
    metrics = config_metrics(per_query)
    base = metrics.where("config = 'base'").first()
    assert (base["num_queries"], base["success_at_1"], base["success_at_3"]) == (2, 0.0, 0.5)
    assert (base["mrr_at_10"], base["found_rate"], base["zero_result_rate"]) == (0.25, 0.5, 0.5)
    assert tuple(lift(metrics, configs, "base").first()) == ("base", "tuned", 0.0, 1.0, "+100.0")
    assert lift(metrics, configs, "tuned").count() == 0
    assert lift(metrics, configs, "absent").count() == 0
    write_reports(metrics, per_query, str(tmp_path))
    summary = spark.read.csv(str(tmp_path / "relevance-summary"), header=True)
    assert summary.columns[0] == "config" and summary.columns[-1] == "num_queries"
    assert summary.where("config = 'base'").first()["mrr_at_10"] == "0.2500"
    detail = spark.read.csv(str(tmp_path / "relevance-per-query"), header=True)
    assert detail.where("config = 'base' and query = 'q2'").first()["rank"] is None


def test_evaluate_end_to_end(spark):
    docs = spark.createDataFrame(
        [("d1", "Paspoort", "aanvragen", "/1", []), ("d2", "Fiets", "gestolen", "/2", [])],
        "id string, title string, body string, url string, tags array<string>",
    )
    judged = spark.createDataFrame([("paspoort", "d1", 3), ("fietss", "/2", 2), ("rijwiel", "d2", 1)], JUDGED)
    indexes = {"baseline": Index(docs), "tuned": Index(docs, language="nl")}
    configs = comparisons(indexes)
    assert [c.name for c in configs] == ["baseline-keyword", "tuned-keyword", "tuned-semantic"]
    assert [c.name for c in comparisons({"tuned": Index(docs, language="nl", vectors=docs)})][-1] == "tuned-hybrid"
    metrics, per_query = evaluate(indexes, judged, configs)
    assert metrics.count() == 3 and per_query.count() == 9
    base = metrics.where("config = 'baseline-keyword'").first()
    assert (base["success_at_1"], base["zero_result_rate"]) == (round(2 / 3, 6), round(1 / 3, 6))


def test_evaluate_searches_with_numbers_and_reads_grades_once(spark, monkeypatch):
    docs = spark.createDataFrame([("d1", "Paspoort", "aanvragen", "/1", [])], "id string, title string, body string, url string, tags array<string>")
    counted = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(query):
        counted.add(1)
        return query

    judged = spark.createDataFrame([("paspoort", "/1", 2), ("paspoort", "x", 3), (None, "d1", 3)], JUDGED)
    kinds = []
    monkeypatch.setattr(evaluation, "run_queries", lambda index, queries, *a, **k: kinds.append(dict(queries.dtypes)["query_id"]) or run_queries(index, queries, *a, **k))
    indexes = {"baseline": Index(docs)}
    _, per_query = evaluate(indexes, judged, comparisons(indexes))
    assert kinds == ["bigint"]
    got = {r["query"]: (r["intended_id"], r["rank"], r["num_results"], r["ndcg_at_10"]) for r in per_query.collect()}
    assert got == {"paspoort": ("x", 1, 1, round(3 / (7 + 3 / math.log2(3)), 6)), None: ("d1", None, 0, 0.0)}
    results = spark.createDataFrame([("c", "paspoort", "d1", "/1", 1)], RESULTS)
    query_metrics(results, judged.withColumn("query", seen("query")), ["c"]).collect()
    assert counted.value == 3


def test_log_round_trip(spark, tmp_path):
    queries = spark.createDataFrame([(1, "a"), (2, "b")], "query_id int, query string")
    results = spark.createDataFrame([(1, f"d{i}", i) for i in range(1, 8)], "query_id int, id string, rank int")
    base = results.select("query_id")
    outcomes = query_outcomes(queries, base, "keyword", results.where("rank = 1").select("query_id", "id"))
    assert {r["query_id"]: (r["curated"], r["fallback"]) for r in outcomes.collect()} == {1: (True, None), 2: (False, "fuzzy")}
    rows = log_rows(outcomes, results, "idx", "keyword", F.lit("2026-01-01 00:00:00").cast("timestamp"))
    for _ in range(2):
        append_log(rows, str(tmp_path / "log"))
    good, bad = split_malformed(read_log(spark, str(tmp_path / "log")))
    assert good.count() == 4 and bad.count() == 0
    first = good.where("query = 'a'").first()
    assert first["top_ids"] == ["d1", "d2", "d3", "d4", "d5"] and first["num_results"] == 7 and first["curated"]
    assert first["timestamp"].startswith("2026-01-01T00:00:00")


def test_log_mining(spark, tmp_path):
    lines = [
        json.dumps({"query": " late ", "num_results": 0}),
        "",
        "{broken",
        json.dumps({"query": "early", "num_results": 0}),
        json.dumps({"query": "early"}),
        json.dumps({"query": "late", "num_results": 0}),
        json.dumps({"query": " ", "num_results": 0}),
        json.dumps({"query": "one", "num_results": 1}),
        json.dumps({"query": "two", "num_results": 2}),
        json.dumps({"query": "three", "num_results": 3}),
        json.dumps({"query": "solo", "num_results": 0}),
    ]
    (tmp_path / "log.jsonl").write_text("\n".join(lines) + "\n")
    good, bad = split_malformed(read_log(spark, str(tmp_path / "log.jsonl")))
    assert [r["line"] for r in bad.collect()] == ["{broken"]
    top = most_common(zero_result_queries(good), 2).collect()
    assert [(r["query"], r["count"]) for r in top] == [("late", 2), ("early", 2)]
    assert {r["query"] for r in low_result_queries(good).collect()} == {"one", "two"}
    assert tuple(log_totals(good).first()) == (9, 3, 2)
