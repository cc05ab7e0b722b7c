"""Every training-data query against its SQL, or against brute force where SQL can't express it."""

import numpy as np
import pytest

from compare import connection, difference, spark_rows, sql_rows
from rankloom import llm

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_matches_sql(spark, con, name):
    ours = spark_rows(llm.queries()[name], spark, SF_DIR)
    assert difference(ours, sql_rows(con, llm.oracle_sql()[name])) is None


def test_mixture_meets_targets(spark):
    rows = llm.queries()["op2_soft_mixing"](spark, SF_DIR).toPandas()
    assert (rows["rate"] >= 0).all() and rows["doc_id"].is_unique
    chances = rows[["p_good", "p_poor", "p_toxic"]].to_numpy()
    assert np.allclose(chances.sum(axis=1), 1)
    tokens = rows["n_tokens"].to_numpy()
    expected = (tokens * rows["rate"].to_numpy()) @ chances
    assert np.allclose(expected / tokens.sum(), [0.85, 0.10, 0.05], atol=2e-3)


def test_url_rules(spark):
    rows = llm.queries()["op4_url_models"](spark, SF_DIR).toPandas()
    urls = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    rules = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}
    for row in rows.itertuples():
        rest = urls[row.page_id].split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
        host, path = rest[:cut].lower(), rest[cut:].split("?")[0].split("#")[0]
        fits = [
            r for r in rules
            if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])
        ]
        rule = max(fits, key=len, default=None)
        assert (row.host, row.path, row.rule) == (host, path, rule)
        assert row.verdict == rules[rule] if rule else row.verdict in ("allow", "block")


def test_base_secrets(spark):
    import hashlib
    import re

    kinds = (
        ("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
        ("access", r"AKIA[A-Z0-9]+", 0, 16),
        ("hex", r"[0-9a-f]+", 0, 32),
    )
    rows = {r["doc_id"]: r for r in llm.queries()["op10_secret_models"](spark, SF_DIR).collect()}
    for doc in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect():
        spans = sorted(
            (m.start(), k, name, m.end())
            for k, (name, pattern, group, least) in enumerate(kinds)
            for m in re.finditer(pattern, doc["text"], re.ASCII)
            if len(m.group(group)) >= least
        )
        listed = ",".join(f"{name}:{start}:{end}" for start, _, name, end in spans)
        assert rows[doc["doc_id"]]["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()


def test_shards_are_even_runs_of_the_curve(spark):
    rows = llm.queries()["op5_hilbert_shards"](spark, SF_DIR).toPandas().sort_values(["shard", "slot"])
    counts = rows.groupby("shard").size()
    assert len(counts) == 40 and counts.max() - counts.min() <= 1
    assert (rows.groupby("shard")["slot"].apply(list).map(lambda s: s == list(range(len(s))))).all()
    assert rows["curve"].is_monotonic_increasing


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        before, kept = kept, stage(spark, kept, SF_DIR)
        assert kept.columns == docs.columns
        assert kept.count() <= before.count()
    mixed = corpus_pipeline.STAGES[3][1](spark, kept, SF_DIR)
    assert mixed.columns == docs.columns
    assert mixed.join(kept, "doc_id", "left_anti").count() == 0
    assert corpus_pipeline.run(spark, SF_DIR).count() == mixed.count()
