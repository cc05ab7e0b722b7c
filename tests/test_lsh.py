"""Approximate neighbours: recall, and the same rows as comparing everything where buckets allow it."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankloom.operators import lsh
from rankloom.operators.vectors import knn

SF_DIR = "/root/testdata/sf0.001"


def pairs(df):
    return {(r["query_id"], r["id"]) for r in df.collect()}


@pytest.fixture(scope="module")
def vectors(spark):
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    return table.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))


def test_recall_on_vectors_without_clusters(vectors):
    asked = vectors.withColumnRenamed("id", "query_id")
    exact = pairs(knn(vectors, asked, 10, exclude_same_id=True))
    found = pairs(lsh.knn_lsh(vectors, asked, 10, exclude_same_id=True))
    assert len(exact & found) >= 0.9 * len(exact)


def test_clusters_need_few_comparisons(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 32))
    points = centres[np.arange(800) % 40] + rng.normal(size=(800, 32)) * 0.1
    docs = spark.createDataFrame([(k, p.tolist()) for k, p in enumerate(points)], "id long, vec array<double>")
    asked = docs.withColumnRenamed("id", "query_id").where("query_id < 100")
    exact = pairs(knn(docs, asked, 10))
    found = pairs(lsh.knn_lsh(docs, asked, 10, tables=4, bits=10, flips=1))
    assert len(exact & found) >= 0.95 * len(exact)


def test_looking_into_every_bucket_is_exact(vectors):
    asked = vectors.withColumnRenamed("id", "query_id").where("query_id % 20 = 0")
    every = lsh.knn_lsh(vectors, asked, 5, tables=1, bits=3, flips=3)
    assert sorted(map(tuple, every.collect())) == sorted(map(tuple, knn(vectors, asked, 5).collect()))


def test_a_vector_that_many_rows_share_spreads_over_blocks(spark, monkeypatch):
    from rankloom.operators import vectors as exact

    monkeypatch.setattr(exact, "BLOCK_ROWS", 16)
    docs = spark.createDataFrame([(k, [1.0, 0.5, -0.25]) for k in range(100)], "id long, vec array<float>")
    asked = docs.withColumnRenamed("id", "query_id").where("query_id < 40")
    rows = lsh.knn_lsh(docs, asked, 3, exclude_same_id=True).collect()
    assert len(rows) == 120 and {r["id"] for r in rows} == {0, 1, 2, 3}


def test_empty_and_missing_vectors(spark):
    kind = "id string, vec array<float>"
    docs = spark.createDataFrame([("a", [0.0, 0.0]), ("b", None), ("c", []), ("d", [1.0, 0.0])], kind)
    asked = spark.createDataFrame([(1, [1.0, 0.1]), (2, None)], "query_id int, vec array<float>")
    rows = lsh.knn_lsh(docs, asked, 5, tables=2, bits=2, flips=2).collect()
    assert [(r["query_id"], r["id"]) for r in rows] == [(1, "d"), (1, "a")]
    assert lsh.knn_lsh(docs.limit(0), asked, 5).count() == 0
    assert lsh.knn_lsh(docs, asked.limit(0), 5).count() == 0
