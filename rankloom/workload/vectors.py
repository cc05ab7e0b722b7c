"""Nearest neighbours and fused rankings."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankloom.operators.keyword import keyword_search, query_terms
from rankloom.operators.lsh import BITS, FLIPS, PRECISION, TABLES, hyperplanes, knn_lsh as search_buckets
from rankloom.operators.rerank import fuse
from rankloom.operators.vectors import attach_vectors, knn
from rankloom.workload.tables import (
    PASSAGE_TERMS_SQL,
    bm25_sql,
    passages,
    ranked_sql,
    table,
)


def _vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vec")
    )


def _neighbours(spark, sf_dir, metric, k=10):
    vectors = _vectors(spark, sf_dir)
    return knn(vectors, vectors.withColumnRenamed("id", "query_id"), k, metric, exclude_same_id=True)


def _ranked(df):
    return df.select("query_id", "id", "score", F.col("rank").cast("long").alias("rank"))


def knn_cosine(spark, sf_dir):
    """The ten most similar vectors of every vector, itself left out."""
    return _ranked(_neighbours(spark, sf_dir, "cosine"))


def knn_l2(spark, sf_dir):
    """The ten closest vectors of every vector."""
    return _ranked(_neighbours(spark, sf_dir, "l2"))


def _pairs_sql(name: str, score: str) -> str:
    return f"""
{name} AS (
    SELECT a.vec_id AS query_id, b.vec_id AS id, round({score}, 6) AS score
    FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id
)"""


COSINE_SQL = _pairs_sql("cosine", "list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[])")
L2_SQL = _pairs_sql("l2", "-list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[])")
KNN_COSINE_SQL = f"WITH {COSINE_SQL} SELECT query_id, id, score, rank FROM {ranked_sql('cosine', 10)}"
KNN_L2_SQL = f"WITH {L2_SQL} SELECT query_id, id, score, rank FROM {ranked_sql('l2', 10)}"


def knn_lsh(spark, sf_dir):
    """About the ten most similar vectors of every vector, from the buckets it looks into."""
    vectors = _vectors(spark, sf_dir)
    return _ranked(search_buckets(vectors, vectors.withColumnRenamed("id", "query_id"), 10, exclude_same_id=True))


WIDTH = 64  # of the given embeddings
_NORMALS_SQL = ", ".join(
    f"({k // BITS}, {k % BITS}, {[int(x) for x in row]}::DOUBLE[])"
    for k, row in enumerate(hyperplanes(TABLES, BITS, WIDTH))
)
KNN_LSH_SQL = f"""
WITH planes(t, b, normal) AS (VALUES {_NORMALS_SQL}),
sides AS (
    SELECT vec_id, t, b,
           list_dot_product(list_transform(embedding, lambda x: floor(x::DOUBLE * {PRECISION})), normal) AS side
    FROM embeddings CROSS JOIN planes
),
near AS (SELECT *, row_number() OVER (PARTITION BY vec_id, t ORDER BY abs(side), b) AS closeness FROM sides),
codes AS (
    SELECT vec_id, t, sum(CASE WHEN side >= 0 THEN 1 << b ELSE 0 END)::BIGINT AS code,
           {", ".join(f"max(CASE WHEN closeness = {k + 1} THEN 1 << b END) AS m{k}" for k in range(FLIPS))}
    FROM near GROUP BY vec_id, t
),
probes AS (
    SELECT vec_id, t, unnest([{", ".join(
        "xor(".join([""] * (bin(c).count("1") + 1)) + "code" + "".join(f", m{k})" for k in range(FLIPS) if c >> k & 1)
        for c in range(1 << FLIPS)
    )}]) AS code
    FROM codes
),
pairs AS (SELECT DISTINCT p.vec_id AS a, c.vec_id AS b FROM probes p JOIN codes c USING (t, code) WHERE p.vec_id <> c.vec_id),
close_by AS (
    SELECT x.vec_id AS query_id, y.vec_id AS id,
           round(list_cosine_similarity(x.embedding::DOUBLE[], y.embedding::DOUBLE[]), 6) AS score
    FROM pairs JOIN embeddings x ON x.vec_id = a JOIN embeddings y ON y.vec_id = b
)
SELECT query_id, id, score, rank FROM {ranked_sql('close_by', 10)}
"""


def rrf_fusion(spark, sf_dir):
    """Both neighbour lists fused by their ranks."""
    return _ranked(
        fuse([_neighbours(spark, sf_dir, "cosine"), _neighbours(spark, sf_dir, "l2")], 10)
    )


RRF_SQL = f"""
WITH {COSINE_SQL}, {L2_SQL},
fused AS (
    SELECT query_id, id, round(sum(1.0::DOUBLE / (60 + rank)), 8) AS score
    FROM (SELECT query_id, id, rank FROM {ranked_sql('cosine', 10)}
          UNION ALL SELECT query_id, id, rank FROM {ranked_sql('l2', 10)})
    GROUP BY query_id, id
)
SELECT query_id, id, score, rank FROM {ranked_sql('fused', 10)}
"""


def hybrid_topk(spark, sf_dir):
    """Documents found by words and by vector, fused.

    Document and passage vectors are those of the same number.
    """
    queries = passages(spark, sf_dir)
    docs = attach_vectors(
        table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text"),
        _vectors(spark, sf_dir),
        "vec",
    )
    asked = attach_vectors(
        queries.select(F.col("query_id").alias("id")), _vectors(spark, sf_dir), "vec"
    ).withColumnRenamed("id", "query_id")
    by_words = keyword_search(docs, query_terms(queries), {"body": "text"}, 50)
    by_vector = knn(docs.select("id", "vec"), asked, 10)
    return _ranked(fuse([by_words, by_vector], 10))


HYBRID_SQL = f"""
WITH {bm25_sql("documents", "doc_id", {"body": ("text", 1.0)}, PASSAGE_TERMS_SQL)},
close_by AS (
    SELECT a.vec_id AS query_id, b.vec_id AS id,
           round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS score
    FROM embeddings a JOIN embeddings b ON true
    WHERE a.vec_id IN (SELECT item_id FROM benchmark) AND b.vec_id IN (SELECT doc_id FROM documents)
),
fused AS (
    SELECT query_id, id, round(sum(1.0::DOUBLE / (60 + rank)), 8) AS score
    FROM (SELECT query_id, id, rank FROM {ranked_sql('scored', 50)}
          UNION ALL SELECT query_id, id, rank FROM {ranked_sql('close_by', 10)})
    GROUP BY query_id, id
)
SELECT query_id, id, score, rank FROM {ranked_sql('fused', 10)}
"""

QUERIES = {
    "knn_cosine": knn_cosine,
    "knn_l2": knn_l2,
    "knn_lsh": knn_lsh,
    "rrf_fusion": rrf_fusion,
    "hybrid_topk": hybrid_topk,
}
ORACLE = {
    "knn_cosine": KNN_COSINE_SQL,
    "knn_l2": KNN_L2_SQL,
    "knn_lsh": KNN_LSH_SQL,
    "rrf_fusion": RRF_SQL,
    "hybrid_topk": HYBRID_SQL,
}
