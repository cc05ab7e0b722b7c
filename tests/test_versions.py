"""Bucketed versions, the statistics kept beside them and the counts of a growing log."""

import json

import pytest
from pyspark.sql import functions as F

from rankloom.operators.postings import document_postings, held_terms, term_statistics
from rankloom.plans.collection import collection_statistics, upsert_documents
from rankloom.sources.versions import BUCKET, BucketedTable
from rankloom.streaming.log_counts import update_counts

ROWS = "id string, v string, file string, pos int"


def rows_of(spark, *rows):
    return spark.createDataFrame([(i, v, "f", n) for n, (i, v) in enumerate(rows)], ROWS)


def held(df):
    return sorted(map(tuple, df.collect()))


def files(folder):
    return {p: p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def test_only_touched_buckets_are_written(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), 8)
    assert table.latest() == 0
    with pytest.raises(ValueError, match="no version"):
        table.read()
    first = [(f"k{i}", str(i)) for i in range(60)]
    table.upsert(rows_of(spark, *first))
    before, places = files(tmp_path / "t"), table.paths()
    touched = table.upsert(rows_of(spark, ("k7", "old"), ("k7", "new"), ("k7", "new")))
    assert len(touched) == 1 and table.latest() == 2
    now = table.paths()
    assert {b for b in now if now[b] != places.get(b)} == touched
    after = files(tmp_path / "t")
    assert all(after[p] == before[p] for p in before)
    # No more was written than the bucket of the key.
    bucket = [r[0] for r in table.read(only=touched).select("id").collect()]
    assert "k7" in bucket and len(bucket) < 30 and len(set(after) - set(before)) == 1
    assert held(table.read()) == sorted({**dict(first), "k7": "new"}.items())
    assert held(table.read(1)) == sorted(first)


def test_empty_rows_other_columns_and_failed_attempts(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), 4)
    none = rows_of(spark, ("a", "b")).limit(0)
    assert table.upsert(none) == set() and table.latest() == 1 and table.read().columns == ["id", "v"]
    assert table.upsert(none) == set() and table.latest() == 1 and table.read().count() == 0
    table.upsert(rows_of(spark, ("a", None), ("", "x" * 50_000)))
    assert held(table.read()) == [("", "x" * 50_000), ("a", None)]
    broken = rows_of(spark, ("a", "z")).withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception):
        table.replace(broken.drop("file", "pos").withColumn(BUCKET, F.lit(0)), {0})
    assert table.latest() == 2 and held(table.read())[1] == ("a", None)
    with pytest.raises(ValueError, match="columns are"):
        table.replace(spark.range(1).withColumn(BUCKET, F.lit(0)), {0})
    # The number of buckets stays that of the first version.
    assert BucketedTable(spark, str(tmp_path / "t"), 99).buckets == 4


def test_statistics_follow_the_documents_without_reading_the_others(spark, tmp_path):
    docs, stats = (BucketedTable(spark, str(tmp_path / n), 8) for n in ("docs", "stats"))
    fields = {"v": "v"}
    upsert_documents(docs, stats, rows_of(spark, *[(f"d{i}", f"word w{i % 3} {i}") for i in range(40)]), fields)
    kept = docs.paths()
    change = rows_of(spark, ("d5", "other words"), ("d99", None))
    touched = {r[0] for r in change.select(docs.bucket_of("id")).collect()}
    # What is not touched cannot be opened any more.
    for bucket in set(kept) - touched:
        for file in (tmp_path / "docs" / "data").rglob(f"{BUCKET}={bucket}/*.parquet"):
            file.rename(file.with_suffix(".away"))
    upsert_documents(docs, stats, change, fields)
    for file in (tmp_path / "docs" / "data").rglob("*.away"):
        file.rename(file.with_suffix(".parquet"))
    fresh = term_statistics(document_postings(docs.read(), fields)).select("field", "term", "df", "total_len")
    assert held(collection_statistics(stats)) == held(fresh)
    with pytest.raises(ValueError, match="same number"):
        upsert_documents(docs, BucketedTable(spark, str(tmp_path / "s2"), 3), change, fields)


def test_terms_are_counted_without_moving_postings(spark):
    docs = spark.createDataFrame([(1, "a b a", "b"), (2, "b", None), (3, None, "c c")], "id int, v string, w string")
    for fields in ({"v": "v"}, {"v": "v", "w": "w"}):
        terms = held_terms(docs, fields)
        assert "Exchange" not in terms._jdf.queryExecution().executedPlan().toString()
        assert held(term_statistics(terms)) == held(term_statistics(document_postings(docs, fields)))


def test_log_counts_grow_and_survive_a_second_run(spark, tmp_path):
    counts = BucketedTable(spark, str(tmp_path / "counts"), 4)
    lines = lambda *rows: spark.createDataFrame(
        [(n, json.dumps({"query": q, "num_results": r}) if q else "{cut") for n, q, r in rows], "pos long, value string"
    )

    def run(checkpoint="checkpoint"):
        stream = spark.readStream.schema("pos long, value string").parquet(str(tmp_path / "lines"))
        update_counts(stream, counts, str(tmp_path / checkpoint))
        return held(counts.read().select("query", "count", "first_pos"))

    for rows in ([(3, "a", 0), (4, "b", 2), (5, None, 0)], [(1, "a", 0), (6, " ", 0), (7, "c", 0)]):
        lines(*rows).write.mode("append").parquet(str(tmp_path / "lines"))
        found = run()
    assert found == [("a", 2, 1), ("c", 1, 7)]
    version = counts.latest()
    assert run() == found and counts.latest() == version  # nothing new
    assert run("started over") == found  # counted again from the start, not twice
