"""Pipeline stages: their own columns, odd rows, empty tables, and brute-force versions of what they keep."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rankloom.llm import containment, mixing, parity, sharding

SF_DIR = "/root/testdata/sf0.001"
CLASHES = ("_copy", "_id", "_hash", "_copies", "_kept", "_found_id", "_found_hash", "row", "id", "text_hash", "found_id", "kept", "copy", "copies")


@pytest.fixture(scope="module")
def docs(spark):
    some = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("doc_id < 60")
    for k, name in enumerate(CLASHES):
        some = some.withColumn(name, F.concat(F.lit(f"{k}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    odd = some.where("doc_id in (1, 2, 3)")
    odd = odd.withColumn("text", F.when(F.col("doc_id") == 1, F.lit(None)).when(F.col("doc_id") == 2, "").otherwise(F.col("text")))
    nulls = odd.withColumn("doc_id", F.lit(None).cast("long"))
    again = some.where("doc_id = 7")
    # kept as a table, as stages get it
    path = f"{spark.sparkContext.getCheckpointDir()}/odd-docs"
    some.where("doc_id not in (1, 2, 3)").unionByName(odd).unionByName(nulls).unionByName(again).write.parquet(path)
    return spark.read.parquet(path)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def rows_of(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:4])
def test_stages_keep_whole_rows(spark, docs, name, stage):
    kept = stage(spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    assert set(rows_of(kept)) <= set(rows_of(docs)) and kept.count() > 0


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_of_nothing(spark, docs, name, stage):
    assert stage(spark, docs.limit(0), SF_DIR).count() == 0


def test_near_duplicates_against_brute_force(spark, docs):
    rows = docs.select("doc_id", "text").collect()
    sets = {}
    for r in rows:
        sets.setdefault(-1 if r["doc_id"] is None else r["doc_id"], []).append(shingles(r["text"]))
    group = {i: i for i in sets}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and any(x and y and 100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b]):
                low, high = sorted((root(a), root(b)))
                group[high] = low
    wanted = sorted(repr(r) for r in docs.collect() if root(-1 if r["doc_id"] is None else r["doc_id"]) == (-1 if r["doc_id"] is None else r["doc_id"]))
    assert rows_of(parity.one_per_component(docs)) == wanted


def test_decontamination_against_brute_force(spark, docs):
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    items = [s for r in benchmark.collect() if (s := shingles(r["text"]))]
    clean = lambda t: not any(100 * len(i & shingles(t)) >= 80 * len(i) for i in items)
    assert rows_of(containment.decontaminated(docs, benchmark)) == sorted(repr(r) for r in docs.collect() if clean(r["text"]))
    assert rows_of(containment.decontaminated(docs, benchmark.limit(0))) == rows_of(docs)


def test_mixed_documents_repeat_rows_as_their_copies_say(spark, docs):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    drawn = {(r["doc_id"], r["text_hash"]): r["copies"] for r in mixing.mixture(docs, labels).collect()}
    hashed = docs.withColumn("hash_of_text", F.xxhash64(F.coalesce("text", F.lit(""))))
    wanted = []
    for r in hashed.collect():
        times = drawn[r["doc_id"], r["hash_of_text"]]
        own = docs.columns
        wanted += [repr([r[c] for c in own])] * times
    assert sorted(repr(list(r)) for r in mixing.mixed_documents(docs, labels).collect()) == sorted(wanted)


def test_written_shards(spark, docs, tmp_path):
    unique = docs.where("doc_id is not null").dropDuplicates(["doc_id"]).withColumn("slot", F.lit("mine"))
    placed = sharding.hilbert_shards(unique, shards=4)
    sharding.write_shards(unique, placed, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert rows_of(back.select(*unique.columns)) == rows_of(unique)
    assert {(r["doc_id"], r["shard"]) for r in back.collect()} == {(r["doc_id"], r["shard"]) for r in placed.collect()}
    extents = sharding.shard_extents(placed, "n_chars").collect()
    assert sum(r["n_rows"] for r in extents) == unique.count()
    with pytest.raises(ValueError, match="shard"):
        sharding.write_shards(unique.withColumn("Shard", F.lit(1)), placed, str(tmp_path / "other"))
