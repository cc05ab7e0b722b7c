"""Sizes, checksums and order of the shards against plain Python."""

import zlib

from rankloom import llm

SF_DIR = "/root/testdata/sf0.001"


def test_values_against_plain_python(spark):
    texts = {d.doc_id: (d.text or "").encode() for d in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = llm.queries()["op5_hilbert_shards"](spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        assert (r.size, r.text_crc32, r.law) == (len(texts[r.doc_id]) + 16, zlib.crc32(texts[r.doc_id]), "rows")
        assert r.grown_shard is None
    by_place = sorted(rows, key=lambda r: (r.shard, r.slot))
    assert by_place == sorted(rows, key=lambda r: (r.curve, r.doc_id))
