"""Files cut into splits anywhere give the records the whole text gives."""

import json
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rankloom.sources.large_json import read_large_content, write_arrays

TRICKY = [
    {"id": 1, "t": "}{][\"\\ }"},
    {"id": 2, "n": {"a": [{"b": "}"}, {"c": "\\\\"}]}, "t": ""},
    {"id": 3, "t": "é{" * 40},
    {"id": 4, "t": None, "l": [[], {}, [{}]]},
    {"id": 5, "t": "\\\"}," * 30},
]


def records(spark, folder, split_bytes):
    rows = read_large_content(spark, str(folder), split_bytes=split_bytes)
    rows = rows.select("file", "pos", F.to_json("record").alias("json")).orderBy("file", "pos").collect()
    assert len({(r.file, r.pos) for r in rows}) == len(rows)
    return [(r.file, json.loads(r.json)) for r in rows]


@pytest.mark.parametrize("split_bytes", [23, 300, 1 << 20])
def test_same_records_wherever_a_file_is_cut(spark, tmp_path, split_bytes):
    many = [dict(random.Random(i).choice(TRICKY), at=i) for i in range(40)]
    shapes = {
        "a.json": json.dumps(many, ensure_ascii=False),
        "b.json": json.dumps({"count": 40, "note": "x \" y", "value": many, "next": None}, indent=1),
        "c.json": "\n".join(map(json.dumps, many)) + "\n",
        "d.json": "[]",
        "e.json": ' [1, "}", [2, {"a": 3}], {"b": 4}, null, 5] ',
        "f.json": "",
        "g.json": "\ufeff" + json.dumps(many[:3], indent=2),
        "h.json": json.dumps(many[0]),
        "i.json": "\ufeff" + json.dumps({"value": many[:2]}),
        "j.json": '{"value": []}',
    }
    for name, text in shapes.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    (tmp_path / "other.txt").write_text("no JSON")
    expected = [("a.json", r) for r in many] + [("b.json", r) for r in many] + [("c.json", r) for r in many]
    expected += [("e.json", r) for r in (1, "}", [2, {"a": 3}], {"b": 4}, None, 5)]
    expected += [("g.json", r) for r in many[:3]] + [("h.json", many[0])] + [("i.json", r) for r in many[:2]]
    assert records(spark, tmp_path, split_bytes) == expected


@pytest.mark.parametrize(
    "text",
    [
        '[{"a": 1}', '[{"a": 1},]', '[{"a": 1} {"b": 2}]', '[{"a": 1}] {"b": 2}', '[{"a": 1}, 5][6]', '[,{"a": 1}]',
        '{"a": 1', '{"a": 1} x', '{"a": 1},{"b": 2}', '{"value": [{"a": 1}]', '{"value": [{"a": 1}]} {}',
        '[{"a": "x}]', '[{"a": 1}, , {"b": 2}]', "x", "5",
    ],
)
def test_malformed_files_fail(spark, tmp_path, text):
    (tmp_path / "bad.json").write_text(text)
    for split_bytes in (5, 1 << 20):
        with pytest.raises(PySparkException, match="malformed JSON in bad.json"):
            records(spark, tmp_path, split_bytes)


def test_many_tasks_read_one_file(spark, tmp_path):
    rows = spark.range(2000).select("id", F.concat(F.lit("}\"{ "), F.col("id")).alias("text"))
    write_arrays(rows.coalesce(1), f"{tmp_path}/out")
    found = read_large_content(spark, f"{tmp_path}/out", "*.txt", split_bytes=4096)
    back = found.selectExpr("variant_get(record, '$.id', 'bigint') AS id", "variant_get(record, '$.text', 'string') AS text")
    assert back.exceptAll(rows).isEmpty() and back.count() == 2000
    assert [r.id for r in found.orderBy("pos").selectExpr("variant_get(record, '$.id', 'int') AS id").collect()] == list(range(2000))
    chunks = spark.read.option("lineSep", "}").text(f"{tmp_path}/out")
    assert chunks.select("_metadata.file_name").distinct().count() == 1


def test_empty_partitions_are_empty_arrays(spark, tmp_path):
    write_arrays(spark.range(0), f"{tmp_path}/none")
    assert read_large_content(spark, f"{tmp_path}/none", "*.txt").isEmpty()
