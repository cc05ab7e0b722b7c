"""Scanning, mapping and cleaning, edge by edge."""

import json

import pytest
from pyspark.sql import functions as F

from rankloom.functions.dates import normalise_modified
from rankloom.functions.markup import decode_entities, strip_html
from rankloom.functions.records import split_tags
from rankloom.functions.text import allowed_edits, embedding_text, lookup_keys, normalise
from rankloom.operators.canonical import (
    absolute_url,
    canonicalise,
    clean_delivery,
    delivery_records,
    drop_empty,
    require_id,
    without_id,
)
from rankloom.plans.ingest import current_documents, load_documents, typed, variant_tables
from rankloom.sources.content import parse_content, read_content, read_delivery
from rankloom.sources.sinks import preview, read_version, upserted, write_canonical, write_version

def as_of():
    return F.lit("2026-02-01 00:00:00").cast("timestamp")

NOW = "2026-02-01T00:00:00Z"


def values(spark, column, inputs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_strip_html(spark):
    cases = {
        None: "",
        "": "",
        "a  b\n c": "a b c",
        "a\xa0 b": "a b",
        "a &amp; b": "a &amp; b",  # no markup, so the reference stays
        "1 < 2 &amp; 3": "1 < 2 &amp; 3",
        "<p>a<b>b</b>c</p>": "a b c",
        "<p>a &amp; b&nbsp;&eacute;&#233;&#xE9;&hellip;</p>": "a & b éé" + "é…",
        "<p>&amp;lt; &bogus; &#150; AT&T</p>": "&lt; &bogus – AT&T",
        "x<!-- <b>no</b> -->y": "x y",
        "<script>if (a<b) {'</p>'}</script>t<style>p{}</style>": "t",
        "a<script>open": "a",
        "<a title='x>y'>z</a>": "z",
        "3 < 5 > 2": "3 < 5 > 2",
        "<p don't>kept</p>": "kept",
        "<!DOCTYPE html><br/>t": "t",
        "<template>no</template><ruby>k<rt>r</rt></ruby>": "k",
    }
    assert values(spark, strip_html("v"), list(cases)) == list(cases.values())


def test_decode_entities_once(spark):
    assert values(spark, decode_entities("v"), ["&amp;amp;", "&", "a&b&lt;", "&#0;", "&notin;"]) == [
        "&amp;", "&", "a&b<", "�", "∉",
    ]


def test_long_markup_does_not_recurse(spark):
    text = "<p " + "a='b' " * 20000 + ">x" + "<i>y</i>" * 20000
    assert values(spark, F.length(strip_html("v")), [text]) == [40001]


def test_tags(spark):
    assert values(spark, split_tags("v"), [None, "", "a|b;c, d", " , |x\xa0;"]) == [
        [], [], ["a", "b", "c", "d"], ["x"],
    ]


def test_dates(spark):
    cases = {
        "2026-01-31T10:20:30Z": "2026-01-31T10:20:30Z",
        "2026-01-31T10:20:30+02:00": "2026-01-31T08:20:30Z",
        "2026-01-31T10:20:30+0200": "2026-01-31T08:20:30Z",
        "2026-01-31T10:20:30-03": "2026-01-31T13:20:30Z",
        "2026-01-31T10:20": "2026-01-31T10:20:00Z",
        "2026-01-31T10": "2026-01-31T10:00:00Z",
        "2026-01-31 10:20:30.1234567": "2026-01-31T10:20:30Z",
        " 2026-01-31 ": "2026-01-31T00:00:00Z",
        "20260131T102030Z": "2026-01-31T10:20:30Z",
        "20260131": "2026-01-31T00:00:00Z",
        "2026-02-30": NOW,
        "2026": NOW,
        "2026-1-3": NOW,
        "12:30:00": NOW,
        "now": NOW,
        "epoch": NOW,
        "soon": NOW,
        "": NOW,
        None: NOW,
    }
    assert values(spark, normalise_modified("v", as_of()), list(cases)) == list(cases.values())


def test_normalise(spark):
    cases = {
        "  Café-Crème ": "cafe creme",
        "ID-Kaart": "id kaart",
        "ﬁle №5": "file no5",
        "ÅNGSTRÖM²": "angstrom2",
        "!!": "",
        None: "",
    }
    assert values(spark, normalise("v"), list(cases)) == list(cases.values())
    assert values(spark, lookup_keys("v"), ["id-kaart", "een", " - "]) == [["id kaart", "idkaart"], ["een"], []]


def test_allowed_edits(spark):
    words = ["abc", "abcd", "ABCD", "abc1d", "ab-cd", "Éclair", "É"]
    assert values(spark, allowed_edits("v"), words) == [0, 1, 0, 0, 0, 1, 0]


def test_embedding_text(spark):
    assert values(spark, embedding_text(F.lit("t"), "v"), ["b", ""]) == ["t\nb", "t"]
    assert values(spark, embedding_text("v", F.lit("")), ["", " "]) == [" ", " "]


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "b.json").write_text('[{"id": "1", "title": "late"}, {"id": "2"}]', encoding="utf-8")
    (tmp_path / "a.json").write_text('{"value": [{"id": "1", "title": "early"}], "n": 1}', encoding="utf-8")
    (tmp_path / "c.json").write_text('{"id": "3", "value": "text"}', encoding="utf-8")
    (tmp_path / "d.txt").write_text("no", encoding="utf-8")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "e.json").write_text('{"id": "9"}', encoding="utf-8")
    return str(tmp_path)


def test_content_scan(spark, folder):
    rows = read_content(spark, folder).select(
        "file", "pos", F.try_variant_get("record", "$.id", "string").alias("id")
    )
    assert [tuple(r) for r in rows.orderBy("file", "pos").collect()] == [
        ("a.json", 0, "1"), ("b.json", 0, "1"), ("b.json", 1, "2"), ("c.json", 0, "3"),
    ]


def test_missing_folder_fails(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_content(spark, str(tmp_path / "none"))


def test_malformed_content_fails(spark):
    for text in ('[{"id": ', '{"id": ', '[{"id": 1}, {"id": }]'):
        texts = spark.createDataFrame([("x", text)], "file string, value string")
        with pytest.raises(Exception):
            parse_content(texts).collect()


def test_later_file_wins(spark, folder):
    docs = current_documents(load_documents(spark, folder, as_of()))
    found = {r["id"]: r["title"] for r in docs.collect()}
    assert found == {"1": "late", "2": "", "3": ""}
    assert typed(docs).schema["lastModified"].dataType.simpleString() == "timestamp"
    tables = variant_tables(docs, spark.createDataFrame([("1", [0.5])], "id string, vec array<float>"))
    assert "contentVector" in tables["tuned"].columns
    assert "contentVector" not in tables["baseline"].columns


def canonical(spark, *records):
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "i int, j string")
    return canonicalise(df.select("i", F.parse_json("j").alias("record")), as_of()).orderBy("i")


def test_aliases_and_types(spark):
    rows = canonical(
        spark,
        {"ItemID": "x", "title": "", "Title": None, "PageTitle": " P ", "Content": "<p>b</p>", "body": " "},
        {"id": 5, "tags": ["a ", "", None, 3], "contentType": " FAQ ", "url": " u "},
        {"_id": "0", "Tags": "a|b", "date": "2026-01-02"},
        {"id": 0, "tags": 7, "type": ""},
        {"key": "k", "tags": True, "lastModified": "x"},
    ).collect()
    assert [r["id"] for r in rows] == ["x", "5", "0", None, "k"]
    assert (rows[0]["title"], rows[0]["body"]) == ("P", "")
    assert [r["tags"] for r in rows] == [[], ["a", "3"], ["a", "b"], ["7"], ["True"]]
    assert [r["contentType"] for r in rows] == ["page", "faq", "page", "page", "page"]
    assert (rows[1]["url"], rows[2]["lastModified"], rows[4]["lastModified"]) == ("u", "2026-01-02T00:00:00Z", NOW)


def test_missing_id(spark):
    docs = canonical(spark, {"id": "a"}, {"id": ""}, {"id": 0})
    assert without_id(docs).count() == 2
    with pytest.raises(Exception, match="missing an id"):
        require_id(docs).collect()
    assert drop_empty(canonical(spark, {"id": "a"}, {"id": "b", "title": "t"})).count() == 1


def test_delivery(spark, tmp_path):
    item = {
        "id": "A", "__typename": "Article", "url": {"path": "/p"},
        "fields": [
            {"name": "Title", "value": "one"}, {"name": "Title", "value": "two"}, {"value": "x"},
            {"name": "Intro", "value": ""}, {"name": "Content", "value": "<p>c</p>"},
            {"name": "Tags", "value": "a|b"}, {"name": "__Created", "value": "20260101T000000Z"},
        ],
    }
    bare = {"id": "B", "url": None, "fields": []}
    (tmp_path / "p.json").write_text(json.dumps({"total": 2, "results": [item, bare]}))
    mapped = delivery_records(
        read_delivery(spark, str(tmp_path)), "https://x.org/", body_fields=("Intro", "Content"), tags_field="Tags"
    )
    rows = mapped.orderBy("id").collect()
    assert tuple(rows[0]) == ("A", "two", "<p>c</p>", "https://x.org/p", "Article", "20260101T000000Z", "a|b")
    assert tuple(rows[1]) == ("B", "", "", "https://x.org/", "page", None, "")
    clean = clean_delivery(mapped, as_of()).orderBy("id").collect()
    assert clean[0]["body"] == "c" and clean[0]["tags"] == ["a", "b"] and clean[0]["contentType"] == "article"
    assert "tags" not in delivery_records(read_delivery(spark, str(tmp_path))).columns


def test_absolute_url(spark):
    paths = ["/a", "b", None]
    assert values(spark, absolute_url(F.col("v"), "http://h/"), paths) == ["http://h/a", "http://h/", "http://h/"]
    assert values(spark, absolute_url(F.col("v")), paths) == ["/a", "b", ""]


def test_upsert_and_sinks(spark, tmp_path):
    current = spark.createDataFrame([("a", 1), ("b", 2)], "id string, v int")
    incoming = spark.createDataFrame(
        [("b", 3, "f", 0), ("b", 4, "f", 1), ("c", 5, "e", 9)], "id string, v int, file string, pos int"
    )
    merged = upserted(current, incoming)
    assert sorted(map(tuple, merged.collect())) == [("a", 1), ("b", 4), ("c", 5)]
    write_version(merged, str(tmp_path / "v1"))
    assert read_version(spark, str(tmp_path / "v1")).count() == 3
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_version(merged, str(tmp_path / "v1"))
    write_canonical(canonical(spark, {"id": "a", "tags": "x"}).drop("i"), str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).first()["tags"] == ["x"]
    assert [r["pos"] for r in preview(incoming, 2).collect()] == [9, 0]


@pytest.mark.parametrize(
    "text, ids",
    [
        ('{"id":"1"}\n{"id":"2"}\n', ["1", "2"]),
        ('[{"id":"1"},{"id":"2"}]', ["1", "2"]),
        ('{"value":[{"id":"1"},{"id":"2"}]}', ["1", "2"]),
        ('{"id":"1"}', ["1"]),
        ('[{"id":"1"}]\n[{"id":"2"}]', None),
        ('{"value":[{"id":"1"}]} junk', None),
        ('{"id":"1"} {"id":"2"}', None),
    ],
)
def test_content_text_is_read_whole_or_fails(spark, text, ids):
    from rankloom.sources.content import parse_content

    rows = parse_content(spark.createDataFrame([(text, "f")], "value string, file string"))
    read = rows.orderBy("pos").select(F.expr("variant_get(record, '$.id', 'string')"))
    if ids is None:
        with pytest.raises(Exception):
            read.collect()
    else:
        assert [r[0] for r in read.collect()] == ids


def test_numbers_as_dates_stay(spark):
    rows = spark.createDataFrame([('{"id":"1","lastModified":1700000000}',), ('{"id":"2","lastModified":0}',), ('{"id":"3","lastModified":"20240102"}',)], "j string")
    docs = canonicalise(rows.select(F.parse_json("j").alias("record")), F.lit("2024-06-30").cast("timestamp"))
    got = {r["id"]: r["lastModified"] for r in docs.collect()}
    assert got["1"] == "1700000000" and got["2"] == "2024-06-30T00:00:00Z"
