"""License rules against plain Python."""

import re

import pytest

from rankloom.llm import licenses
from rankloom.llm.licenses import RULES

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def brute(text):
    """Labels, detections and fixed phrases by a plain loop over all rules."""
    words = WORDS.findall(lower(text))
    spaced = " " + "  ".join(words) + " "
    spans = [(m.start(), m.end(), k, r) for k, r in enumerate(RULES) for m in re.finditer(r.regex, spaced)]
    kept = [
        x
        for x in spans
        if not any(
            y[0] <= x[0] and y[1] >= x[1] and y[3].priority >= x[3].priority
            and (y[1] - y[0] > x[1] - x[0] or y[3].priority > x[3].priority or y[2] < x[2])
            for y in spans
        )
    ]
    base = [
        (i, label)
        for phrase, label in licenses.BASE.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    found = sorted((spaced[:s].count(" ") // 2, spaced[:e].count(" ") // 2, r.label) for s, e, _, r in kept)
    return len(words), base, found, sorted({label for _, label in base} | {r.label for *_, r in kept})


TEXTS = [
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "Released under the MIT License.",
    "under the mit license under the MIT-License, under the mit license",
    "cc-by-nc CC BY NC cc\nby\nnc 4.0",
    "SPDX-License-Identifier: GPL-2.0-or-later",
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "Creative Commons Attribution-ShareAlike 4.0 International License",
    "see https://creativecommons.org/licenses/by-nc-sa/3.0/ and http://www.apache.org/licenses/LICENSE-2.0",
    "Copyright (c) 2019 Somebody. All rights reserved.",
    "permit me to limit the licensed fishery",
    "BSD-3-Clause License, formerly the New BSD license",
    "",
    None,
    " \n\t",
    "x" * 100_000 + " under the MIT license " + "word " * 50_000,
    "cc by nc " * 2000,
]


@pytest.fixture(scope="module")
def found(spark):
    rows = [(k, t, "a", "b", 1) for k, t in enumerate(TEXTS)]
    rows += [(None, TEXTS[1], None, None, None), (1, TEXTS[1], "a", "b", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, low string, spaced string, base int")
    return licenses.license_detections(docs).collect()


def test_against_plain_python(found):
    assert len(found) == len(TEXTS) + 2
    for row in found:
        n_words, base, spans, labels = brute(TEXTS[1] if row["doc_id"] is None else TEXTS[row["doc_id"]])
        starts = [i for i, _ in base]
        assert (row["n_words"], row["n_base"]) == (n_words, len(base))
        assert (row["first_word"], row["last_word"]) == (min(starts, default=None), max(starts, default=None))
        assert row["base_labels"] == sorted({label for _, label in base})
        assert sorted((d["start"], d["end"], d["label"]) for d in row["detections"]) == spans
        assert row["labels"] == labels
        assert 0 <= row["score"] <= 1 and (row["score"] > 0) == bool(labels)


def test_expected_labels(found):
    labels = {r["doc_id"]: r["labels"] for r in found}
    wanted = [["apache-2"], ["mit"], ["mit"], ["cc-by-nc"], ["gpl-2"]]
    assert [labels[k] for k in range(5)] == wanted
    assert "gpl" in labels[5] and labels[6] == ["mit"] and labels[7] == ["cc-by-sa"]
    assert labels[8] == ["apache-2", "cc-by-nc-sa"] and labels[9] == ["proprietary"] and labels[10] == []
    assert labels[11] == ["bsd-3-clause"] and labels[12] == labels[13] == labels[14] == []


def sample(pattern):
    """A text the pattern fits: optional parts left out, the first of alternatives."""
    pattern = pattern.replace("[^\\n]{1,80}?", "someone").replace("[^\\n]{1,60}?", "someone").replace("[0-9]{4}", "2020")
    while (new := re.sub(r"\(([^()]*)\)\?", "", pattern)) != pattern or (new := re.sub(r"\(([^()|]*)[^()]*\)", r"\1", pattern)) != pattern:
        pattern = new
    pattern = re.sub(r"\[(.)[^\]]*\]", r"\1", pattern).split("|")[0]
    return re.sub(r".\?", "", pattern)


def test_every_rule_passes_its_gates(spark):
    texts = [sample(r.pattern) for r in RULES]
    for rule, text in zip(RULES, texts):
        assert re.search(rule.regex, " " + text.replace(" ", "  ") + " "), (rule, text)
        assert rule.keyword in text
    docs = spark.createDataFrame([(k, t.upper()) for k, t in enumerate(texts)], "doc_id long, text string")
    for row in licenses.license_detections(docs).collect():
        assert row["labels"] == brute(texts[row["doc_id"]])[3] and row["labels"], texts[row["doc_id"]]


def test_result_can_be_exploded(spark):
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS[:8])], "doc_id long, text string")
    rows = licenses.license_detections(docs).selectExpr("doc_id", "explode(detections) AS d").filter("d.label = 'mit'")
    assert {r["doc_id"] for r in rows.collect()} == {1, 2, 6}


def test_empty_table(spark):
    assert licenses.license_detections(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_no_python_on_the_main_path(spark):
    from rankloom.llm.workload import op12_license_rules

    plan = op12_license_rules(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|MapPartitions|Exchange", plan)
