"""The method of the secret models against plain Python."""

import math
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from rankloom.llm import secrets

SF_DIR = "/root/testdata/sf0.01"


def test_model_spans_against_plain_python(spark):
    rng = random.Random(8)
    names = ["".join(rng.choice(["State", "Ment", "ation", "Ing", "Frame"]) for _ in range(4)) for _ in range(300)]
    key = lambda n: "".join(rng.choice("ABCDEFGHabcdefgh01234567") for _ in range(n))
    texts = [
        " ".join([*rng.choices(names, k=8), key(rng.choice([12, 17, 24, 40])), *rng.choices(names, k=8), "token=" + key(40)])
        for _ in range(300)
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tokens = secrets.labelled_tokens(docs).withColumn("held", secrets._held_out()).collect()
    sure = sum(t.sure for t in tokens)
    unsure = (secrets.PRIOR / (secrets.PRIOR + sure)) ** 2
    weight = lambda t: 1 if t.random or t.sure else unsure

    size = len(secrets.ALPHABET) + 1
    counts = [[[1.0] * size for _ in range(size)] for _ in range(2)]
    code = lambda c: secrets.ALPHABET.index(c) + 1 if c in secrets.ALPHABET else 0
    for t in tokens:
        if not t.held:
            for a, b in zip([0, *map(code, t.token)], map(code, t.token)):
                counts[t.random][a][b] += weight(t)
    share = [[[math.log(n / sum(line)) for n in line] for line in model] for model in counts]

    def score(token):
        path = [0, *map(code, token)]
        return sum(share[1][a][b] - share[0][a][b] for a, b in zip(path, path[1:])) / len(token)

    length = lambda t: max(i for i, n in enumerate(secrets.LENGTHS) if len(t) >= n or i == 0)
    place = lambda t: max(0, math.ceil(score(t) / secrets._BIN))
    held = [t for t in tokens if t.held]
    m = sum(t.random for t in held)
    whole = {}
    for t in held:
        if not t.random:
            whole[place(t.token)] = whole.get(place(t.token), 0) + weight(t)

    def limit(kind):
        own = {p: secrets.PRIOR * n / sum(whole.values()) for p, n in whole.items()}
        for t in held:
            if not t.random and length(t.token) == kind:
                own[place(t.token)] += weight(t)
        n = sum(own.values())
        over = lambda p: sum(c for q, c in own.items() if q > p) / n
        alike = lambda p: sum(t.random and place(t.token) > p for t in held) / max(m, 1)
        places = range(max(place(t.token) for t in held) + 1)
        shares = [over(p) / alike(p) for p in places if alike(p) >= 0.5]
        keys = min([1.0, *shares]) * m / (m + 1) if shares else 0.0
        return next(p for p in places if over(p) - keys * alike(p) <= secrets.FALSE_ALARMS * (1 - keys)) * secrets._BIN

    limits = [limit(kind) for kind in range(len(secrets.LENGTHS))]
    expected = {
        (k, found.start(), found.end())
        for k, text in enumerate(texts)
        for found in re.finditer(r"[A-Za-z0-9+/_=-]{12,}", text)
        if not found[0].startswith("token=") and score(found[0]) > limits[length(found[0])]
    }
    got = secrets.secret_spans(docs).selectExpr("doc_id", "inline(markov)").collect()
    assert {(r.doc_id, r.start, r.end) for r in got} == expected and len(expected) > 200


@pytest.mark.parametrize("sure", [0, 3, 49, 50, 51, 5000])
def test_weight_of_unsure_tokens_has_no_step(spark, sure):
    tokens = spark.range(sure + 20).select((F.col("id") < sure).alias("sure"))
    weight = secrets.unsure_weight(tokens)
    assert 0 < weight <= 1 and (sure > 0 or weight == 1)
    one_more = secrets.unsure_weight(spark.range(sure + 1).select(F.lit(True).alias("sure")))
    assert weight * 0.8 < one_more < weight


def test_spans_can_be_exploded(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = secrets.secret_spans(docs)
    began = time.monotonic()
    spans = found.selectExpr("doc_id", "explode(markov) AS m").filter("m.end > m.start").count()
    assert time.monotonic() - began < 10
    assert spans == found.agg(F.sum(F.size("markov"))).first()[0]
