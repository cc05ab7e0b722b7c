"""Hard negatives against comparing everything."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankloom.llm import rtree

SCHEMA = "vec_id long, embedding array<float>, label int, q string, tile int, anchor_id long"


def brute(rows, every=50):
    """All pairs; ``rows`` are (vec_id, vector, label)."""
    whole = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        row = (label, [float(np.floor(256 * float(np.float32(x)))) for x in v])
        whole[i] = min(whole.get(i, row), row)
    score = lambda a, b: int(sum(x * y for x, y in zip(whole[a][1], whole[b][1])))
    out = []
    for a in (i for i in whole if i % every == 0):
        ranked = sorted((-score(a, b), b) for b in whole if b != a)
        for s, p in [r for r in ranked if whole[r[1]][0] == whole[a][0]][:5]:
            hard = [r for r in ranked if whole[r[1]][0] != whole[a][0] and 50 * -s <= 100 * -r[0] <= 95 * -s][:3]
            out += [(a, p, k, n, -s, -t) for k, (t, n) in enumerate(hard, 1)]
    return sorted(out)


def mined(spark, rows, **changes):
    table = spark.createDataFrame([(i, v, label, "x", 1, 2) for i, v, label in rows], SCHEMA)
    return sorted(tuple(r) for r in rtree.hard_negatives(table, F.col("vec_id") % 50 == 0, **changes).collect())


def test_against_all_pairs(spark, monkeypatch):
    rng = np.random.default_rng(5)
    points = rng.normal(size=(700, 6)).round(1)  # rounding makes ties
    points[100:300] = points[100]  # a point that many rows share
    rows = [(i, p.tolist(), int(rng.integers(0, 3) if i > 250 else 1)) for i, p in enumerate(points)]
    for name, value in (("BLOCK", 128), ("PAGE", 16), ("QUERIES", 8)):
        monkeypatch.setattr(rtree, name, value)
    got = mined(spark, rows)
    assert got == brute(rows) and len(got) > 50


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 0.5], 1),
        (0, [1.0, 0.5], 1),  # a repeated row
        (50, [1.0], 1),  # shorter
        (1, [0.9, 0.5], 1),
        (2, [0.8, 0.3], 1),
        (2, [0.1, 0.3], 2),  # the same id again
        (3, [0.7, 0.2], 2),
        (4, [0.7, 0.2], 2),
        (5, [], 2),
        (6, None, 2),
        (7, [None, 1.0], 2),
        (8, [float("nan"), 1.0], 2),
        (9, [float("inf"), 1.0], 2),
        (10, [0.7, 0.2], None),
        (None, [0.7, 0.2], 2),
        (11, [-1.0, -1.0], 1),
    ]
    got = mined(spark, rows)
    assert got == brute(rows) and {r[3] for r in got} == {3, 4}


@pytest.mark.parametrize("rows", [[], [(1, [0.5], 1), (2, [0.5], 2)], [(0, [0.5], 1)]])
def test_nothing_to_mine(spark, rows):
    assert mined(spark, rows) == []


def test_components_too_large_for_exact_products(spark):
    with pytest.raises(Exception, match="too large"):
        mined(spark, [(0, [1e30, 1.0], 1), (1, [1e30, 1.0], 1), (2, [1.0, 1.0], 2)])


def test_boxes_are_skipped():
    rng = np.random.default_rng(1)
    points = np.floor(rng.normal(size=(2048, 3)) * 256)
    pa = pytest.importorskip("pyarrow")
    block = rtree._block(pa.table({"vec_id": np.arange(2048), "label": np.zeros(2048, dtype=np.int64), "q": points.tolist()}))
    asked = pa.table(
        {"anchor_id": [1], "label": [0], "key": [0], "low": [-np.inf], "high": [np.inf], "q": [points[1].tolist()]}
    )
    searcher = rtree.Searcher(rtree._ipc(asked), 5, True)
    looked = searcher.visit(block)
    wanted = sorted((-float(p @ points[1]), i) for i, p in enumerate(points) if i != 1)[:5]
    assert searcher.ids[0].tolist() == [i for _, i in wanted]
    assert looked < 2048 // rtree.PAGE / 2
