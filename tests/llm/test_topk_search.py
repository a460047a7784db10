import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from strataflow.llm import topk_search as T

SCHEMA = "vec_id long, embedding array<float>, label string, score string"


def brute(rows, k=5):
    ok = {}
    for i, v, *_ in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            y = [math.floor(256 * float(np.float32(x))) for x in v]
            ok[i] = min(ok.get(i, y), y)
    out = []
    for q in ok:
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(ok[q], x, strict=False)), i) for i, x in ok.items() if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def run(spark, rows):
    return sorted(tuple(r) for r in T.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0).collect())


@pytest.mark.parametrize("kind", ["normal", "clustered", "ties"])
def test_matches_brute_force(spark, monkeypatch, kind):
    monkeypatch.setattr(T, "PAGE", 64)
    monkeypatch.setattr(T, "QUERY_BLOCK", 4)
    r = np.random.default_rng(5)
    x = r.normal(0, 0.2, (600, 8))
    if kind == "clustered":
        x = r.normal(0, 1, (6, 8))[r.integers(0, 6, 600)] + x * 0.1
    if kind == "ties":
        x[::3] = x[0]
    rows = [(i - 100, [float(c) for c in v], "l", "own") for i, v in enumerate(x)]
    assert run(spark, rows) == brute(rows)


def test_awkward_rows(spark):
    v = [0.1, -0.2, 0.3]
    rows = [(0, v, None, None), (50, v, None, None), (50, v, None, None), (1, None, None, None), (2, [None, 1.0, 1.0], None, None), (3, [float("nan")] * 3, None, None),
            (4, [float("inf"), 0.0, 0.0], None, None), (None, v, None, None), (5, [], None, None), (6, [0.5], None, None), (7, [0.0, 0.0, 0.0], None, None)]
    assert run(spark, rows) == brute(rows)


def test_empty_and_lonely(spark):
    assert run(spark, []) == [] and run(spark, [(1, [0.5], "a", "b")]) == [] and run(spark, [(0, [0.5], "a", "b")]) == []


def test_stored_bounds_save_distances():
    r = np.random.default_rng(1)
    x = (np.repeat(r.normal(0, 100, (8, 16)), 200, axis=0) + r.normal(0, 1, (1600, 16))).astype(np.int64)
    norm2 = float((x.astype(float) ** 2).sum(axis=1).max())
    tree = T.build_subtree(np.arange(1600), x, norm2)
    assert all(len(n[0]) <= T.NODE for n in tree["nodes"]) and sum(len(n[0]) for n in tree["nodes"]) == 1600
    y = T._lifted(x, norm2)
    for o, radius, (ids, _, d) in zip(tree["objects"], tree["radii"], tree["nodes"], strict=True):
        assert np.allclose(d, np.sqrt(((y[ids] - o) ** 2).sum(axis=1))) and d.max() <= radius + 1e-9
