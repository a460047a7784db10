"""Support vectors, perceptron, power iteration and topics against plain versions and planted structure."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataflow.operators import glm as G
from strataflow.operators import graphs as GR
from strataflow.operators import perceptron as MP


def test_support_vectors_reach_the_optimum(spark):
    r = np.random.default_rng(3)
    x = r.normal(0, 1, (200, 2))
    y = (x[:, 0] - x[:, 1] + r.normal(0, 0.5, 200) > 0.3).astype(float)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y, strict=True)], "a double, b double, y double")
    terms = {"a": F.col("a"), "b": F.col("b")}
    model = G.fit(df, F.col("y"), terms, G.HINGE, ridge=0.01)
    design, s, penalty = np.column_stack([np.ones(200), x]), 2 * y - 1, np.array([0.0, *(0.01 * x.var(axis=0))])
    loss = lambda b: (np.maximum(0, 1 - s * (design @ b)) ** 2).mean() + penalty @ (b * b)
    best = loss(model.coefficients)
    for i in range(3):
        for step in (-1e-3, 1e-3):
            moved = model.coefficients.copy()
            moved[i] += step
            assert loss(moved) > best
    assert np.allclose(model.gradient, 0, atol=1e-8) and math.isclose(model.deviance / 200, (np.maximum(0, 1 - s * (design @ model.coefficients)) ** 2).mean(), rel_tol=1e-9)


def test_perceptron_learns_what_a_line_cannot(spark):
    rows = [(float(a), float(b), float((a > 0) != (b > 0))) for a in (-1.0, -0.8, 0.9, 1.1) for b in (-1.2, -0.7, 0.8, 1.0)]
    df = spark.createDataFrame(rows, "z0 double, z1 double, y double").coalesce(1).cache()
    model = MP.fit(df, ["z0", "z1"], hidden=4, rounds=60, rate=4.0, momentum=0.8)
    line = G.fit(df, F.col("y"), {"z0": F.col("z0"), "z1": F.col("z1")}, G.BINOMIAL, ridge=1e-6)
    assert model.losses[-1][1] < 0.3 < line.deviance / 2 / len(rows)
    # the same rounds in numpy
    inner, outer = MP.start_weights(2, 4)
    z, y = np.array([r[:2] for r in rows]), np.array([r[2] for r in rows])
    vi, vo = np.zeros_like(inner), np.zeros_like(outer)
    for _ in range(60):
        h = 1 / (1 + np.exp(-(inner[:, 0] + z @ inner[:, 1:].T)))
        miss = 1 / (1 + np.exp(-(outer[0] + h @ outer[1:]))) - y
        back = miss[:, None] * outer[1:] * h * (1 - h)
        vi = 0.8 * vi - 4.0 * np.column_stack([back.mean(axis=0), back.T @ z / len(y)])
        vo = 0.8 * vo - 4.0 * np.append(miss.mean(), (miss[:, None] * h).mean(axis=0))
        inner, outer = inner + vi, outer + vo
    assert np.allclose(model.inner, inner, atol=1e-6) and np.allclose(model.outer, outer, atol=1e-6)
    with pytest.raises(ValueError):
        MP.fit(df.limit(0), ["z0", "z1"])


def test_power_iteration_parts_planted_groups_and_equals_numpy(spark):
    r = np.random.default_rng(5)
    size, w = 24, np.zeros((24, 24))
    for i in range(size):
        for j in range(i):
            same = (i < 14) == (j < 14)
            w[i, j] = w[j, i] = (r.random() < (0.9 if same else 0.02)) * (1.0 if same else 0.05)
    w[0, 0] = 2.0
    edges = [(f"n{i:02d}", f"n{j:02d}", float(w[i, j])) for i in range(size) for j in range(i + 1) if w[i, j]]
    df = spark.createDataFrame(edges, "src string, dst string, weight double")
    got = {x["node"]: x for x in GR.power_iteration(df, 8).collect()}
    degree = w.sum(axis=1)
    v = degree / degree.sum()
    for _ in range(8):
        v = (w / degree[:, None]) @ v
        v /= v.sum()
    assert all(math.isclose(got[f"n{i:02d}"]["value"], v[i], rel_tol=1e-9) and math.isclose(got[f"n{i:02d}"]["degree"], degree[i]) for i in range(size))
    parted = GR.value_clusters(GR.power_iteration(df, 8), 2).collect()
    groups = {c: {x["node"] for x in parted if x["cluster"] == c} for c in (0, 1)}
    first = {f"n{i:02d}" for i in range(14)}
    assert first in groups.values()
    assert GR.power_iteration(df.limit(0)).collect() == [] and GR.value_clusters(GR.power_iteration(df.limit(0))).collect() == []


def test_topics_beat_the_unigram_and_add_up(spark):
    r = np.random.default_rng(6)
    kinds = np.array([[0.3, 0.3, 0.3, 0.05, 0.05, 0.0], [0.0, 0.05, 0.05, 0.3, 0.3, 0.3]])
    rows = [(d, w, int(n)) for d in range(30) for w, n in enumerate(r.multinomial(80, kinds[d % 2])) if n] + [(None, 1, 5), (3, None, 5), (2, 2, 0)]
    df = spark.createDataFrame(rows, "doc int, word int, n int")
    mixture, words, rounds = GR.fit_topics(df, k=2, rounds=12)
    m = {x["doc"]: (x["t0"], x["t1"]) for x in mixture.collect()}
    assert len(m) == 30 and all(abs(a + b - 1) < 1e-12 for a, b in m.values())
    topic = [sum(x[t] for x in words.collect()) for t in ("t0", "t1")]
    assert all(abs(x - 1) < 1e-12 for x in topic)
    sides = {d % 2 for d, (a, _) in m.items() if a > 0.9}, {d % 2 for d, (a, _) in m.items() if a < 0.1}
    assert sum(map(len, sides)) == 2 and sides[0] != sides[1]
    seen = [x["log_likelihood"] for x in rounds.orderBy("round").collect()]
    assert all(b > a - 1e-3 for a, b in zip(seen, seen[1:], strict=False))
    real = [x for x in rows if x[0] is not None and x[1] is not None and x[2]]
    total = sum(n for _, _, n in real)
    share = {w: sum(n for _, x, n in real if x == w) / total for w in range(6)}
    assert seen[-1] > sum(n * math.log(share[w]) for _, w, n in real) / total + 0.3
    with pytest.raises(ValueError):
        GR.fit_topics(df.limit(0))
