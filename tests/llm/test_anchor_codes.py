import hashlib
import math
import random

import numpy as np
import pytest
from strataflow.llm import anchor_codes as A

SCHEMA = "vec_id long, embedding array<double>, label int"


def floor256(x):
    return int(x) * 256 if abs(x) >= 2**53 else math.floor(x * 256)


def brute(rows, dims):
    kept = [(i, [floor256(x) for x in v] + [0] * (dims - len(v)), label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    w, lowest = dims // A.PARTS, {}
    for i, v, _ in kept:
        lowest[i] = min(lowest.get(i, v), v)
    start = [v for _, v in sorted(lowest.items(), key=lambda r: (r[0] is None, r[0] or 0))[:A.ENTRIES]]
    books = [[v[p * w:(p + 1) * w] for v in start] for p in range(A.PARTS)]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda v, p: min(range(len(books[p])), key=lambda e: gap(v[p * w:(p + 1) * w], books[p][e]))
    for _ in range(A.LLOYD):
        new = []
        for p in range(A.PARTS):
            owned = {}
            for _, v, _ in kept:
                owned.setdefault(near(v, p), []).append(v[p * w:(p + 1) * w])
            new.append([[sum(c) // len(owned[e]) for c in zip(*owned[e], strict=True)] if e in owned else old for e, old in enumerate(books[p])])
        books = new
    out, by_label = [], {}
    for i, v, label in kept:
        code = [near(v, p) for p in range(A.PARTS)]
        error = sum(gap(v[p * w:(p + 1) * w], books[p][e]) for p, e in enumerate(code))
        by_label[label] = by_label.get(label, 0) + error
        out.append((i, bytes(code).hex(), min(error, 2**63 - 1), label))
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, c, e, min(by_label[label], 2**63 - 1), sha) for i, c, e, label in out), key=str)


def run(spark, rows):
    return sorted((tuple(r) for r in A.compress(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)


def vectors(n, dims, seed, spread=1.0):
    r = random.Random(seed)
    return [(i, [r.gauss(r.choice([-1, 0, 1]), 0.2) * spread for _ in range(dims)], r.choice([0, 1, None])) for i in range(n)]


def test_equals_brute_force(spark):
    rows = vectors(400, 32, 1)
    random.Random(2).shuffle(rows)
    assert run(spark, rows) == brute(rows, 32)


def test_awkward_rows(spark):
    rows = vectors(90, 32, 3)
    rows += [rows[4], rows[4], (4, rows[5][1], 7), (None, rows[6][1], None), (500, None, 1), (501, [None] + [0.5] * 31, 1), (502, [float("nan")] * 32, 1),
             (503, [float("inf")] * 32, 1), (504, [0.25] * 20, 1), (505, [], None), (-3, [0.0] * 32, 0), (506, [0.0] * 32, 0)]
    assert run(spark, rows) == brute(rows, 32)
    assert run(spark, []) == []
    assert run(spark, rows[:3]) == brute(rows[:3], 32)
    extra = spark.createDataFrame(rows[:40], SCHEMA).selectExpr("*", "1 as code", "'x' as error", "2 as part", "3 as key", "4 as vector")
    assert sorted((tuple(r) for r in A.compress(extra).collect()), key=str) == brute(rows[:40], 32)


def test_huge_components(spark):
    rows = vectors(80, 16, 5, spread=3e9) + [(900, [1e12] * 16, 3), (901, [-1e12] * 16, 3)]
    assert run(spark, rows) == brute(rows, 16)
    assert all(r[2] >= 0 for r in run(spark, [*rows, (902, [1e300] * 16, 3), (903, [-1e300] * 16, 3)]))


@pytest.mark.parametrize("n", [1, 2, 65, 700, 3000])
def test_trees_equal_all_comparisons(n):
    r = np.random.default_rng(n)
    x = r.integers(-40, 40, (n, 4)) * (1 if n != 700 else 0) + r.integers(0, 3, (n, 4)) * 100
    tree, order = A.build(x)
    assert sorted(order.tolist()) == list(range(n))
    todo = [tree]
    while todo:                     # cached sums and ranges
        ball = todo.pop()
        points = x[order[ball.first:ball.last]]
        assert (points.sum(axis=0) == ball.total).all()
        assert np.sqrt(((points - ball.pivot) ** 2).sum(axis=1)).max() <= ball.radius + 1e-9
        todo += ball.kids
    book = np.concatenate([x[:20], x[:20], r.integers(-40, 300, (24, 4))])   # equal entries: ties
    entry = np.zeros(n, np.int64)
    sums, held = A.owners(tree, x[order], book, entry)
    want = A.gaps(x[order], book).argmin(axis=1)
    assert (entry == want).all() and (held == np.bincount(want, minlength=len(book))).all()
    for e in range(len(book)):
        assert (sums[e] == x[order][want == e].sum(axis=0)).all()
