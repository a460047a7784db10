"""Regression, Bayes, tree and mixture fits against plain numpy versions and MLlib, and their awkward inputs."""

import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression, LinearRegression
from pyspark.sql import functions as F

from strataflow.operators import glm as G
from strataflow.operators import mixtures as MX
from strataflow.operators import naive_bayes as NB
from strataflow.operators import trees as T


@pytest.fixture(scope="module")
def frame(spark):
    r = np.random.default_rng(4)
    a, b = r.normal(2, 1, 400), r.normal(0, 3, 400)
    c = r.choice(["x", "y", "z"], 400)
    y = 1 + 2 * a - 0.5 * b + (c == "y") * 3 + r.normal(0, 0.3, 400)
    p = 1 / (1 + np.exp(-(a - 2 + b)))
    rows = [(int(i), float(a[i]), float(b[i]), str(c[i]), float(y[i]), float(r.random() < p[i]), float(r.poisson(math.exp(0.3 * a[i])))) for i in range(400)]
    return spark.createDataFrame(rows, "id long, a double, b double, c string, y double, hit double, calls double").repartition(3).cache()


def xs(extra=()):
    return {"a": F.col("a"), "b": F.col("b")} | {n: F.col(n) for n in extra}


def test_least_squares_equals_mllib_and_numpy(frame):
    x = xs() | G.dummies("c", ["y", "z"])
    model = G.fit(frame, F.col("y"), x)
    rows = frame.toPandas()
    design = np.column_stack([np.ones(400), rows["a"], rows["b"], rows["c"] == "y", rows["c"] == "z"]).astype(float)
    assert np.allclose(model.coefficients, np.linalg.lstsq(design, rows["y"], rcond=None)[0])
    left = rows["y"] - design @ model.coefficients
    errors = np.sqrt(np.diag(np.linalg.inv(design.T @ design)) * (left @ left) / (400 - 5))
    assert np.allclose(model.errors(), errors) and np.allclose(model.gradient, 0, atol=1e-8)
    vec = VectorAssembler(inputCols=["a", "b"], outputCol="v").transform(frame)
    ml = LinearRegression(featuresCol="v", labelCol="y", regParam=0.0).fit(vec)
    assert np.allclose(G.fit(frame, F.col("y"), xs()).coefficients, [ml.intercept, *ml.coefficients], atol=1e-6)
    report = G.regression_report(frame, G.fit(frame, F.col("y"), xs()), F.col("y"), xs()).first()
    assert report["n"] == 400 and math.isclose(report["r2"], ml.summary.r2, rel_tol=1e-6) and math.isclose(report["rmse"], ml.summary.rootMeanSquaredError, rel_tol=1e-6)


@pytest.mark.parametrize("family, y, ml_family", [(G.BINOMIAL, "hit", "binomial"), (G.POISSON, "calls", "poisson")])
def test_families_equal_mllib(frame, family, y, ml_family):
    model = G.fit(frame, F.col(y), xs(), family)
    vec = VectorAssembler(inputCols=["a", "b"], outputCol="v").transform(frame)
    ml = GeneralizedLinearRegression(family=ml_family, featuresCol="v", labelCol=y, maxIter=50, tol=1e-10).fit(vec)
    assert np.allclose(model.coefficients, [ml.intercept, *ml.coefficients], atol=1e-5)
    assert math.isclose(model.deviance, ml.summary.deviance, rel_tol=1e-8)
    falls = [d for _, d in model.rounds]
    assert all(b <= a * (1 + 1e-12) for a, b in zip(falls, falls[1:], strict=False))


def test_gamma_score_equations_vanish(frame):
    positive = frame.withColumn("t", F.exp(F.col("y") / 4) + 0.1)
    model = G.fit(positive, F.col("t"), xs(), G.GAMMA)
    mu = G.scored(positive, model, xs())
    for term in (F.lit(1.0), F.col("a"), F.col("b")):
        assert abs(mu.agg(F.sum((F.col("t") - F.col("mu")) / F.col("mu") * term)).first()[0]) < 1e-5
    assert model.total > model.deviance


def test_ridge_shrinks_and_separated_classes_stay_finite(frame):
    plain, ridged = G.fit(frame, F.col("hit"), xs(), G.BINOMIAL), G.fit(frame, F.col("hit"), xs(), G.BINOMIAL, ridge=0.5)
    assert np.abs(ridged.coefficients[1:]).sum() < np.abs(plain.coefficients[1:]).sum()
    split = frame.withColumn("side", F.when(F.col("a") > 2, 1.0).otherwise(0.0))
    model = G.fit(split, F.col("side"), xs(), G.BINOMIAL, ridge=0.01)
    assert np.isfinite(model.coefficients).all()
    report = G.classifier_report(split, model, F.col("side"), xs()).first()
    assert report["tp"] + report["tn"] > 390 and report["tp"] + report["fp"] + report["tn"] + report["fn"] == 400


def test_regression_with_nulls_constants_and_no_rows(frame, spark):
    holes = frame.withColumn("a", F.when(F.col("id") % 5 != 0, F.col("a"))).withColumn("one", F.lit(1.0))
    x = xs(["one"])
    model = G.fit(holes, F.col("y"), x)      # the constant column is collinear with the intercept
    assert model.n == 320 and np.isfinite(model.coefficients).all() and math.isclose(model.coefficients[0], model.coefficients[3])
    assert G.scored(holes, model, x).where("mu is null").count() == 80
    with pytest.raises(ValueError):
        G.fit(frame.where("id < 0"), F.col("y"), xs())


def test_bayes_unseen_null_and_ties(spark):
    rows = spark.createDataFrame([("n", "u", 1.0), ("n", "u", 2.0), ("n", None, 3.0), ("p", "v", 5.0), ("p", "u", None), (None, "w", 9.0)], "label string, c string, x double")
    model = NB.fit(rows, "label", ["c"], ["x"])
    assert math.isclose(model.prior["n"], math.log(4 / 7)) and math.isclose(model.categories["c"]["n"]["v"], math.log(1 / 4))
    assert model.moments["x"]["n"] == (2.0, pytest.approx(2 / 3)) and model.moments["x"]["p"][1] == 1e-9
    new = spark.createDataFrame([("q", 2.0), (None, None), ("v", 5.0)], "c string, x double")
    got = NB.score(new, model, "p").collect()
    assert [r["prediction"] for r in got] == ["n", "n", "p"]
    assert math.isclose(got[1]["log_odds"], model.prior["p"] - model.prior["n"])
    same = NB.fit(rows.where("label is not null").limit(0).union(spark.createDataFrame([("a", "u", 0.0), ("b", "u", 0.0)], rows.schema)), "label", ["c"])
    assert NB.score(new, same, "b").select("prediction").distinct().collect()[0][0] == "a"
    assert NB.fit(rows.limit(0), "label", ["c"]).prior == {}


def plain_tree(b, y, depth, least, node=1):
    best = None
    if depth:
        for f in range(b.shape[1]):
            for at in sorted(set(b[:, f]))[:-1]:
                left = b[:, f] <= at
                if left.sum() >= least and (~left).sum() >= least:
                    gain = y.var() - (left.sum() * y[left].var() + (~left).sum() * y[~left].var()) / len(y)
                    if gain > 1e-12 and (best is None or round(gain, 9) > best[0]):
                        best = (round(gain, 9), f, at)
    if best is None:
        return {node: (None, None, len(y), y.mean())}
    left = b[:, best[1]] <= best[2]
    return {node: (best[1], best[2], len(y), y.mean())} | plain_tree(b[left], y[left], depth - 1, least, 2 * node) | plain_tree(b[~left], y[~left], depth - 1, least, 2 * node + 1)


def test_tree_equals_plain_search(frame):
    holes = frame.withColumn("a", F.when(F.col("id") % 9 != 0, F.col("a"))).withColumn("one", F.lit(1))
    bins = T.fit_bins(holes, ["a", "b", "one"], 16)
    rows = T.design(holes, F.col("y"), bins, ["id"])
    tree = T.grow(rows, bins, depth=3, least=15)
    local = rows.toPandas()
    want = plain_tree(local[["b0", "b1", "b2"]].to_numpy(), local["y"].to_numpy(), 3, 15)
    assert {k: (n.column, n.bin, n.n) for k, n in tree.nodes.items()} == {k: v[:3] for k, v in want.items()}
    assert all(math.isclose(n.value(), want[k][3]) for k, n in tree.nodes.items())
    leaves = {r["leaf"]: r["n"] for r in rows.groupBy(tree.leaf().alias("leaf")).agg(F.count(F.lit(1)).alias("n")).collect()}
    assert leaves == {k: n.n for k, n in tree.nodes.items() if n.column is None} and sum(leaves.values()) == 400
    assert local["b0"].min() == -1 and T.tree_table(rows, tree).count() == len(tree.nodes)


def test_boosting_lowers_the_loss_and_keeps_a_leaf_on_constant_columns(frame):
    bins = T.fit_bins(frame, ["a", "b"])
    model = T.boost(T.design(frame, F.col("hit"), bins), bins, rounds=4, depth=2, loss="logistic", least=10)
    values = [v for _, v in model.losses]
    assert all(b < a for a, b in zip(values, values[1:], strict=False)) and len(model.trees) == 4
    scored = T.design(frame, F.col("hit"), bins).select(model.predict().alias("p"), "y").toPandas()
    loss = -(scored["y"] * np.log(scored["p"]) + (1 - scored["y"]) * np.log(1 - scored["p"])).mean()
    assert math.isclose(loss, values[-1], rel_tol=1e-9)
    flat = T.fit_bins(frame.withColumn("one", F.lit(3.0)), ["one"])
    assert list(T.grow(T.design(frame.withColumn("one", F.lit(3.0)), F.col("y"), flat), flat).nodes) == [1]
    with pytest.raises(ValueError):
        T.boost(T.design(frame, F.lit(1.0), bins), bins, loss="logistic")


def test_bisection_partitions_every_parent(frame):
    rows, _ = MX.standardised(frame.withColumn("one", F.lit(2.0)), ["a", "b", "one"], ["id"])
    model = MX.bisect(rows, ["z0", "z1", "z2"], depth=3, rounds=8)
    local = rows.select("*", *[model.path(i).alias(f"at{i}") for i in range(4)]).toPandas()
    for k, c in model.nodes.items():
        level = k.bit_length() - 1
        own = local[local[f"at{level}"] == k]
        z = own[["z0", "z1", "z2"]].to_numpy()
        assert len(own) == c.n and math.isclose(((z - np.array(c.centre)) ** 2).sum(), c.cost, rel_tol=1e-9, abs_tol=1e-9)
        if c.kids:
            assert model.nodes[2 * k].n + model.nodes[2 * k + 1].n == c.n
            assert model.nodes[2 * k].cost + model.nodes[2 * k + 1].cost < c.cost
    same = rows.limit(1).select(F.lit(1.0).alias("z0"), F.explode(F.sequence(F.lit(1), F.lit(9))).alias("id"))
    assert list(MX.bisect(same, ["z0"]).nodes) == [1]      # no spread: the root stays a leaf
    with pytest.raises(ValueError):
        MX.bisect(rows.where("id < 0"), ["z0"])


def test_mixture_equals_plain_expectation_maximisation(spark):
    r = np.random.default_rng(9)
    x = np.concatenate([r.normal([0, 0, 0], 1, (150, 3)), r.normal([6, 5, -4], [1, 2, 0.5], (100, 3))])
    rows = spark.createDataFrame([tuple(map(float, v)) for v in x], "z0 double, z1 double, z2 double").repartition(4)
    model = MX.fit_mixture(rows, ["z0", "z1", "z2"], k=2, rounds=12, tolerance=-1.0)
    w = np.full(2, 0.5)
    c = np.cov(x.T, bias=True) + 1e-6 * np.eye(3)
    m, cs = np.array([x.mean(axis=0) + (2 * i - 1) / 2 * np.sqrt(np.diag(c)) for i in range(2)]), np.array([c, c])
    for _ in range(12):
        density = np.column_stack([w[i] * np.exp(-0.5 * np.einsum("ij,jk,ik->i", x - m[i], np.linalg.inv(cs[i]), x - m[i])) / np.sqrt((2 * np.pi) ** 3 * np.linalg.det(cs[i])) for i in range(2)])
        resp = density / density.sum(axis=1, keepdims=True)
        w = resp.mean(axis=0)
        m = (resp.T @ x) / resp.sum(axis=0)[:, None]
        cs = np.array([(x - m[i]).T @ ((x - m[i]) * resp[:, [i]]) / resp[:, i].sum() + 1e-6 * np.eye(3) for i in range(2)])
    assert np.allclose(model.weights, w) and np.allclose(model.means, m) and np.allclose(model.covariances, cs, atol=1e-6)
    gains = [v for _, v in model.rounds]
    assert all(b >= a - 1e-9 for a, b in zip(gains, gains[1:], strict=False))
    sums = model.respond(rows).agg(F.max(F.abs(F.col("r0") + F.col("r1") - 1))).first()[0]
    assert sums < 1e-12
    with pytest.raises(ValueError):
        MX.fit_mixture(rows.limit(0), ["z0"])
