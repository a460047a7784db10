import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from strataflow.operators import explore as EX
from strataflow.operators.prefix import running_sums


def _frame(spark, n=3000, seed=1):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, n).astype("int32"),
                        "x": np.round(rng.exponential(3.0, n), 1),   # many ties
                        "y": rng.normal(0, 1, n)})
    return spark.createDataFrame(pdf), pdf


def test_exact_quantiles_match_numpy(spark):
    df, pdf = _frame(spark)
    probs = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]
    for rpt in (1_000_000, 97):  # single bucket, and many buckets
        got = {(r["column_name"], r["q"]): r["value"] for r in
               EX.quantiles(df, ["x", "y"], probs, rows_per_task=rpt).collect()}
        for c in ("x", "y"):
            for q in probs:
                assert abs(got[(c, q)] - np.quantile(pdf[c], q)) < 1e-9


def test_grouped_quantiles(spark):
    df, pdf = _frame(spark)
    got = EX.quantiles(df, ["x"], [0.5], by=["g"], rows_per_task=50).collect()
    for r in got:
        assert abs(r["value"] - pdf[pdf.g == r["g"]].x.median()) < 1e-9


def test_approx_quantiles_close(spark):
    df, pdf = _frame(spark)
    got = {r["q"]: r["value"] for r in EX.quantiles(df, ["y"], [0.5, 0.9], exact=False).collect()}
    assert abs(got[0.5] - np.quantile(pdf.y, 0.5)) < 0.05


def test_running_sums_buckets_agree(spark):
    df = spark.range(0, 5000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    a = {r["k"]: r["cum_v"] for r in running_sums(df, "k", ["v"]).collect()}
    b = {r["k"]: r["cum_v"] for r in running_sums(df, "k", ["v"], rows_per_task=333).collect()}
    c = {r["k"]: r["cum_v"] for r in running_sums(df, "k", ["v"], descending=True, rows_per_task=333).collect()}
    assert a == b
    assert a[4999] == c[0] == sum(i % 7 for i in range(5000))


def test_histogram_counts(spark):
    df, pdf = _frame(spark)
    h = EX.histogram(df, ["y"], bins=40).toPandas()
    assert h.n.sum() == len(pdf) and h.bin.max() == 39 and h.bin.min() == 0
    counts, _ = np.histogram(pdf.y, bins=40)
    assert list(h.sort_values("bin").n) == [c for c in counts if c]


def test_kde_integrates_to_one(spark):
    df, pdf = _frame(spark)
    k = EX.kde(df, "y", grid_points=400).toPandas()
    assert abs(np.trapezoid(k.density, k.x) - 1) < 0.02
    h = pdf.y.std() * len(pdf) ** -0.2
    exact = np.exp(-0.5 * ((k.x.values[:, None] - pdf.y.values[None, :]) / h) ** 2).sum(1) / (len(pdf) * h * np.sqrt(2 * np.pi))
    assert np.max(np.abs(exact - k.density.values)) < 0.01


def test_correlation_constant_column_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.1, 5.0), (3.0, 5.9, 5.0)], "a double, b double, c double")
    m = {(r["col_a"], r["col_b"]): r["r"] for r in EX.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert m[("a", "c")] is None and m[("c", "c")] is None and m[("a", "a")] == 1.0
    assert abs(m[("a", "b")] - np.corrcoef([1, 2, 3], [2, 4.1, 5.9])[0, 1]) < 1e-12


def test_box_stats_match_pandas(spark):
    df, pdf = _frame(spark)
    got = {(r["g"], r["column_name"]): r for r in EX.box_stats(df, "g", ["x"], clip_q=0.99).collect()}
    cut = pdf.x.quantile(0.99)
    for g, part in pdf[pdf.x < cut].groupby("g"):
        q1, med, q3 = part.x.quantile([0.25, 0.5, 0.75])
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = part.x[(part.x >= lo) & (part.x <= hi)]
        r = got[(g, "x")]
        assert abs(r["median"] - med) < 1e-9 and r["n"] == len(part)
        assert r["whisker_hi"] == inside.max() and r["n_outliers"] == len(part) - len(inside)


def test_group_share_and_zscores(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "x"), ("b", "y")], "zone string, cls string")
    s = {(r[0], r[1]): r["share"] for r in EX.group_share(df, "zone", "cls").collect()}
    assert abs(s[("a", "x")] - 2 / 3) < 1e-12 and s[("b", "y")] == 1.0
    m = spark.createDataFrame([(0, 1.0), (1, 3.0)], "prediction int, v double")
    z = {r["prediction"]: r["z"] for r in EX.cluster_zscores(m, ["v"]).collect()}
    assert z == {0: -1.0, 1: 1.0}


def test_join_summary_both_paths(spark):
    from strataflow.operators.joins import join_summary
    big = spark.range(0, 1000).select((F.col("id") % 3).alias("g"), F.col("id"))
    small = big.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    a = join_summary(big, small, ["g"])                          # broadcast path
    b = join_summary(big, small, ["g"], max_broadcast_bytes=0)    # shuffle-join fallback
    assert "BroadcastHashJoin" in a._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_box_stats_approx_and_grouped_approx_quantiles(spark):
    df, pdf = _frame(spark)
    ex = {(r["g"], r["column_name"]): r["median"] for r in EX.box_stats(df, "g", ["y"], clip_q=None).collect()}
    ap = {(r["g"], r["column_name"]): r["median"] for r in
          EX.box_stats(df, "g", ["y"], clip_q=None, exact=False).collect()}
    assert ex.keys() == ap.keys() and all(abs(ex[k] - ap[k]) < 0.05 for k in ex)
    q = EX.quantiles(df, ["y"], [0.5], by=["g"], exact=False).collect()
    assert len(q) == 3
