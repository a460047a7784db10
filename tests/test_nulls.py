"""Null keys and scores count like others, whatever the number of tasks."""

import math

import pytest
from pyspark.sql import functions as F
from strataflow.operators import explore as EX
from strataflow.operators import metrics as ME
from strataflow.operators import sampling as SA
from strataflow.sources.trips import _agreeing, _root, read_trips


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


@pytest.fixture(scope="module")
def scored(spark):
    data = [(None if i % 7 == 0 else float("nan") if i % 11 == 0 else float(i % 13), float(i % 2 or i % 7 == 0), "g" if i % 3 else None) for i in range(200)]
    return spark.createDataFrame(data, "score double, label double, g string")


def test_roc_with_null_scores(scored):
    whole, cut = ME.roc_curve(scored), ME.roc_curve(scored, rows_per_task=3)
    assert str(rows(whole, "score", "tp", "fp", "tpr")) == str(rows(cut, "score", "tp", "fp", "tpr"))
    assert cut.agg(F.max("tp")).first()[0] == scored.where("label = 1").count()
    assert ME.auc_from_roc(whole).first()[0] == pytest.approx(ME.auc_from_roc(cut).first()[0], abs=1e-12)


def test_quantiles_with_null_groups(scored):
    df = scored.where("score is not null and not isnan(score)")
    whole, cut = EX.quantiles(df, ["score"], by=["g"]), EX.quantiles(df, ["score"], by=["g"], rows_per_task=2)
    assert rows(whole, *whole.columns) == rows(cut, *cut.columns)
    assert {r["g"] for r in cut.collect()} == {"g", None}


def test_box_keeps_null_groups_and_clamps_whiskers(spark):
    df = spark.createDataFrame([(None, float(v)) for v in (0, 0, 0, 10)] + [("a", float(v)) for v in range(9)], "g string, x double")
    got = {r["g"]: r for r in EX.box_stats(df, "g", ["x"], clip_q=None).collect()}
    assert set(got) == {None, "a"} and got[None]["q3"] == 2.5 and got[None]["whisker_hi"] == 2.5 and got["a"]["whisker_hi"] == 8


def test_confusion_matrix_keeps_every_row(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 2.0), (1.0, None)], "label double, prediction double")
    got = [r.asDict() for r in ME.confusion_matrix(df).collect()]
    assert sum(v for r in got for k, v in r.items() if k != "label") == 3 and "pred_2" in got[0] and "pred_null" in got[0]


def test_exact_sample_with_null_stratum_and_stale_counts(spark):
    df = spark.range(300).select(F.col("id").alias("event_id"), F.when(F.col("id") % 3 > 0, F.lit("s")).alias("stratum"))
    out = SA.stratified_exact(df, 30)
    assert {r["stratum"]: r["count"] for r in out.groupBy("stratum").count().collect()} == {None: 10, "s": 20}
    stale = SA.stratified_exact(df, 600, counts={"s": 900, None: 300})
    assert stale.count() == 300


def test_kde_error_does_not_grow_with_a_tiny_bandwidth(spark):
    values = [float(v) for v in range(0, 40)] + [199.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    h = 0.01
    for r in EX.kde(df, "x", grid_points=200, bandwidth=h).collect():
        direct = sum(math.exp(-0.5 * ((r["x"] - v) / h) ** 2) for v in values) / (len(values) * h * math.sqrt(2 * math.pi))
        assert r["density"] == pytest.approx(direct, rel=1e-2, abs=1e-9)


def test_empty_density_grid_has_its_columns(spark):
    df = spark.createDataFrame([], "x double, y double, g string")
    assert EX.density_grid(df, "x", "y", by=["g"]).columns == ["g", "x_bin", "y_bin", "n"]


def test_row_key_keeps_the_whole_path(spark, tmp_path):
    for year in (2023, 2024):
        spark.range(3).select(F.col("id").cast("int").alias("VendorID")).coalesce(1).write.parquet(f"{tmp_path}/year={year}/month=01")
    keys = read_trips(spark, [f"{tmp_path}/year=2023/month=01", f"{tmp_path}/year=2024/month=01"], key_col="k")
    assert keys.select("k").distinct().count() == 6
    assert _root(["gs://b/a/x.parquet", "gs://b/a/y.parquet"]) == "/a" and _root(["/a/b", "/a/c/d"]) == "/a"


def test_footers_are_grouped_without_a_job_per_file(spark, tmp_path):
    paths = []
    for i in range(6):
        kind = "double" if i in (2, 3) else "long"
        spark.range(2).select(F.col("id").cast(kind).alias("v")).coalesce(1).write.parquet(f"{tmp_path}/{i}")
        paths.append(f"{tmp_path}/{i}")
    files = sorted(spark.read.parquet(paths[0]).inputFiles() + [f for p in paths[1:] for f in spark.read.parquet(p).inputFiles()])
    groups = _agreeing(spark, files)
    assert sorted(f for _, g in groups for f in g) == files and len({s.json() for s, _ in groups}) == 2


def test_quantiles_by_brackets_equal_all_distinct_values(spark, monkeypatch):
    from strataflow.operators import prefix as P
    df = spark.range(5000).select((F.col("id") * 7919 % 5000 / 7).alias("x"), F.when(F.col("id") % 3 > 0, F.col("id") % 2).alias("g"))
    probs = (0.0, 0.1, 0.25, 0.26, 0.5, 0.99, 1.0)
    want = rows(EX.quantiles(df, ["x"], probs, by=["g"]), "g", "q", "value")
    for accuracy in (20, 3):   # wide brackets; and sketches so coarse that a rank may be missed
        monkeypatch.setattr(P, "SKETCH", accuracy)
        assert rows(EX.quantiles(df, ["x"], probs, by=["g"]), "g", "q", "value") == want
    distinct = P.stack(df, ["x"], keep=["g"]).groupBy("g", "column_name", "value").agg(F.count(F.lit(1)).alias("_c"))
    assert rows(P.quantiles_from_counts(distinct, probs, ["g", "column_name"]), "g", "q", "value") == want
