"""Edge cases: empty input, one class, constant and all-null columns."""

from pyspark.sql import functions as F

from strataflow.operators import explore as EX
from strataflow.operators import metrics as ME
from strataflow.operators import quality as Q
from strataflow.operators import sampling as SA


def _empty(spark):
    return spark.createDataFrame([], "event_id long, stratum string, x double, y double, g int")


def test_empty_inputs(spark):
    e = _empty(spark)
    assert EX.quantiles(e, ["x"], [0.5]).count() == 0
    assert EX.histogram(e, ["x", "y"]).count() == 0
    assert EX.kde(e, "x").count() == 0
    assert EX.density_grid(e, "x", "y").count() == 0
    assert EX.box_stats(e, "g", ["x"]).count() == 0
    assert EX.quantile_clip(e, ["x"]).count() == 0
    d = Q.describe_long(e, ["x"]).first()
    assert d["count"] == 0 and d["mean"] is None
    assert SA.stratified_exact(e, 10, key="stratum").count() == 0
    assert SA.sample_to(e, 10).count() == 0
    assert SA.stratified_sample(e, n=10).count() == 0
    v = SA.sample_validation(e, e, key="stratum")
    assert v.count() == 0 and SA.max_deviation(v).first()[0] is None


def test_one_class(spark):
    df = spark.createDataFrame([(0.2, 1.0, 1.0), (0.7, 1.0, 1.0), (0.9, 1.0, 0.0)],
                               "score double, label double, prediction double")
    roc = ME.roc_curve(df, "score", "label", 1.0).collect()
    assert all(r["fpr"] is None for r in roc) and max(r["tpr"] for r in roc) == 1.0
    assert ME.auc(df, "score", "label", 1.0) is None
    m = ME.classification_metrics(df).first()
    assert abs(m["accuracy"] - 2 / 3) < 1e-12
    cm = ME.confusion_matrix(df).collect()
    assert len(cm) == 1 and cm[0]["pred_0"] == 1 and cm[0]["pred_1"] == 2


def test_constant_and_null_columns(spark):
    df = spark.createDataFrame([(1.0, None), (1.0, None), (1.0, None)], "c double, n double")
    h = EX.histogram(df, ["c", "n"]).collect()
    assert [(r["column_name"], r["bin"], r["n"]) for r in h] == [("c", 0, 3)]
    q = EX.quantiles(df, ["c", "n"], [0.5]).collect()
    assert [(r["column_name"], r["value"]) for r in q] == [("c", 1.0)]
    assert EX.kde(df, "c").count() == 0
    z = EX.cluster_zscores(spark.createDataFrame([(0, 2.0), (1, 2.0)], "prediction int, v double"), ["v"])
    assert all(r["z"] is None for r in z.collect())


def test_random_score_auc_near_half(spark, sf01):
    from strataflow.functions.hashing import uniform
    from strataflow.plans.catalog import prepared_trips
    df = prepared_trips(spark, sf01).select(
        uniform("event_id", "noise").alias("score"), (F.col("pay_class") == "card").cast("double").alias("label"))
    assert abs(ME.auc(df, "score", "label", 1.0) - 0.5) < 0.03
