import numpy as np
import pytest
from pyspark.ml.evaluation import (BinaryClassificationEvaluator, ClusteringEvaluator,
                                   MulticlassClassificationEvaluator)
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from strataflow.functions.hashing import uniform
from strataflow.operators import metrics as ME


@pytest.fixture(scope="module")
def scored(spark):
    df = spark.range(0, 4000).select(
        "id", F.round(uniform("id", "s"), 2).alias("score"),
        (uniform("id", "l") < (F.round(uniform("id", "s"), 2) * 0.6 + 0.2)).cast("double").alias("label"))
    return df.withColumn("prediction", (F.col("score") >= 0.5).cast("double")).cache()


def test_auc_matches_mllib_exact(spark, scored):
    from pyspark.ml.functions import array_to_vector
    mine = ME.auc(scored, "score", "label", 1.0)
    raw = scored.withColumn("raw", array_to_vector(F.array(F.lit(1.0) - F.col("score"), F.col("score"))))
    ref = BinaryClassificationEvaluator(rawPredictionCol="raw", labelCol="label", numBins=0).evaluate(raw)
    assert abs(mine - ref) < 1e-9 and mine > 0.6


def test_auc_reversed_is_complement(spark, scored):
    a = ME.auc(scored, "score", "label", 1.0)
    b = ME.auc(scored.withColumn("score", -F.col("score")), "score", "label", 1.0)
    assert abs(a + b - 1.0) < 1e-12


def test_roc_bucketed_equals_single(spark, scored):
    a = ME.roc_curve(scored, "score", "label", 1.0).orderBy("score").collect()
    b = ME.roc_curve(scored, "score", "label", 1.0, rows_per_task=7).orderBy("score").collect()
    assert a == b and a[0]["tpr"] == 1.0 and a[0]["fpr"] == 1.0


def test_classification_metrics_match_mllib(spark, scored):
    m = ME.classification_metrics(scored).first()
    for name, key in (("accuracy", "accuracy"), ("f1", "weighted_f1"),
                      ("weightedPrecision", "weighted_precision"), ("weightedRecall", "weighted_recall")):
        ref = MulticlassClassificationEvaluator(labelCol="label", metricName=name).evaluate(scored)
        assert abs(ref - m[key]) < 1e-12


def test_confusion_keeps_unpredicted_class(spark, scored):
    one = scored.withColumn("prediction", F.lit(0.0))
    cm = ME.confusion_matrix(one).collect()
    assert [c for c in cm[0].asDict()] == ["label", "pred_0", "pred_1"]
    assert all(r["pred_1"] == 0 for r in cm)


def test_silhouette_matches_mllib(spark):
    rng = np.random.default_rng(3)
    pts = np.vstack([rng.normal(0, 1, (300, 3)), rng.normal(4, 1, (200, 3))])
    df = spark.createDataFrame([(float(a), float(b), float(c), int(i >= 300)) for i, (a, b, c) in enumerate(pts)],
                               "a double, b double, c double, prediction int")
    mine = ME.silhouette(df, ["a", "b", "c"]).first()[0]
    vec = VectorAssembler(inputCols=["a", "b", "c"], outputCol="f").transform(df)
    ref = ClusteringEvaluator(featuresCol="f", predictionCol="prediction").evaluate(vec)
    assert abs(mine - ref) < 1e-9 and -1 <= mine <= 1
    w = ME.wssse(df, ["a", "b", "c"]).first()[0]
    expect = sum(((pts[lab] - pts[lab].mean(0)) ** 2).sum() for lab in (slice(0, 300), slice(300, 500)))
    assert abs(w - expect) < 1e-6


def test_silhouette_single_cluster_is_null(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 0)], "a double, prediction int")
    assert ME.silhouette(df, ["a"]).first()[0] is None


def test_roc_area_and_points_of_any_scores(spark):
    import math
    import random

    r = random.Random(4)
    rows = [(round(r.gauss(0, 1), r.choice([1, 9])), float(r.random() < 0.4)) for _ in range(700)] + [(None, 1.0), (None, 0.0), (math.nan, 1.0), (1e9, 0.0)]
    df = spark.createDataFrame(rows, "score double, label double")
    rank = lambda s: (0, 0.0) if s is None else (2, 0.0) if math.isnan(s) else (1, s)
    pos, neg = [rank(s) for s, y in rows if y], [rank(s) for s, y in rows if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    for bins in (1, 7, 1 << 14):
        assert abs(ME.roc_area(df, bins=bins).first()["auc"] - want) < 1e-12
    points = ME.roc_points(df.where("score < 100"), points=10).collect()
    assert len(points) <= 11
    for p in points:
        held = [y for s, y in rows if s is not None and s < 100 and s >= p["threshold"] - 1e-12]
        assert (p["tp"], p["fp"]) == (sum(held), len(held) - sum(held))
    assert ME.roc_area(df.where("label = 1")).first()["auc"] is None and ME.roc_area(df.limit(0)).first()["auc"] is None
    assert ME.roc_points(df.limit(0)).collect() == []
