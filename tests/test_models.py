import pytest
from pyspark.sql import functions as F

from strataflow.functions import constants as C
from strataflow.operators import metrics as ME
from strataflow.operators import models as MO
from strataflow.operators.features import fit_scaler
from strataflow.operators.sampling import split
from strataflow.plans.catalog import prepared_trips


@pytest.fixture(scope="module")
def data(spark, sf01):
    return prepared_trips(spark, sf01).cache()


def test_forest_learns_planted_signal(spark, data):
    train, test = split(data, (0.7, 0.3))
    model = MO.fit_forest(train, trees=30, depth=6)
    pred = MO.score(model, test).cache()
    pos = float(MO.positive_index(model))
    auc = ME.auc(pred, "prob_positive", "label", pos)
    assert auc > 0.7
    imp = MO.feature_importance(model, pred).collect()
    assert len(imp) == 16 and abs(sum(r["importance"] for r in imp) - 1) < 1e-9
    assert {r["feature"] for r in imp} >= {"fare_amount", "pickup_zone_ohe_airport"}


def test_forest_refuses_leaky_features(data):
    with pytest.raises(ValueError):
        MO.fit_forest(data, numeric=list(C.NUMERIC_FEATURES) + ["tip_amount"])


def test_kmeans_sweep(spark, data):
    scaled = fit_scaler(data).transform(data).select("features_scaled").cache()
    table, model, k = MO.kmeans_sweep(scaled, ks=range(2, 5), dims=5)
    rows = table.collect()
    assert [r["k"] for r in rows] == [2, 3, 4]
    assert all(-1 <= r["silhouette"] <= 1 for r in rows)
    best = max(rows, key=lambda r: r["silhouette"])
    assert k == best["k"] and model.getK() == k
    assert all(r["wssse"] > 0 for r in rows)
    assert F is not None


def test_kmeans_sweep_picks_two_on_fixture(spark, sf01):
    """The study's own self-check: the silhouette sweep picks k = 2."""
    from strataflow.plans.catalog import sweep
    _, (table, _, best) = sweep(spark, sf01)
    rows = {r["k"]: r["silhouette"] for r in table.collect()}
    assert best == max(rows, key=rows.get) == 2 and 0.4 < rows[2] < 0.5
