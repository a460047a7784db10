from strataflow.plans.study import run_study
from strataflow.sources.events import load_trips


def test_study_end_to_end(spark, sf001):
    res = run_study(load_trips(spark, sf001), n_sample=500, ks=range(2, 4), trees=10, depth=4)
    s = res.scalars
    assert 0 <= s["auc"] <= 1 and 0 <= s["weighted_f1"] <= 1
    assert s["best_k"] in (2, 3)
    assert res.tables["strata"].count() == 11
    assert res.tables["feature_importance"].count() == 16
    assert res.tables["kmeans_sweep"].count() == 2
    assert res.tables["box_stats"].count() > 0


def test_study_cli_on_mixed_monthly_files(spark, sf001, capsys):
    import tempfile

    from pyspark.sql import functions as F

    from strataflow.plans.study import main
    from strataflow.sources.schema import TRIP_COLUMNS

    trips = load_trips(spark, sf001).select(*TRIP_COLUMNS)
    base = tempfile.mkdtemp(prefix="strataflow-months-")
    jan, feb = trips.randomSplit([0.5, 0.5], 3)
    # January stores the counts as INT64, February as DOUBLE, like the real monthly files
    jan.withColumn("passenger_count", F.col("passenger_count").cast("long")) \
       .withColumn("RatecodeID", F.col("RatecodeID").cast("long")) \
       .coalesce(1).write.parquet(f"{base}/yellow_tripdata_2024-01.parquet")
    feb.coalesce(1).write.parquet(f"{base}/yellow_tripdata_2024-02.parquet")
    out_dir = tempfile.mkdtemp(prefix="strataflow-out-")
    main([base, "--months", "1-2", "--sample", "400", "--out", out_dir])
    out = capsys.readouterr().out
    assert "== silver_funnel" in out and "== kmeans_sweep" in out and '"auc"' in out
    assert spark.read.parquet(f"{out_dir}/strata").count() == 11


def test_study_exact_sample(spark, sf001):
    res = run_study(load_trips(spark, sf001), n_sample=300, exact_sample=True, ks=range(2, 3), trees=5, depth=3)
    v = res.tables["sample_validation"].collect()
    assert sum(r["n_sample"] for r in v) == 300
    assert res.scalars["max_abs_err"] < 0.01


def test_study_describes_all_prepared_rows(spark, sf001):
    from pyspark.sql import functions as F

    from strataflow.operators import features as FE
    from strataflow.operators import quality as Q
    from strataflow.operators import strata as ST

    trips = load_trips(spark, sf001)
    n = FE.prepared(ST.with_strata(Q.silver(trips, Q.silver_rules(2024)))).count()
    res = run_study(trips, n_sample=300, ks=range(2, 3), trees=5, depth=3)
    assert n > 600 and res.scalars["n_prepared"] == n
    assert res.tables["cluster_profile"].agg(F.sum("n")).first()[0] == n
    tested = res.tables["confusion_matrix"].agg(F.sum(F.col("pred_0") + F.col("pred_1"))).first()[0]
    assert tested > 600 * 0.3 and abs(tested / n - 0.3) < 0.1
