from pyspark.sql import functions as F

from strataflow.operators import quality as Q
from strataflow.operators.features import check_no_leakage, prepared
from strataflow.operators.strata import strata_counts, with_strata
from strataflow.sources.events import load_trips
from strataflow.sources.schema import TRIP_SCHEMA

import pytest


@pytest.mark.parametrize("sf,rows,silver_n,prepared_n,strata", [
    ("/root/testdata/sf0.001", 1000, 881, 771, 11),
    ("/root/testdata/sf0.01", 10000, 8845, 7725, 12),
])
def test_fixture_funnel(spark, sf, rows, silver_n, prepared_n, strata):
    trips = load_trips(spark, sf)
    f = Q.rule_funnel(trips).first()
    assert (f["rows_in"], f["rows_kept"]) == (rows, silver_n)
    s = with_strata(Q.silver(trips))
    assert strata_counts(s).count() == strata
    assert prepared(s).count() == prepared_n


def test_null_semantics(spark):
    rows = [(None, 1.0, None), (5.0, 1.0, None), (5.0, 1.0, 99.0), (5.0, None, 1.0)]
    df = spark.createDataFrame(rows, "fare_amount double, trip_distance double, RatecodeID double")
    rules = {k: v for k, v in Q.silver_rules().items()
             if k in ("fare_positive", "distance_positive", "ratecode_not_99")}
    kept = Q.apply_rules(df, rules).collect()
    assert len(kept) == 1 and kept[0]["RatecodeID"] is None
    rej = {r["rule"]: r["rejected"] for r in Q.rule_rejects(df, rules).collect()}
    assert rej == {"fare_positive": 1, "distance_positive": 1, "ratecode_not_99": 1}


def test_funnel_empty(spark):
    f = Q.rule_funnel(spark.createDataFrame([], TRIP_SCHEMA)).first()
    assert f["rows_in"] == 0 and f["rows_kept"] == 0 and f["discarded_pct"] is None


def test_null_profile_all_null_column(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b double")
    got = [(r[0], r[1]) for r in Q.null_profile(df).collect()]
    assert got == [("b", 1.0), ("a", 0.5)]


def test_passenger_rule_after_fill(spark):
    df = spark.createDataFrame([(None,), (0.0,), (3.0,), (7.0,)], "passenger_count double")
    from strataflow.operators.features import impute
    kept = Q.apply_rules(impute(df, {"passenger_count": 1.0}),
                         {"p": F.col("passenger_count").between(1, 6)}).collect()
    assert sorted(r[0] for r in kept) == [1.0, 3.0]


def test_leakage_guard():
    with pytest.raises(ValueError):
        check_no_leakage(["fare_amount", "tip_amount"])
    check_no_leakage(["fare_amount"])


def test_population_summary_matches_direct_reports(spark, sf01):
    from pyspark.sql import functions as F

    from strataflow.functions.trip_columns import day_type, pay_class, pickup_zone
    from strataflow.sources.schema import TRIP_COLUMNS
    trips = load_trips(spark, sf01)
    key = F.concat_ws("|", day_type(), pickup_zone(), pay_class())
    summary, cols, names = Q.population_summary(trips, Q.silver_rules(), key, TRIP_COLUMNS)
    summary = summary.cache()
    assert summary.count() <= 13
    assert Q.null_profile_from_summary(summary, cols).collect() == \
        Q.null_profile(trips.select(*TRIP_COLUMNS)).collect()
    assert Q.funnel_from_summary(summary).collect() == Q.rule_funnel(trips).collect()
    assert Q.rejects_from_summary(summary, names).collect() == Q.rule_rejects(trips).collect()
    direct = {r["stratum"]: r["n"] for r in strata_counts(with_strata(Q.silver(trips))).collect()}
    assert {r["stratum"]: r["n"] for r in Q.strata_from_summary(summary).collect()} == direct
