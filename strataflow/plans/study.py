"""The whole study as one parameterised Spark job.

D (trip files) → null profile → Silver funnel → strata → sample M →
representativeness check → prepared D → describe / exploration statistics →
70/30 split → random forest (fitted on M's training part) → metrics, confusion,
importances, ROC of the whole test part → k-means sweep → cluster profile,
z-scores, box statistics.

Every result is a DataFrame (small: per stratum, per bin, per class, per k)
or a scalar; nothing proportional to D reaches the driver. D is read once
per action with filters and projections pushed into the scan; M is
checkpointed to the shared checkpoint folder before the model fits.

Command line (any Hadoop file-system URI)::

    python -m strataflow.plans.study gs://bucket/yellow/ --year 2024
"""

from __future__ import annotations

import argparse
import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions import trip_columns as TC
from ..operators import explore as EX
from ..operators import features as FE
from ..operators import metrics as ME
from ..operators import models as MO
from ..operators import quality as Q
from ..operators import sampling as SA
from ..operators import strata as ST
from ..session import checkpointed, get_spark, materialised
from ..sources.trips import month_paths, read_reconciled


#: Partitions of sample M: fixed, as the forest's bagging depends on them.
FIT_PARTITIONS = 8


@dataclass
class StudyResult:
    tables: dict[str, DataFrame] = field(default_factory=dict)
    scalars: dict[str, object] = field(default_factory=dict)


def run_study(trips: DataFrame, n_sample: int = 50_000, seed: int = 42, year: int = 2024,
              exact_sample: bool = False, ks=range(2, 8), trees: int = 60, depth: int = 8,
              row_key: str = "event_id") -> StudyResult:
    """Run every step of the study on a trip DataFrame with a row key column.

    Trip files have no key: read them with ``key_col`` (file name + row
    index, see ``sources.trips.file_row_key``), so sampling and splitting are
    reproducible.
    """
    r = StudyResult()
    rules = Q.silver_rules(year)
    # pass 1 over D: one aggregation (≤ strata + 1 rows, checkpointed) feeds the
    # null profile, the funnel, the per-rule rejections and the stratum counts
    key = F.concat_ws("|", TC.day_type(), TC.pickup_zone(), TC.pay_class())
    summary, cols, names = Q.population_summary(trips, rules, key, [c for c in trips.columns if c != row_key])
    summary = checkpointed(summary)
    r.tables["null_profile"] = Q.null_profile_from_summary(summary, cols, top=8)
    r.tables["silver_funnel"] = Q.funnel_from_summary(summary)
    r.tables["silver_rejects"] = Q.rejects_from_summary(summary, names)
    r.tables["strata"] = Q.strata_from_summary(summary)
    pop = summary.filter(F.col("stratum").isNotNull()).select("stratum", F.col("n").alias("n_pop"))
    n_silver = pop.agg(F.sum("n_pop")).first()[0] or 0
    d = ST.with_strata(Q.silver(trips, rules))
    # pass 2 over D: the sample itself; its counts come from the checkpoint
    if exact_sample:
        sizes = {row["stratum"]: row["n_pop"] for row in pop.collect()}   # one row per stratum
        m = SA.stratified_exact(d, n_sample, seed=seed, row_key=row_key, counts=sizes)
    else:
        fraction = SA.proportional_fraction(n_sample, n_silver)
        m = SA.stratified_sample(d, fraction=fraction, seed=seed, row_key=row_key)
    # the one checkpoint of M: a sample of many scan partitions in a few
    m = checkpointed(m.repartition(FIT_PARTITIONS, row_key))
    v = SA.validation_from_counts(pop, m.groupBy("stratum").agg(F.count(F.lit(1)).alias("n_sample")))
    r.tables["sample_validation"] = v
    r.scalars["max_abs_err"] = SA.max_deviation(v).first()[0]

    # everything from here on describes all prepared rows; M only bounds the rows that fit the forest
    # written once with the columns that they read: the third and last scan of D
    used = dict.fromkeys([row_key, "stratum", "pay_class", *C.CATEGORICAL_FEATURES, *C.NUMERIC_FEATURES, *C.EDA_COLUMNS])
    prep = materialised(FE.prepared(d).select(*used))
    r.scalars["n_prepared"] = prep.count()
    r.tables["describe"] = Q.describe_long(prep, ["trip_distance", "fare_amount", "trip_duration_min",
                                                  "pickup_hour", "passenger_count", "pickup_zone",
                                                  "day_type", "pay_class"])
    r.tables["histogram"] = EX.histogram(prep, C.HISTOGRAM_COLUMNS)
    r.tables["quantiles"] = EX.quantiles(prep, C.HISTOGRAM_COLUMNS)
    r.tables["kde"] = EX.kde(prep, C.HISTOGRAM_COLUMNS)
    r.tables["correlation"] = EX.correlation_matrix(prep, C.EDA_COLUMNS)
    r.tables["zone_pay_share"] = EX.group_share(prep, "pickup_zone", "pay_class")
    clipped = EX.quantile_clip(prep, ["trip_distance", "fare_amount"], 0.99)
    r.tables["density_by_class"] = EX.density_grid(clipped, "trip_distance", "fare_amount", ["pay_class"])
    r.tables["class_balance"] = Q.class_balance(prep, "pay_class")

    labelled = SA.with_split(prep, seed=seed, row_key=row_key)
    r.tables["split_balance"] = SA.split_balance(labelled)
    train = SA.with_split(FE.prepared(m), seed=seed, row_key=row_key).filter(F.col("split") == "train")
    test = labelled.filter(F.col("split") == "test")
    model = MO.fit_forest(train, trees=trees, depth=depth, seed=seed)
    pred = checkpointed(MO.score(model, test).select(row_key, "label", "prediction", "prob_positive", "features"))
    pos = float(MO.positive_index(model))
    m_all = ME.classification_metrics(pred).first().asDict()
    r.tables["roc_curve"] = ME.roc_points(pred, "prob_positive", "label", pos)
    r.scalars.update({"auc": ME.auc(pred, "prob_positive", "label", pos), **m_all})
    r.tables["confusion_matrix"] = ME.confusion_matrix(pred, classes=[float(i) for i in range(len(MO.class_labels(model)))])
    r.tables["feature_importance"] = MO.feature_importance(model, pred)

    scaled = checkpointed(FE.fit_scaler(prep).transform(prep).select(row_key, "features_scaled", *C.CLUSTER_FEATURES))
    table, km, k = MO.kmeans_sweep(scaled, "features_scaled", ks, seed, dims=len(C.CLUSTER_FEATURES))
    r.tables["kmeans_sweep"] = table
    r.scalars["best_k"] = k
    if km is not None:
        clusters = km.transform(scaled)
        r.tables["cluster_profile"] = EX.cluster_profile(clusters)
        r.tables["cluster_zscores"] = EX.cluster_zscores(EX.cluster_means(clusters, C.CLUSTER_FEATURES),
                                                         C.CLUSTER_FEATURES)
        r.tables["density_by_cluster"] = EX.density_grid(EX.quantile_clip(clusters, ["trip_distance", "fare_amount"], 0.99),
                                                         "trip_distance", "fare_amount", ["prediction"])
        r.tables["box_stats"] = EX.box_stats(clusters, "prediction",
                                             ["trip_distance", "fare_amount", "trip_duration_min"])
    return r


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description="Run the trip study on monthly Parquet files.")
    ap.add_argument("base", help="folder (any Hadoop FS URI) holding yellow_tripdata_<year>-<mm>.parquet")
    ap.add_argument("--year", type=int, default=2024)
    ap.add_argument("--months", default="1-12")
    ap.add_argument("--sample", type=int, default=50_000)
    ap.add_argument("--exact-sample", action="store_true")
    ap.add_argument("--out", help="folder (any Hadoop FS URI) to write every result table to as Parquet")
    a = ap.parse_args(argv)
    lo, hi = (int(x) for x in a.months.split("-"))
    spark: SparkSession = get_spark("strataflow-study")
    trips = read_reconciled(spark, month_paths(a.base, a.year, range(lo, hi + 1)), key_col="trip_key")
    res = run_study(trips, a.sample, year=a.year, exact_sample=a.exact_sample, row_key="trip_key")
    for name, t in res.tables.items():
        if a.out:
            t.write.mode("overwrite").parquet(f"{a.out.rstrip('/')}/{name}")
        print(f"== {name}")
        t.show(50, truncate=False)
    print(json.dumps({k: v for k, v in res.scalars.items()}, default=str))


if __name__ == "__main__":
    main()
