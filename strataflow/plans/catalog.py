"""Registered queries: one builder per operator key of the inventory.

Every builder takes ``(spark, sf_dir)``, reads the driver tables of that
folder (trips are derived from ``events``) and returns a DataFrame over the
whole tables. Small scalars some builders need (a row count, a quantile, a
k-row centroid table) come from bounded aggregates.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql.types import StructType

from ..functions import constants as C
from ..functions.hashing import uniform
from ..operators import explore as EX
from ..operators import features as FE
from ..operators import metrics as ME
from ..operators import models as MO
from ..operators import quality as Q
from ..operators import sampling as SA
from ..operators import strata as ST
from ..session import checkpointed, ensure_checkpoint_dir, materialised
from ..sources.events import EVENTS_SCHEMA, load_trips
from ..sources.schema import TRIP_COLUMNS, TRIP_SCHEMA
from ..sources.trips import read_months, read_reconciled, read_trips

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Builder] = {}


def query(name: str):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------- shared frames
def silver_strata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ST.with_strata(Q.silver(load_trips(spark, sf_dir)))


def prepared_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FE.prepared(silver_strata(spark, sf_dir))


# ---------------------------------------------------------------- sources
MONTHS = 3


def monthly_files(spark: SparkSession, sf_dir: str) -> list[str]:
    """The derived trips as monthly files that disagree, as the study's do: written below the checkpoint folder.

    By the week of pickup; the second file has whole-number passenger counts, the third no airport fee."""
    trips = load_trips(spark, sf_dir).withColumn("_file", F.weekofyear("tpep_pickup_datetime") % MONTHS)
    base = f"{ensure_checkpoint_dir(spark)}/trips-{uuid.uuid4().hex}"
    paths = [f"{base}/trips-{m}.parquet" for m in range(MONTHS)]
    for m, path in enumerate(paths):
        month = trips.where(F.col("_file") == m).drop("_file")
        if m == 1:
            month = month.withColumn("passenger_count", F.col("passenger_count").cast("long"))
        if m == 2:
            month = month.drop("airport_fee")
        month.write.parquet(path)
    return paths


KEYED_TRIPS = StructType([EVENTS_SCHEMA["event_id"], *TRIP_SCHEMA.fields])


@query("scan_trips")
def q_scan_trips(spark, sf_dir):
    """Fixed-schema scan of written trip files."""
    path = f"{ensure_checkpoint_dir(spark)}/trips-{uuid.uuid4().hex}"
    load_trips(spark, sf_dir).write.parquet(path)
    return read_trips(spark, path, KEYED_TRIPS)


@query("scan_reconciled")
def q_scan_reconciled(spark, sf_dir):
    """Files grouped by footers that agree, conformed to one schema."""
    return read_reconciled(spark, monthly_files(spark, sf_dir), KEYED_TRIPS)


@query("union_months")
def q_union_months(spark, sf_dir):
    """Per-path read + cast + union by name over monthly files whose types and columns differ."""
    return read_months(spark, monthly_files(spark, sf_dir), KEYED_TRIPS)


# ---------------------------------------------------------------- quality
@query("null_profile_top8")
def q_null_profile(spark, sf_dir):
    return Q.null_profile(load_trips(spark, sf_dir).select(*TRIP_COLUMNS), top=8)


@query("silver_trips")
def q_silver(spark, sf_dir):
    return Q.silver(load_trips(spark, sf_dir))


@query("silver_funnel")
def q_silver_funnel(spark, sf_dir):
    return Q.rule_funnel(load_trips(spark, sf_dir))


@query("silver_rejects")
def q_silver_rejects(spark, sf_dir):
    return Q.rule_rejects(load_trips(spark, sf_dir))


@query("prepared_trips")
def q_prepared(spark, sf_dir):
    return prepared_trips(spark, sf_dir)


@query("trip_features")
def q_trip_features(spark, sf_dir):
    return FE.with_trip_features(Q.silver(load_trips(spark, sf_dir))).select(
        "event_id", "trip_duration_min", "pickup_hour", "pickup_dow")


@query("imputed_trips")
def q_imputed(spark, sf_dir):
    return FE.impute(Q.silver(load_trips(spark, sf_dir)))


@query("describe_trips")
def q_describe(spark, sf_dir):
    d = Q.describe_long(prepared_trips(spark, sf_dir),
                        ["trip_distance", "fare_amount", "trip_duration_min", "pickup_hour",
                         "passenger_count", "pickup_zone", "day_type", "pay_class"])
    return d.select("column_name", "count", *[F.round(c, 4).alias(c) for c in ("mean", "stddev", "min", "max")],
                    "min_text", "max_text")


@query("class_filter")
def q_class_filter(spark, sf_dir):
    return Q.class_filter(prepared_trips(spark, sf_dir), "pay_class", C.CARD).select("event_id", "pay_class")


@query("class_balance")
def q_class_balance(spark, sf_dir):
    return Q.class_balance(prepared_trips(spark, sf_dir), "pay_class")


# ---------------------------------------------------------------- strata
@query("strata_counts")
def q_strata_counts(spark, sf_dir):
    return ST.strata_counts(silver_strata(spark, sf_dir)).select("stratum", "n")


@query("strata_shares")
def q_strata_shares(spark, sf_dir):
    return ST.strata_counts(silver_strata(spark, sf_dir))


@query("strata_distinct")
def q_strata_distinct(spark, sf_dir):
    return ST.strata_distinct(silver_strata(spark, sf_dir))


# ---------------------------------------------------------------- sampling

SAMPLE_FRACTION = 0.1       # stratified Bernoulli rate of the registered sample
EXACT_SAMPLE_N = 1000       # total size of the exact proportional sample
PLOT_SAMPLE_N = 2500        # target size of the plotting sample


def strata_sample(spark, sf_dir):
    return SA.stratified_sample(silver_strata(spark, sf_dir), fraction=SAMPLE_FRACTION, seed=42)


def validation(spark, sf_dir):
    """Population vs the registered stratified sample, both counted in one scan."""
    return SA.sample_validation(silver_strata(spark, sf_dir),
                                in_sample=SA.sample_flag(SAMPLE_FRACTION, seed=42, purpose="strata"))


@query("stratified_sample")
def q_stratified_sample(spark, sf_dir):
    return strata_sample(spark, sf_dir).select("event_id", "stratum")


@query("stratified_exact")
def q_stratified_exact(spark, sf_dir):
    return SA.stratified_exact(silver_strata(spark, sf_dir), EXACT_SAMPLE_N, seed=42).select("event_id", "stratum")


@query("plot_sample")
def q_plot_sample(spark, sf_dir):
    return SA.sample_to(prepared_trips(spark, sf_dir), PLOT_SAMPLE_N, seed=42).select("event_id")


@query("train_test_split")
def q_train_test_split(spark, sf_dir):
    return SA.with_split(prepared_trips(spark, sf_dir)).select("event_id", "split")


@query("split_balance")
def q_split_balance(spark, sf_dir):
    return SA.split_balance(SA.with_split(prepared_trips(spark, sf_dir)))


@query("sample_validation")
def q_sample_validation(spark, sf_dir):
    return validation(spark, sf_dir)


@query("sample_validation_long")
def q_sample_validation_long(spark, sf_dir):
    return SA.sample_validation_long(validation(spark, sf_dir))


@query("max_deviation")
def q_max_deviation(spark, sf_dir):
    return SA.max_deviation(validation(spark, sf_dir))


# ---------------------------------------------------------------- exploration

QUANTILE_PROBS = (0.25, 0.5, 0.75, 0.99)
KDE_POINTS = 100
BOX_COLUMNS = ("trip_distance", "fare_amount", "trip_duration_min")


def assigned_trips(spark, sf_dir):
    """Prepared trips with a fixed cluster assignment (afternoon = 1), so
    cluster statistics are checked exactly without fitting a model."""
    return prepared_trips(spark, sf_dir).withColumn(
        "prediction", (F.hour("tpep_pickup_datetime") >= 12).cast("int"))


@query("quantiles")
def q_quantiles(spark, sf_dir):
    q = EX.quantiles(prepared_trips(spark, sf_dir), C.HISTOGRAM_COLUMNS, QUANTILE_PROBS)
    return q.select("column_name", "q", F.round("value", 6).alias("value"))


@query("quantile_clip")
def q_quantile_clip(spark, sf_dir):
    return EX.quantile_clip(prepared_trips(spark, sf_dir), ["trip_distance", "fare_amount"], 0.99).select("event_id")


@query("histogram")
def q_histogram(spark, sf_dir):
    h = EX.histogram(prepared_trips(spark, sf_dir), C.HISTOGRAM_COLUMNS, bins=40)
    return h.select("column_name", "bin", F.round("bin_lo", 6).alias("bin_lo"),
                    F.round("bin_hi", 6).alias("bin_hi"), "n")


@query("kde")
def q_kde(spark, sf_dir):
    """The density curve of every charted column."""
    k = EX.kde(prepared_trips(spark, sf_dir), C.HISTOGRAM_COLUMNS, grid_points=KDE_POINTS)
    return k.select("column_name", F.round("x", 6).alias("x"), F.round("density", 4).alias("density"))


@query("density_by_cluster")
def q_density_by_cluster(spark, sf_dir):
    # cut, range and counts read the written columns: one scan of the trips
    clipped = EX.quantile_clip(materialised(assigned_trips(spark, sf_dir).select("trip_distance", "fare_amount", "prediction")), ["trip_distance", "fare_amount"], 0.99)
    return EX.density_grid(clipped, "trip_distance", "fare_amount", by=["prediction"], bins=50)


@query("density_grid")
def q_density_grid(spark, sf_dir):
    clipped = EX.quantile_clip(materialised(prepared_trips(spark, sf_dir).select("trip_distance", "fare_amount", "pay_class")), ["trip_distance", "fare_amount"], 0.99)
    return EX.density_grid(clipped, "trip_distance", "fare_amount", by=["pay_class"], bins=50)


@query("correlation_matrix")
def q_correlation(spark, sf_dir):
    m = EX.correlation_matrix(prepared_trips(spark, sf_dir), C.EDA_COLUMNS)
    return m.select("col_a", "col_b", F.round("r", 4).alias("r"))


@query("zone_pay_share")
def q_zone_pay_share(spark, sf_dir):
    return EX.group_share(prepared_trips(spark, sf_dir), "pickup_zone", "pay_class")


@query("cluster_profile")
def q_cluster_profile(spark, sf_dir):
    return EX.cluster_profile(assigned_trips(spark, sf_dir))


@query("cluster_means")
def q_cluster_means(spark, sf_dir):
    m = EX.cluster_means(assigned_trips(spark, sf_dir), C.CLUSTER_FEATURES)
    return m.select("prediction", "n", *[F.round(c, 6).alias(c) for c in C.CLUSTER_FEATURES])


@query("cluster_zscores")
def q_cluster_zscores(spark, sf_dir):
    means = EX.cluster_means(assigned_trips(spark, sf_dir), C.CLUSTER_FEATURES)
    z = EX.cluster_zscores(means, C.CLUSTER_FEATURES)
    return z.select("prediction", "column_name", F.round("mean", 4).alias("mean"), F.round("z", 4).alias("z"))


@query("box_stats")
def q_box_stats(spark, sf_dir):
    b = EX.box_stats(materialised(assigned_trips(spark, sf_dir).select("prediction", *BOX_COLUMNS)), "prediction", BOX_COLUMNS, clip_q=0.99)
    return b.select("prediction", "column_name", *[F.round(c, 4).alias(c) for c in ("q1", "median", "q3", "whisker_lo", "whisker_hi")],
                    "n", "n_outliers")


# ---------------------------------------------------------------- features


def indexed(spark, sf_dir):
    """Prepared trips with the label index (frequency desc, ties alphabetical)."""
    df = prepared_trips(spark, sf_dir)
    model = FE.label_indexer("pay_class", "label").fit(df)
    return model.transform(df), list(model.labels)


@query("label_index")
def q_label_index(spark, sf_dir):
    df, labels = indexed(spark, sf_dir)
    counts = df.groupBy("pay_class").agg(F.count(F.lit(1)).alias("n"))
    lab = F.array(*[F.lit(x) for x in labels])
    return counts.withColumn("label", (F.array_position(lab, F.col("pay_class")) - 1).cast("double"))


@query("one_hot")
def q_one_hot(spark, sf_dir):
    df = prepared_trips(spark, sf_dir)
    cols = []
    idx, ohe = FE.categorical_stages(C.CATEGORICAL_FEATURES)
    model = Pipeline(stages=idx + ohe).fit(df)
    out = model.transform(df)
    for c, labels in zip(C.CATEGORICAL_FEATURES, model.stages[0].labelsArray):
        arr = FE.vector_to_array(F.col(f"{c}_ohe"))
        cols += [arr[i].alias(f"{c}_ohe_{lab}") for i, lab in enumerate(labels)]
    return out.select("event_id", *cols)


@query("feature_matrix")
def q_feature_matrix(spark, sf_dir):
    df = prepared_trips(spark, sf_dir)
    out = FE.fit_features(df).transform(df)
    return FE.vector_columns(out, "features", FE.feature_names(out), keep=["event_id"])


@query("feature_names")
def q_feature_names(spark, sf_dir):
    df = prepared_trips(spark, sf_dir)
    out = FE.fit_features(df).transform(df)   # only the output schema metadata is read
    names = FE.feature_names(out)
    return spark.createDataFrame([(i, n) for i, n in enumerate(names)], "idx int, name string")


def scaled(spark, sf_dir):
    df = prepared_trips(spark, sf_dir)
    return FE.fit_scaler(df, C.CLUSTER_FEATURES).transform(df)


@query("standard_scale")
def q_standard_scale(spark, sf_dir):
    names = [f"{c}_scaled" for c in C.CLUSTER_FEATURES]
    out = FE.vector_columns(scaled(spark, sf_dir), "features_scaled", names, keep=["event_id"])
    return out.select("event_id", *[F.round(n, 6).alias(n) for n in names])


# ---------------------------------------------------------------- metrics on a fixed score / assignment
def fixed_scores(spark, sf_dir):
    """Label index plus a deterministic tie-heavy score for the positive
    class (card): round(u, 2); prediction = card when score >= 0.5."""
    df, labels = indexed(spark, sf_dir)
    pos = float(labels.index(C.CARD))
    neg = 1.0 - pos
    sc = F.round(uniform("event_id", "score:42"), 2)
    return (df.withColumn("score", sc)
              .withColumn("prediction", F.when(F.col("score") >= 0.5, F.lit(pos)).otherwise(F.lit(neg)))), pos


@query("confusion_matrix")
def q_confusion(spark, sf_dir):
    df, _ = fixed_scores(spark, sf_dir)
    return ME.confusion_matrix(df, "label", "prediction", (0.0, 1.0))


@query("accuracy")
def q_accuracy(spark, sf_dir):
    df, _ = fixed_scores(spark, sf_dir)
    return ME.classification_metrics(df).select(F.round("accuracy", 10).alias("accuracy"))


@query("weighted_f1")
def q_weighted_f1(spark, sf_dir):
    df, _ = fixed_scores(spark, sf_dir)
    return ME.classification_metrics(df).select(F.round("weighted_f1", 6).alias("weighted_f1"))


@query("roc_curve")
def q_roc_curve(spark, sf_dir):
    df, pos = fixed_scores(spark, sf_dir)
    return ME.roc_curve(df, "score", "label", pos)


@query("auc")
def q_auc(spark, sf_dir):
    df, pos = fixed_scores(spark, sf_dir)
    return ME.roc_area(df, "score", "label", pos).select(F.round("auc", 10).alias("auc"))


ROC_POINTS = 25


@query("roc_points")
def q_roc_points(spark, sf_dir):
    """A ROC curve of bounded size over a score that differs from row to row."""
    df, pos = fixed_scores(spark, sf_dir)
    p = ME.roc_points(df.withColumn("fine", uniform("event_id", "score:42")), "fine", "label", pos, ROC_POINTS)
    return p.select(F.round("threshold", 9).alias("threshold"), "tp", "fp", F.round("tpr", 9).alias("tpr"), F.round("fpr", 9).alias("fpr"))


@query("auc_fine")
def q_auc_fine(spark, sf_dir):
    """The area over a score that differs from row to row."""
    df, pos = fixed_scores(spark, sf_dir)
    return ME.roc_area(df.withColumn("fine", uniform("event_id", "score:42")), "fine", "label", pos).select(F.round("auc", 10).alias("auc"))


def scaled_assigned(spark, sf_dir):
    names = [f"{c}_scaled" for c in C.CLUSTER_FEATURES]
    df = scaled(spark, sf_dir).withColumn("prediction", (F.hour("tpep_pickup_datetime") >= 12).cast("int"))
    return FE.vector_columns(df, "features_scaled", names, keep=["event_id", "prediction"]), names


@query("silhouette")
def q_silhouette(spark, sf_dir):
    df, names = scaled_assigned(spark, sf_dir)
    return ME.silhouette(df, names).select(F.round("silhouette", 6).alias("silhouette"))


@query("wssse")
def q_wssse(spark, sf_dir):
    df, names = scaled_assigned(spark, sf_dir)
    return ME.wssse(df, names).select(F.round("wssse", 4).alias("wssse"))


# ---------------------------------------------------------------- models
#: Rows of Silver that the forest is fitted from (the study's sample M); everything is scored and clustered.
FOREST_ROWS = 50_000
#: Partitions of the forest's training frame: fixed, as the bagging depends on them.
FIT_PARTITIONS = 8


def forest_run(spark, sf_dir):
    """A forest fitted on the training part of sample M, and the scored test part of ALL prepared trips."""
    silver = silver_strata(spark, sf_dir)
    fraction = SA.proportional_fraction(FOREST_ROWS, silver.count())
    train = SA.with_split(FE.prepared(SA.stratified_sample(silver, fraction=fraction, seed=42))).filter(F.col("split") == "train")
    model = MO.fit_forest(checkpointed(train.repartition(FIT_PARTITIONS, "event_id")))
    test = SA.with_split(FE.prepared(silver)).filter(F.col("split") == "test")
    return model, MO.score(model, test)


@query("rf_predictions")
def q_rf_predictions(spark, sf_dir):
    """Per test row its label, and whether the class probabilities and the prediction fit together."""
    _, pred = forest_run(spark, sf_dir)
    p = F.transform(vector_to_array("probability"), lambda x: x)
    total = F.aggregate(p, F.lit(0.0), lambda a, x: a + x)
    chosen = F.element_at(p, F.col("prediction").cast("int") + 1)
    return pred.select("event_id", "label", (F.abs(total - 1) < 1e-9).alias("sums_to_one"),
                       (chosen == F.array_max(p)).alias("is_argmax"),
                       F.col("prob_positive").between(0, 1).alias("is_probability"))


@query("feature_importance")
def q_feature_importance(spark, sf_dir):
    """The features by name, and whether their importances add up and the forest found the planted signal."""
    model, pred = forest_run(spark, sf_dir)
    imp = MO.feature_importance(model, pred)
    auc = ME.auc(pred, "prob_positive", "label", float(MO.positive_index(model)))
    total = imp.agg(F.sum("importance")).first()[0]
    return imp.select(F.col("feature").alias("name"), F.col("importance").between(0, 1).alias("in_range"),
                      F.lit(abs(total - 1) < 1e-9).alias("sums_to_one"), F.lit(auc is not None and auc > 0.7).alias("auc_over_70"))


def sweep(spark, sf_dir):
    """k-means for k = 2..7 over all prepared trips."""
    prep = prepared_trips(spark, sf_dir)
    data = checkpointed(FE.fit_scaler(prep, C.CLUSTER_FEATURES).transform(prep).select("event_id", "features_scaled"))
    return data, MO.kmeans_sweep(data, "features_scaled", range(2, 8), seed=42, dims=len(C.CLUSTER_FEATURES))


def squared_distances(model, features: str = "features_scaled"):
    """Squared distance to each centre."""
    x = vector_to_array(features)
    return F.array(*[sum(((x[j] - F.lit(float(v))) * (x[j] - F.lit(float(v))) for j, v in enumerate(c)), F.lit(0.0)) for c in model.clusterCenters()])


@query("kmeans_sweep")
def q_kmeans_sweep(spark, sf_dir):
    """Per k whether cost and silhouette are sound; whether the chosen k has the best silhouette and its cost is that of its rows."""
    data, (table, model, best) = sweep(spark, sf_dir)
    rows = table.collect()   # one row per k
    cost = data.agg(F.sum(F.array_min(squared_distances(model)))).first()[0]
    chosen = next(r for r in rows if r["k"] == best)
    sound = chosen["silhouette"] == max(r["silhouette"] for r in rows) and abs(cost - chosen["wssse"]) <= 1e-6 * cost
    return table.select("k", (F.col("wssse") > 0).alias("cost_is_positive"), F.col("silhouette").between(-1, 1).alias("silhouette_in_range"),
                        F.lit(sound).alias("choice_is_sound"))


@query("kmeans_assign")
def q_kmeans_assign(spark, sf_dir):
    """Per prepared trip whether its cluster is that of the nearest centre."""
    data, (_, model, best) = sweep(spark, sf_dir)
    d = squared_distances(model)
    own = F.element_at(d, F.col("prediction") + 1)
    return model.transform(data).select("event_id", (own <= F.array_min(d) * (1 + 1e-9) + 1e-12).alias("is_nearest"),
                                        F.col("prediction").between(0, best - 1).alias("is_cluster"))


from . import model_catalog  # noqa: E402,F401  registers its keys
