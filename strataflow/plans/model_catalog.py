"""Registered queries of the regression, Bayes, tree and mixture models, each fitted on all prepared trips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as C
from ..operators import glm as G
from ..operators import graphs as GR
from ..operators import mixtures as MX
from ..operators import naive_bayes as NB
from ..operators import perceptron as MP
from ..operators import trees as T
from .catalog import prepared_trips, query


def card() -> Column:
    return F.when(F.col("pay_class") == C.CARD, 1.0).otherwise(0.0)


def terms(columns, zones: bool = False, weekend: bool = False) -> dict[str, Column]:
    out = {c: F.col(c) for c in columns}
    if zones:
        out |= G.dummies("pickup_zone", (C.MANHATTAN, C.AIRPORT))
    return out | (G.dummies("day_type", (C.WEEKEND,)) if weekend else {})


def rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Columns rounded, without negative zeros."""
    return df.select(*[(F.round(c, digits[c]) + F.lit(0.0)).alias(c) if c in digits else F.col(c) for c in df.columns])


# ---------------------------------------------------------------- regression
RIDGE = 0.001


def logistic(spark: SparkSession, sf_dir: str):
    prep = prepared_trips(spark, sf_dir)
    x = terms(["trip_distance", "trip_duration_min", "pickup_hour", "passenger_count"], zones=True, weekend=True)
    return prep, x, G.fit(prep, card(), x, G.BINOMIAL, ridge=RIDGE)


@query("logreg_fit")
def q_logreg_fit(spark, sf_dir):
    """Coefficients of card payment, and the penalised gradient there."""
    prep, _, model = logistic(spark, sf_dir)
    return rounded(G.coefficient_table(prep, model).drop("std_error"), {"coefficient": 4, "gradient": 6})


@query("logreg_report")
def q_logreg_report(spark, sf_dir):
    prep, x, model = logistic(spark, sf_dir)
    return rounded(G.classifier_report(prep, model, card(), x), {"log_loss": 8})


def fares(spark: SparkSession, sf_dir: str):
    prep = prepared_trips(spark, sf_dir)
    x = terms(["trip_distance", "trip_duration_min"], zones=True)
    return prep, x, G.fit(prep, F.col("fare_amount"), x)


@query("linreg_fit")
def q_linreg_fit(spark, sf_dir):
    """Least squares of the fare on distance, duration and zone."""
    prep, _, model = fares(spark, sf_dir)
    return rounded(G.coefficient_table(prep, model).drop("std_error"), {"coefficient": 5, "gradient": 6})


@query("linreg_report")
def q_linreg_report(spark, sf_dir):
    prep, x, model = fares(spark, sf_dir)
    return rounded(G.regression_report(prep, model, F.col("fare_amount"), x), {"r2": 6, "rmse": 6, "mae": 6})


GLM_ROUNDS = 6


def generalised(spark: SparkSession, sf_dir: str):
    """Gamma fares and Poisson passengers, both with the log link."""
    prep = prepared_trips(spark, sf_dir)
    x = terms(["trip_distance", "trip_duration_min", "pickup_hour"])
    return prep, [G.fit(prep, F.col(y), x, family, max_rounds=GLM_ROUNDS, tolerance=0.0) for y, family in (("fare_amount", G.GAMMA), ("passenger_count", G.POISSON))]


@query("glm_fit")
def q_glm_fit(spark, sf_dir):
    prep, models = generalised(spark, sf_dir)
    one, two = (G.coefficient_table(prep, m).drop("std_error").withColumn("family", F.lit(m.family.name)) for m in models)
    return rounded(one.unionByName(two), {"coefficient": 4, "gradient": 6})


@query("glm_rounds")
def q_glm_rounds(spark, sf_dir):
    """The deviance that each round began with."""
    prep, (one, two) = generalised(spark, sf_dir)
    return rounded(G.rounds_table(prep, one).union(G.rounds_table(prep, two)), {"deviance": 4})


# ---------------------------------------------------------------- naive Bayes
def bayes(spark: SparkSession, sf_dir: str):
    prep = prepared_trips(spark, sf_dir)
    return prep, NB.fit(prep, "pay_class", ["pickup_zone", "day_type", "pickup_hour"], ["trip_distance", "trip_duration_min"])


@query("naive_bayes_fit")
def q_naive_bayes_fit(spark, sf_dir):
    prep, model = bayes(spark, sf_dir)
    return rounded(NB.model_table(prep, model), {"value": 6})


@query("naive_bayes_predictions")
def q_naive_bayes_predictions(spark, sf_dir):
    prep, model = bayes(spark, sf_dir)
    return rounded(NB.score(prep, model, C.CARD).select("event_id", F.col("pay_class").alias("label"), "prediction", "log_odds"), {"log_odds": 5})


# ---------------------------------------------------------------- trees
TREE_COLUMNS = ("trip_distance", "trip_duration_min", "pickup_hour", "pickup_dow", "passenger_count", "tolls_amount")
FARE_COLUMNS = ("trip_distance", "pickup_hour", "pickup_dow", "passenger_count", "tolls_amount", "congestion_surcharge")


def tree_rows(spark: SparkSession, sf_dir: str, task: str):
    prep = prepared_trips(spark, sf_dir)
    columns, y = (TREE_COLUMNS, card()) if task == "classifier" else (FARE_COLUMNS, F.col("fare_amount"))
    bins = T.fit_bins(prep, columns)
    return T.design(prep, y, bins, ["event_id"]), bins


def both_trees(spark: SparkSession, sf_dir: str):
    for task in ("classifier", "regressor"):
        rows, bins = tree_rows(spark, sf_dir, task)
        yield task, rows, T.grow(rows, bins, depth=3)


@query("tree_fit")
def q_tree_fit(spark, sf_dir):
    """Nodes of a classification tree of card payment and a regression tree of the fare."""
    one, two = (T.tree_table(rows, tree).withColumn("task", F.lit(task)) for task, rows, tree in both_trees(spark, sf_dir))
    return rounded(one.union(two), {"threshold": 6, "gain": 8, "value": 6})


@query("tree_leaves")
def q_tree_leaves(spark, sf_dir):
    """Every trip's leaf and the leaf's value, in both trees."""
    one, two = (rows.select(F.lit(task).alias("task"), "event_id", tree.leaf().alias("leaf"), tree.predict().alias("value")) for task, rows, tree in both_trees(spark, sf_dir))
    return rounded(one.union(two), {"value": 6})


GBT_ROUNDS, GBT_RATE = 3, 0.5


def both_boosted(spark: SparkSession, sf_dir: str):
    for task, loss in (("classifier", "logistic"), ("regressor", "squared")):
        rows, bins = tree_rows(spark, sf_dir, task)
        yield task, rows, T.boost(rows, bins, GBT_ROUNDS, 2, GBT_RATE, loss)


@query("gbt_rounds")
def q_gbt_rounds(spark, sf_dir):
    """The mean loss after each round of boosting."""
    one, two = (T.losses_table(rows, model) for _, rows, model in both_boosted(spark, sf_dir))
    return rounded(one.union(two), {"value": 6})


@query("gbt_scores")
def q_gbt_scores(spark, sf_dir):
    one, two = (rows.select(F.lit(task).alias("task"), "event_id", model.predict().alias("score")) for task, rows, model in both_boosted(spark, sf_dir))
    return rounded(one.union(two), {"score": 6})


# ---------------------------------------------------------------- clusters
BISECT_ROUNDS, BISECT_DEPTH = 4, 2


def bisected(spark: SparkSession, sf_dir: str):
    rows, _ = MX.standardised(prepared_trips(spark, sf_dir), C.CLUSTER_FEATURES, ["event_id"])
    return rows, MX.bisect(rows, [f"z{i}" for i in range(len(C.CLUSTER_FEATURES))], BISECT_DEPTH, BISECT_ROUNDS)


@query("bisecting_nodes")
def q_bisecting_nodes(spark, sf_dir):
    rows, model = bisected(spark, sf_dir)
    return rounded(MX.bisection_table(rows, model), {"cost": 4} | {c: 6 for c in model.z})


@query("bisecting_path")
def q_bisecting_path(spark, sf_dir):
    """Every trip's cluster on both levels."""
    rows, model = bisected(spark, sf_dir)
    return rows.select("event_id", *[model.path(level).alias(f"level_{level}") for level in (1, 2)])


GMM_ROUNDS, GMM_K = 6, 3


def mixed(spark: SparkSession, sf_dir: str):
    rows, _ = MX.standardised(prepared_trips(spark, sf_dir), ["trip_distance", "fare_amount"], ["event_id"])
    return rows, MX.fit_mixture(rows, ["z0", "z1"], GMM_K, GMM_ROUNDS, tolerance=-1.0)


@query("gmm_fit")
def q_gmm_fit(spark, sf_dir):
    """Weights, means and covariances of a mixture over standardised distance and fare."""
    rows, model = mixed(spark, sf_dir)
    return rounded(MX.mixture_table(rows, model), {"value": 5})


@query("gmm_rounds")
def q_gmm_rounds(spark, sf_dir):
    rows, model = mixed(spark, sf_dir)
    return rounded(MX.likelihood_table(rows, model), {"log_likelihood": 6})


@query("gmm_assign")
def q_gmm_assign(spark, sf_dir):
    """Every trip's responsibilities."""
    rows, model = mixed(spark, sf_dir)
    r = [F.col(f"r{i}") for i in range(GMM_K)]
    out = model.respond(rows).select("event_id", *r, sum(r, F.lit(0.0)).alias("total"))
    return rounded(out, {"r0": 5, "r1": 5, "r2": 5, "total": 9})


# ---------------------------------------------------------------- support vectors, perceptron
@query("svc_fit")
def q_svc_fit(spark, sf_dir):
    """Support vector coefficients of card payment (squared hinge), and the penalised gradient there."""
    prep = prepared_trips(spark, sf_dir)
    x = terms(["trip_distance", "trip_duration_min", "pickup_hour", "passenger_count"], zones=True, weekend=True)
    model = G.fit(prep, card(), x, G.HINGE, ridge=RIDGE, max_rounds=SVC_ROUNDS, tolerance=0.0)
    return rounded(G.coefficient_table(prep, model).drop("std_error").withColumn("loss", F.lit(model.deviance / model.n)), {"coefficient": 4, "gradient": 6, "loss": 6})


SVC_ROUNDS = 10
MLP_ROUNDS, MLP_HIDDEN, MLP_COLUMNS = 8, 3, ("trip_distance", "trip_duration_min", "pickup_hour")


def perceptron(spark: SparkSession, sf_dir: str):
    prep = prepared_trips(spark, sf_dir).withColumn("card", card())
    rows, _ = MX.standardised(prep, MLP_COLUMNS, ["event_id", "card"])
    return rows, MP.fit(rows, ["z0", "z1", "z2"], "card", MLP_HIDDEN, MLP_ROUNDS)


@query("mlp_rounds")
def q_mlp_rounds(spark, sf_dir):
    """The loss that each round of back-propagation began with."""
    rows, model = perceptron(spark, sf_dir)
    return rounded(MP.losses_table(rows, model), {"loss": 8})


@query("mlp_scores")
def q_mlp_scores(spark, sf_dir):
    rows, model = perceptron(spark, sf_dir)
    return rounded(rows.select("event_id", model.predict().alias("score")), {"score": 6})


# ---------------------------------------------------------------- graphs, topics
PIC_ROUNDS = 6


@query("pic_values")
def q_pic_values(spark, sf_dir):
    """Power iteration over (zone, hour) cells: an edge between neighbouring hours of a zone, weighted by the trips in both cells."""
    cells = prepared_trips(spark, sf_dir).groupBy(F.col("PULocationID").alias("zone"), F.col("pickup_hour").alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    name = lambda hour: F.concat_ws("-", F.col("zone").cast("string"), hour.cast("string"))
    after = cells.select("zone", (F.col("hour") - 1).alias("hour"), F.col("n").alias("next"))
    edges = cells.join(after, ["zone", "hour"]).select(name(F.col("hour")).alias("src"), name(F.col("hour") + 1).alias("dst"), (F.col("n") + F.col("next")).cast("double").alias("weight"))
    return rounded(GR.power_iteration(edges, PIC_ROUNDS), {"value": 10})


TOPIC_ROUNDS, TOPICS = 4, 2


def topics(spark: SparkSession, sf_dir: str):
    counts = prepared_trips(spark, sf_dir).groupBy(F.col("PULocationID").alias("doc"), F.col("pickup_hour").alias("word")).agg(F.count(F.lit(1)).alias("n"))
    return GR.fit_topics(counts, TOPICS, TOPIC_ROUNDS)


@query("lda_mixtures")
def q_lda_mixtures(spark, sf_dir):
    """Topic mixtures of zones over the hours of their trips."""
    mixture, _, _ = topics(spark, sf_dir)
    return rounded(mixture, {"t0": 6, "t1": 6})


@query("lda_topics")
def q_lda_topics(spark, sf_dir):
    _, words, _ = topics(spark, sf_dir)
    return rounded(words, {"t0": 6, "t1": 6})


@query("lda_rounds")
def q_lda_rounds(spark, sf_dir):
    return rounded(topics(spark, sf_dir)[2], {"log_likelihood": 6})
