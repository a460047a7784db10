"""Classification and clustering metrics.

All metrics are computed over every scored row with DataFrame aggregations;
the ROC curve uses bucketed running sums (no single-partition global sort)
and is tie-aware: rows with equal scores form one curve point.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..session import checkpointed
from .prefix import running_sums


# ---------------------------------------------------------------- ROC / AUC
def roc_curve(pred: DataFrame, score: str = "score", label: str = "label", positive: float = 1.0,
              rows_per_task: int = 1_000_000) -> DataFrame:
    """One point per distinct score, descending: (score, pos, neg, tp, fp, tpr, fpr).

    ``tp``/``fp`` count rows with score >= the point's score. The origin
    (0, 0) is implied.
    """
    is_pos = (F.col(label) == F.lit(positive)).cast("long")
    per_score = checkpointed(   # one row per distinct score; scanned once, read twice
        pred.groupBy(score).agg(F.sum(is_pos).alias("pos"), F.sum(1 - is_pos).alias("neg")))
    cum = running_sums(per_score, score, ["pos", "neg"], descending=True, rows_per_task=rows_per_task,
                       totals=True)
    return cum.select(
        score, "pos", "neg", F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"),
        F.try_divide(F.col("cum_pos"), F.col("tot_pos")).alias("tpr"),
        F.try_divide(F.col("cum_neg"), F.col("tot_neg")).alias("fpr"))


def auc_from_roc(roc: DataFrame) -> DataFrame:
    """Trapezoid area under a tie-aware ROC curve, one row.

    Each point's trapezoid needs only its own counts: Δfpr = neg/N and the
    previous tpr is (tp - pos)/P, so the area is a plain sum aggregate."""
    return roc.select("pos", "neg", "tp").agg(
            F.sum(F.col("neg") * (F.lit(2.0) * F.col("tp") - F.col("pos"))).alias("_num"),
            F.sum("pos").alias("_P"), F.sum("neg").alias("_N")).select(
            F.when((F.col("_P") > 0) & (F.col("_N") > 0),
                   F.col("_num") / (F.lit(2.0) * F.col("_P") * F.col("_N"))).alias("auc"))


def _score_bins(pred: DataFrame, score: str, label: str, positive: float, bins: int) -> tuple[DataFrame, float, float]:
    """(score, bin, hit) per row, and the range of the scores. Bin 0 is for null scores, the last for NaN; others follow the score."""
    s = F.col(score).cast("double")
    low, high = pred.where(~F.isnan(s)).agg(F.min(s), F.max(s)).first()
    if low is None or high == low:
        at = F.lit(1)
    else:
        at = F.least(F.floor((s - F.lit(low)) / F.lit(high - low) * F.lit(float(bins))).cast("int"), F.lit(bins - 1)) + 1
    at = F.when(s.isNull(), 0).when(F.isnan(s), bins + 1).otherwise(at)
    return pred.select(s.alias("score"), at.alias("bin"), (F.col(label) == F.lit(positive)).cast("long").alias("hit")), low, high


def roc_area(pred: DataFrame, score: str = "score", label: str = "label", positive: float = 1.0, bins: int = 1 << 14) -> DataFrame:
    """Area under the tie-aware ROC curve, one row ``auc``, exact for any scores, without a table of them.

    Rows add up map-side by (bin, score) and meet by bin: a running sum inside
    a bin gives its own part of the area, and the bins' totals, at most
    ``bins`` + 2 rows, give the rest. Null scores rank last. Null where a
    class is missing.
    """
    rows, _, _ = _score_bins(pred, score, label, positive, bins)
    per_score = rows.groupBy("bin", "score").agg(F.sum("hit").alias("pos"), F.sum(1 - F.col("hit")).alias("neg"))
    inside = Window.partitionBy("bin").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    per_score = per_score.withColumn("tp", F.sum("pos").over(inside))
    per_bin = per_score.groupBy("bin").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"),
                                           F.sum(F.col("neg").cast("double") * (2 * F.col("tp") - F.col("pos"))).alias("inner"))
    higher = Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1)    # over bins, not rows
    per_bin = per_bin.withColumn("before", F.coalesce(F.sum("pos").over(higher), F.lit(0)))
    area = F.sum(F.col("inner") + F.col("neg").cast("double") * 2 * F.col("before"))
    total = per_bin.agg(area.alias("area"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return total.select(F.when((F.col("p") > 0) & (F.col("n") > 0), F.col("area") / (F.lit(2.0) * F.col("p") * F.col("n"))).alias("auc"))


def roc_points(pred: DataFrame, score: str = "score", label: str = "label", positive: float = 1.0, points: int = 1000) -> DataFrame:
    """At most ``points`` + 2 points of the ROC curve: (threshold, tp, fp, tpr, fpr), counts of scores >= the threshold.

    The thresholds part the range of the scores evenly; empty steps are left
    out. One aggregation, however many scores differ.
    """
    rows, low, high = _score_bins(pred, score, label, positive, points)
    step = (high - low) / points if low is not None else 0.0
    per_bin = rows.groupBy("bin").agg(F.sum("hit").alias("pos"), F.sum(1 - F.col("hit")).alias("neg"))
    down, whole = Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0), Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    edge = F.when(F.col("bin") == 0, F.lit(None)).when(F.col("bin") > points, F.lit(float("nan"))).otherwise(F.lit(low) + (F.col("bin") - 1) * F.lit(step))
    sums = per_bin.select(edge.cast("double").alias("threshold"), *[F.sum(c).over(w).alias(f"{n}{c}") for c in ("pos", "neg") for n, w in (("", down), ("all_", whole))])
    return sums.select("threshold", F.col("pos").alias("tp"), F.col("neg").alias("fp"), F.try_divide("pos", "all_pos").alias("tpr"), F.try_divide("neg", "all_neg").alias("fpr"))


def auc(pred: DataFrame, score: str = "score", label: str = "label", positive: float = 1.0) -> float | None:
    return roc_area(pred, score, label, positive).first()["auc"]


# ---------------------------------------------------------------- confusion-based
def confusion_matrix(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                     classes: Sequence[float] = (0.0, 1.0), prefix: str = "pred_") -> DataFrame:
    """Rows = true label, one column per predicted class (given explicitly,
    so a never-predicted class still gets its column), zeros filled (A5).

    Predictions outside ``classes`` get columns of their own, null ones
    ``<prefix>null``, so the cells always sum to the rows."""
    cells = checkpointed(pred.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n")))   # one row per cell
    seen = [r[0] for r in cells.select(prediction).distinct().collect()]
    more = sorted(float(x) for x in seen if x is not None and float(x) not in {float(c) for c in classes})
    name = lambda c: f"{prefix}{int(c)}" if float(c).is_integer() else f"{prefix}{c}"
    of = [F.sum(F.when(F.col(prediction) == F.lit(float(c)), F.col("n")).otherwise(0)).cast("long").alias(name(c))
          for c in [*classes, *more]]
    if None in seen:
        of.append(F.sum(F.when(F.col(prediction).isNull(), F.col("n")).otherwise(0)).cast("long").alias(f"{prefix}null"))
    return cells.groupBy(label).agg(*of).orderBy(label)


def classification_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """accuracy, weighted precision / recall / F1 (weights = true-class
    shares), one row. Precision or recall with an empty denominator is 0,
    F1 of a class with p + r = 0 is 0 (E2, E3)."""
    cells = pred.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))
    per_label = cells.groupBy(F.col(label).alias("c")).agg(
        F.sum("n").alias("n_true"), F.sum(F.when(F.col(label) == F.col(prediction), F.col("n")).otherwise(0)).alias("tp"))
    per_pred = cells.groupBy(F.col(prediction).alias("c")).agg(F.sum("n").alias("n_pred"))
    j = per_label.join(per_pred, "c", "left").fillna(0, ["n_pred"])
    prec = F.when(F.col("n_pred") > 0, F.col("tp") / F.col("n_pred")).otherwise(F.lit(0.0))
    rec = F.when(F.col("n_true") > 0, F.col("tp") / F.col("n_true")).otherwise(F.lit(0.0))
    j = j.select("n_true", "tp", prec.alias("p"), rec.alias("r"))
    f1 = F.when(F.col("p") + F.col("r") > 0, F.lit(2.0) * F.col("p") * F.col("r") / (F.col("p") + F.col("r"))) \
        .otherwise(F.lit(0.0))
    tot = F.sum("n_true")
    return j.agg(
        (F.sum("tp") / tot).alias("accuracy"),
        (F.sum(F.col("n_true") * F.col("p")) / tot).alias("weighted_precision"),
        (F.sum(F.col("n_true") * F.col("r")) / tot).alias("weighted_recall"),
        (F.sum(F.col("n_true") * f1) / tot).alias("weighted_f1"))


# ---------------------------------------------------------------- clustering
def _cluster_stats(df: DataFrame, cols: Sequence[str], cluster: str) -> list[dict]:
    aggs = [F.count(F.lit(1)).alias("_n"),
            F.sum(sum((F.col(c).cast("double") * F.col(c).cast("double") for c in cols), F.lit(0.0))).alias("_q")]
    aggs += [F.sum(F.col(c).cast("double")).alias(f"_s{j}") for j, c in enumerate(cols)]
    rows = df.groupBy(cluster).agg(*aggs).collect()
    return [{"id": r[cluster], "n": r["_n"], "q": r["_q"], "s": [r[f"_s{j}"] for j in range(len(cols))]}
            for r in rows]


def silhouette(assigned: DataFrame, cols: Sequence[str], cluster: str = "prediction") -> DataFrame:
    """Mean silhouette with squared Euclidean distance, closed form.

    Per-cluster count, vector sum and squared-norm sum (k rows) give every
    point's mean squared distance to each cluster as
    ||x||² - 2·x·S_c/n_c + Q_c/n_c, so one map pass plus one average does
    the whole metric: no pairwise distances. Own-cluster distance excludes
    the point itself; a point alone in its cluster scores 0. Null when fewer
    than two clusters are non-empty.
    """
    stats = _cluster_stats(assigned, cols, cluster)
    if len(stats) < 2:
        return assigned.sparkSession.createDataFrame([(None,)], StructType([StructField("silhouette", DoubleType())]))
    x = [F.col(c).cast("double") for c in cols]
    norm2 = sum((v * v for v in x), F.lit(0.0))

    def dist(st) -> Column:
        dot = sum((v * F.lit(float(s)) for v, s in zip(x, st["s"])), F.lit(0.0))
        return norm2 - F.lit(2.0) * dot / F.lit(float(st["n"])) + F.lit(float(st["q"]) / st["n"])

    cid = F.col(cluster)
    own = None
    size = None
    other = None
    for st in stats:
        d = dist(st)
        own = (F.when(cid == F.lit(st["id"]), d) if own is None else own.when(cid == F.lit(st["id"]), d))
        size = (F.when(cid == F.lit(st["id"]), F.lit(float(st["n"]))) if size is None
                else size.when(cid == F.lit(st["id"]), F.lit(float(st["n"]))))
        o = F.when(cid != F.lit(st["id"]), d)
        other = o if other is None else F.least(other, o)
    a = own * size / (size - F.lit(1.0))
    b = other
    s = (F.when(size <= 1.0, F.lit(0.0))
          .when(a < b, F.lit(1.0) - a / b)
          .when(a > b, b / a - F.lit(1.0))
          .otherwise(F.lit(0.0)))
    return assigned.select(s.alias("_s")).agg(F.avg("_s").alias("silhouette"))


def wssse(assigned: DataFrame, cols: Sequence[str], cluster: str = "prediction") -> DataFrame:
    """Within-cluster sum of squared distances to each cluster's mean (E8): sum of n * var_pop, one aggregation."""
    per = assigned.groupBy(cluster).agg(*[(F.count(F.col(c)) * F.var_pop(F.col(c).cast("double"))).alias(f"_v{j}") for j, c in enumerate(cols)])
    return per.agg(F.sum(sum((F.col(f"_v{j}") for j in range(len(cols))), F.lit(0.0))).alias("wssse"))
