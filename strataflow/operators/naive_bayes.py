"""Naive Bayes with categorical and numeric columns.

One aggregation over the stacked columns gives, per class, the count of every
category and the moments of every numeric column: a table of
classes x categories rows, whatever the data. Scoring is map-only.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

#: Rows of the fitted table that the driver takes; a column with more categories is not for naive Bayes.
MAX_ROWS = 100_000


@dataclass(frozen=True)
class BayesModel:
    """Per class its log prior, per (class, column) the log probability of each category (and of an unseen one), or mean and variance."""

    smoothing: float
    prior: dict[str, float]
    categories: dict[str, dict[str, dict[str, float]]]   # column -> class -> category -> log probability
    unseen: dict[str, dict[str, float]]
    moments: dict[str, dict[str, tuple[float, float]]]    # column -> class -> (mean, variance)


def _stacked(df: DataFrame, label: str, categorical: Sequence[str], numeric: Sequence[str]) -> DataFrame:
    """(label, column, category, number): one row per column and row."""
    text, number = F.lit(None).cast("string"), F.lit(None).cast("double")
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("category"), number.alias("number")) for c in categorical]
    cells += [F.struct(F.lit(c).alias("column_name"), text.alias("category"), F.col(c).cast("double").alias("number")) for c in numeric]
    return df.where(F.col(label).isNotNull()).select(F.col(label).cast("string").alias("label"), F.explode(F.array(*cells)).alias("x")).select("label", "x.*")


def fit(df: DataFrame, label: str, categorical: Sequence[str] = (), numeric: Sequence[str] = (), smoothing: float = 1.0) -> BayesModel:
    """Fit on all rows with a label. Null cells are left out of their column's counts; a column constant within a class gets a small variance."""
    rows = (_stacked(df, label, categorical, numeric).where("category is not null or number is not null").groupBy("label", "column_name", "category")
            .agg(F.count(F.lit(1)).alias("n"), F.avg("number").alias("mean"), F.var_pop("number").alias("variance")).limit(MAX_ROWS + 1).collect())
    if len(rows) > MAX_ROWS:
        raise ValueError(f"more than {MAX_ROWS} categories")
    size = {r["label"]: r["n"] for r in df.where(F.col(label).isNotNull()).groupBy(F.col(label).cast("string").alias("label")).agg(F.count(F.lit(1)).alias("n")).collect()}
    whole = sum(size.values())
    prior = {c: math.log((n + smoothing) / (whole + smoothing * len(size))) for c, n in size.items()}
    categories: dict = {c: {k: {} for k in size} for c in categorical}
    moments: dict = {c: {} for c in numeric}
    for r in rows:
        if r["column_name"] in categories:
            categories[r["column_name"]][r["label"]][r["category"]] = r["n"]
        else:
            moments[r["column_name"]][r["label"]] = (r["mean"], max(r["variance"], 1e-9))
    unseen: dict = {c: {} for c in categorical}
    for c, of in categories.items():
        levels = {v for counts in of.values() for v in counts}
        for k, counts in of.items():
            total = sum(counts.values()) + smoothing * len(levels)
            of[k] = {v: math.log((counts.get(v, 0) + smoothing) / total) if counts.get(v, 0) + smoothing > 0 else -math.inf for v in levels}
            unseen[c][k] = math.log(smoothing / total) if smoothing > 0 and total > 0 else -math.inf
    return BayesModel(smoothing, prior, categories, unseen, moments)


def joint(model: BayesModel, label: str) -> Column:
    """log P(label) + sum of log P(cell | label); null cells add nothing."""
    out = F.lit(model.prior[label])
    for c, of in model.categories.items():
        known = F.create_map(*[F.lit(x) for v, p in sorted(of[label].items()) for x in (v, p)]) if of[label] else F.lit(None).cast("map<string,double>")
        value = F.col(c).cast("string")
        out = out + F.when(value.isNull(), 0.0).otherwise(F.coalesce(F.try_element_at(known, value), F.lit(model.unseen[c][label])))
    for c, of in model.moments.items():
        if label in of:
            mean, variance = of[label]
            x = F.col(c).cast("double")
            density = F.lit(-0.5 * math.log(2 * math.pi * variance)) - (x - F.lit(mean)) * (x - F.lit(mean)) / F.lit(2 * variance)
            out = out + F.coalesce(density, F.lit(0.0))
    return out


def score(df: DataFrame, model: BayesModel, positive: str) -> DataFrame:
    """Rows with log_odds (positive against the best other class) and prediction (ties to the alphabetically first class)."""
    classes = sorted(model.prior)
    best = F.array_max(F.array(*[F.struct(joint(model, k).alias("score"), F.lit(-i).alias("order"), F.lit(k).alias("label")) for i, k in enumerate(classes)]))
    others = [joint(model, k) for k in classes if k != positive]
    odds = joint(model, positive) - (F.greatest(*others) if len(others) > 1 else others[0]) if others else F.lit(0.0)
    return df.withColumn("log_odds", odds).withColumn("prediction", best["label"])


def model_table(df: DataFrame, model: BayesModel) -> DataFrame:
    """(label, column_name, category, value): log priors (column ''), log probabilities, and 'mean' and 'variance' of numeric columns."""
    rows = [(k, "", "", p) for k, p in model.prior.items()]
    rows += [(k, c, v, p) for c, of in model.categories.items() for k, ps in of.items() for v, p in ps.items()]
    rows += [(k, c, what, x) for c, of in model.moments.items() for k, mv in of.items() for what, x in zip(("mean", "variance"), mv, strict=True)]
    schema = StructType([StructField(n, StringType()) for n in ("label", "column_name", "category")] + [StructField("value", DoubleType())])
    return df.sparkSession.createDataFrame(rows, schema)


def confusion(scored: DataFrame, label: str) -> DataFrame:
    return scored.groupBy(F.col(label).alias("label"), "prediction").agg(F.count(F.lit(1)).cast(LongType()).alias("n"))
