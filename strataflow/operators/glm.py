"""Linear, logistic and generalised linear regression by iteratively reweighted least squares.

Every round is one aggregation over the rows: the d x d curvature X'WX, the
vector X'Wz and the deviance are sums of built-in expressions, added up
map-side, so a round shuffles one row per task whatever the data. The d x d
system is solved on the driver. Rows are never collected, and no key is
shuffled. Gaussian with the identity link needs one such round: the normal
equations.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from ..session import checkpointed

INTERCEPT = "intercept"


@dataclass(frozen=True)
class Family:
    """A distribution with its link g. Expressions in the linear predictor eta, the mean mu and the response y."""

    name: str
    link: Callable[[float], float]              # g(mean), for the start
    mean: Callable[[Column], Column]            # mu of eta
    slope: Callable[[Column], Column]           # dg/dmu at mu
    variance: Callable[[Column], Column]        # of mu
    deviance: Callable[[Column, Column], Column]  # of one row (y, mu)
    one_round: bool = False
    #: (weight, weight * residual) of (y, eta), where they do not follow from slope and variance
    working: Callable[[Column, Column], tuple[Column, Column]] | None = None


def _xlogx(y: Column, over: Column) -> Column:
    return F.when(y > 0, y * F.log(y / over)).otherwise(F.lit(0.0))


GAUSSIAN = Family("gaussian", lambda m: m, lambda eta: eta, lambda mu: F.lit(1.0), lambda mu: F.lit(1.0),
                  lambda y, mu: (y - mu) * (y - mu), one_round=True)
BINOMIAL = Family("binomial", lambda m: math.log(m / (1 - m)), lambda eta: F.lit(1.0) / (F.lit(1.0) + F.exp(-eta)),
                  lambda mu: F.lit(1.0) / (mu * (F.lit(1.0) - mu)), lambda mu: mu * (F.lit(1.0) - mu),
                  lambda y, mu: F.lit(-2.0) * F.when(y > 0.5, F.log(mu)).otherwise(F.log(F.lit(1.0) - mu)))
POISSON = Family("poisson", math.log, F.exp, lambda mu: F.lit(1.0) / mu, lambda mu: mu,
                 lambda y, mu: F.lit(2.0) * (_xlogx(y, mu) - (y - mu)))
GAMMA = Family("gamma", math.log, F.exp, lambda mu: F.lit(1.0) / mu, lambda mu: mu * mu,
               lambda y, mu: F.lit(2.0) * ((y - mu) / mu - F.log(y / mu)))


def _side(y: Column) -> Column:
    return F.lit(2.0) * y - F.lit(1.0)


def _short(y: Column, eta: Column) -> Column:
    """Whether a row is inside the margin."""
    return F.when(_side(y) * eta < 1.0, 1.0).otherwise(0.0)


#: Support vector classifier: mean squared hinge loss max(0, 1 - s eta)^2 with s = +1 or -1; every round solves for the rows inside the margin.
HINGE = Family("hinge", lambda m: 0.0, lambda eta: eta, lambda mu: F.lit(1.0), lambda mu: F.lit(1.0),
               lambda y, mu: _short(y, mu) * (F.lit(1.0) - _side(y) * mu) * (F.lit(1.0) - _side(y) * mu),
               working=lambda y, eta: (_short(y, eta), _short(y, eta) * (_side(y) - eta)))


@dataclass
class GlmFit:
    """A fitted model: coefficients by term (the intercept first), what each round began with, and sums at the end."""

    family: Family
    terms: list[str]
    coefficients: np.ndarray
    rounds: list[tuple[int, float]]
    n: int
    curvature: np.ndarray
    gradient: np.ndarray
    deviance: float
    total: float = field(default=float("nan"))   # deviance around the mean

    def dispersion(self) -> float:
        """Residual deviance a degree of freedom (the variance estimate of the Gaussian family)."""
        return self.deviance / max(1, self.n - len(self.terms))

    def errors(self) -> np.ndarray:
        """Standard errors of the coefficients."""
        scale = 1.0 if self.family.name in ("binomial", "poisson") else self.dispersion()
        return np.sqrt(np.maximum(0.0, np.diag(np.linalg.pinv(self.curvature)) * scale))


def dummies(column: str, levels: Sequence[str]) -> dict[str, Column]:
    """One 0/1 term per level; leave one level out as the reference."""
    return {f"{column}={v}": F.when(F.col(column) == v, 1.0).otherwise(0.0) for v in levels}


def predictor(terms: Sequence[str], coefficients: Sequence[float], x: Callable[[str], Column]) -> Column:
    return sum((F.lit(float(b)) * x(t) for t, b in zip(terms[1:], coefficients[1:], strict=True)), F.lit(float(coefficients[0])))


def _sums(design: DataFrame, terms: list[str], family: Family, beta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """(X'WX, X'Wz, gradient X'W(y - mu) g', deviance) at beta, in one aggregation."""
    d = len(terms)
    x = [F.lit(1.0), *(F.col(f"x{i}") for i in range(1, d))]
    step = design.withColumn("eta", predictor(terms, beta, lambda t: x[terms.index(t)]))
    step = step.withColumn("mu", family.mean(F.col("eta")))
    if family.working:
        w, r = family.working(F.col("y"), F.col("eta"))
        step = step.withColumn("w", w).withColumn("r", r)
    else:
        step = step.withColumn("slope", family.slope(F.col("mu")))
        step = step.withColumn("w", F.lit(1.0) / (F.col("slope") * F.col("slope") * family.variance(F.col("mu"))))
        step = step.withColumn("r", F.col("w") * (F.col("y") - F.col("mu")) * F.col("slope"))
    z = F.col("r") + F.col("w") * F.col("eta")
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    out = step.agg(*[F.sum(F.col("w") * x[i] * x[j]).alias(f"c{i}_{j}") for i, j in pairs], *[F.sum(z * x[i]).alias(f"b{i}") for i in range(d)],
                   *[F.sum(F.col("r") * x[i]).alias(f"g{i}") for i in range(d)], F.sum(family.deviance(F.col("y"), F.col("mu"))).alias("dev")).first()
    curvature = np.zeros((d, d))
    for i, j in pairs:
        curvature[i, j] = curvature[j, i] = out[f"c{i}_{j}"]
    return curvature, np.array([out[f"b{i}"] for i in range(d)]), np.array([out[f"g{i}"] for i in range(d)]), float(out["dev"])


def fit(df: DataFrame, y: Column, terms: Mapping[str, Column], family: Family = GAUSSIAN, ridge: float = 0.0,
        max_rounds: int = 25, tolerance: float = 1e-12) -> GlmFit:
    """Fit by IRLS on all rows whose response and terms are not null.

    ``ridge`` penalises n * ridge / 2 * sum((sd_j b_j)^2), the intercept left
    out: the size of a coefficient is judged on its column's scale. Rounds
    end when the penalised deviance changes by less than ``tolerance`` of
    itself. Collinear terms get the shortest solution. No rows: an error.
    """
    names = [INTERCEPT, *terms]
    design = df.select(y.cast("double").alias("y"), *[c.cast("double").alias(f"x{i}") for i, c in enumerate(terms.values(), 1)]).dropna()
    design = checkpointed(design)
    d = len(names)
    start = design.agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("mean"), *[F.var_pop(f"x{i}").alias(f"v{i}") for i in range(1, d)]).first()
    n = int(start["n"])
    if n == 0:
        raise ValueError("no complete rows to fit")
    penalty = np.diag([0.0, *(n * ridge * float(start[f"v{i}"]) for i in range(1, d))])
    beta = np.zeros(d)
    beta[0] = family.link(float(start["mean"]))
    rounds: list[tuple[int, float]] = []
    before = total = float("nan")
    for number in range(max_rounds + 1):
        curvature, right, score, deviance = _sums(design, names, family, beta)
        total = deviance if number == 0 else total      # the start is the mean alone
        rounds.append((number, deviance))
        judged = deviance + beta @ penalty @ beta
        if number and (family.one_round or abs(before - judged) < tolerance * (abs(judged) + tolerance)) or number == max_rounds:
            break
        before = judged
        beta = np.linalg.lstsq(curvature + penalty, right, rcond=None)[0]
    return GlmFit(family, names, beta, rounds, n, curvature + penalty, score - penalty @ beta, deviance, total)


def scored(df: DataFrame, model: GlmFit, terms: Mapping[str, Column], output: str = "mu") -> DataFrame:
    """Rows with the model's mean; map-only."""
    return df.withColumn(output, model.family.mean(predictor(model.terms, model.coefficients, lambda t: terms[t].cast("double"))))


def coefficient_table(df: DataFrame, model: GlmFit) -> DataFrame:
    """(idx, term, coefficient, std_error, gradient a row)."""
    schema = StructType([StructField("idx", IntegerType()), StructField("term", StringType()), StructField("coefficient", DoubleType()),
                         StructField("std_error", DoubleType()), StructField("gradient", DoubleType())])
    rows = zip(range(len(model.terms)), model.terms, model.coefficients.tolist(), model.errors().tolist(), (model.gradient / model.n).tolist(), strict=True)
    return df.sparkSession.createDataFrame(list(rows), schema)


def rounds_table(df: DataFrame, model: GlmFit) -> DataFrame:
    """(family, round, deviance): what each round began with."""
    schema = StructType([StructField("family", StringType()), StructField("round", IntegerType()), StructField("deviance", DoubleType())])
    return df.sparkSession.createDataFrame([(model.family.name, i, d) for i, d in model.rounds], schema)


def regression_report(df: DataFrame, model: GlmFit, y: Column, terms: Mapping[str, Column]) -> DataFrame:
    """One row over all scored rows: n, r2, rmse, mae."""
    s = scored(df.withColumn("_y", y.cast("double")), model, terms, "_mu").where("_y is not null and _mu is not null")
    err = F.col("_y") - F.col("_mu")
    return s.agg(F.count(F.lit(1)).cast(LongType()).alias("n"), (F.lit(1.0) - F.sum(err * err) / (F.var_pop("_y") * F.count(F.lit(1)))).alias("r2"),
                 F.sqrt(F.avg(err * err)).alias("rmse"), F.avg(F.abs(err)).alias("mae"))


def classifier_report(df: DataFrame, model: GlmFit, y: Column, terms: Mapping[str, Column], threshold: float = 0.5) -> DataFrame:
    """One row over all scored rows: n, log_loss, and the confusion counts at the threshold."""
    s = scored(df.withColumn("_y", y.cast("double")), model, terms, "_mu").where("_y is not null and _mu is not null")
    yes, one = F.col("_mu") >= threshold, F.col("_y") > 0.5
    count = lambda c, name: F.sum(F.when(c, 1).otherwise(0)).cast(LongType()).alias(name)
    return s.agg(F.count(F.lit(1)).alias("n"), (F.avg(BINOMIAL.deviance(F.col("_y"), F.col("_mu"))) / 2).alias("log_loss"),
                 count(yes & one, "tp"), count(yes & ~one, "fp"), count(~yes & ~one, "tn"), count(~yes & one, "fn"))
