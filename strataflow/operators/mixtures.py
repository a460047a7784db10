"""Bisecting k-means and Gaussian mixtures with distributed moments.

A round is one aggregation over all rows: counts, sums (and products) per
cluster, combined map-side; the driver turns at most clusters x d x d sums
into the next centres or Gaussians. Assignment is a map-only expression.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from ..session import checkpointed


def standardised(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> tuple[DataFrame, dict[str, tuple[float, float]]]:
    """(keep..., z0, z1, ...) of the rows without null cells, checkpointed, and the (mean, sd) of each column; a constant column becomes 0."""
    whole = df.select(*keep, *[F.col(c).cast("double").alias(f"z{i}") for i, c in enumerate(columns)]).dropna(subset=[f"z{i}" for i in range(len(columns))])
    r = whole.agg(*[F.avg(f"z{i}").alias(f"m{i}") for i in range(len(columns))], *[F.stddev_samp(f"z{i}").alias(f"s{i}") for i in range(len(columns))]).first()
    scale = {c: (r[f"m{i}"] or 0.0, r[f"s{i}"] or 0.0) for i, c in enumerate(columns)}
    z = [((F.col(f"z{i}") - F.lit(m)) / F.lit(s) if s > 0 else F.lit(0.0)).alias(f"z{i}") for i, (m, s) in enumerate(scale.values())]
    return checkpointed(whole.select(*keep, *z)), scale


def _squared(z: Sequence[str], centre: Sequence[float]) -> Column:
    return sum(((F.col(c) - F.lit(float(v))) * (F.col(c) - F.lit(float(v))) for c, v in zip(z, centre, strict=True)), F.lit(0.0))


# ---------------------------------------------------------------- bisecting k-means
@dataclass
class Cluster:
    """Node of the hierarchy (1 the root, 2 i and 2 i + 1 the children of i): rows, centre, sum of squared distances to it."""

    id: int
    n: int
    centre: list[float]
    cost: float
    kids: bool = False


@dataclass
class Bisection:
    z: list[str]
    nodes: dict[int, Cluster]

    def path(self, depth: int) -> Column:
        """Node id of a row at the given depth (or the leaf it ends in above)."""
        def walk(at: int, left: int) -> Column:
            node = self.nodes[at]
            if not node.kids or left == 0:
                return F.lit(at)
            one, two = self.nodes[2 * at], self.nodes[2 * at + 1]
            return F.when(_squared(self.z, one.centre) <= _squared(self.z, two.centre), walk(2 * at, left - 1)).otherwise(walk(2 * at + 1, left - 1))
        return walk(1, depth)

    def depth(self) -> int:
        return max(self.nodes).bit_length() - 1


def _moments(rows: DataFrame, key: Column, z: Sequence[str]) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """Per key: count, sums, sums of squares."""
    found = rows.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(f"s_{c}") for c in z], *[F.sum(F.col(c) * F.col(c)).alias(f"q_{c}") for c in z]).collect()
    return {r["key"]: (r["n"], np.array([r[f"s_{c}"] for c in z]), np.array([r[f"q_{c}"] for c in z])) for r in found}


def _cluster(at: int, n: int, s: np.ndarray, q: np.ndarray) -> Cluster:
    return Cluster(at, n, (s / n).tolist(), float(max(0.0, (q - s * s / n).sum())))


def bisect(rows: DataFrame, z: Sequence[str], depth: int = 2, rounds: int = 10, least: int = 2) -> Bisection:
    """Split all clusters of a level in two, level by level, by ``rounds`` Lloyd rounds each, ``depth`` levels.

    The two centres start one standard deviation to either side of the mean,
    along the column that varies most (the first of equals). A cluster stays a
    leaf when it has fewer than ``least`` rows, no spread, or a split leaves
    one side empty. A row lies in the child of the nearer centre, ties to the
    first. No rows: a ValueError.
    """
    z = list(z)
    found = _moments(rows, F.lit(1), z)
    if not found:
        raise ValueError("no rows to cluster")
    model = Bisection(z, {1: _cluster(1, *found[1])})
    level, spread = [1], {1: found[1]}
    for step in range(depth):
        pairs: dict[int, tuple[list[float], list[float]]] = {}
        for at in level:
            n, s, q = spread[at]
            variance = np.maximum(0.0, q / n - (s / n) ** 2)
            j = int(np.argmax(np.round(variance, 9)))
            if n >= least and variance[j] > 1e-12:
                shift = np.zeros(len(z))
                shift[j] = math.sqrt(variance[j])
                pairs[at] = ((s / n - shift).tolist(), (s / n + shift).tolist())
        if not pairs:
            break
        own = rows.withColumn("_at", model.path(step))
        for _ in range(rounds):
            child = F.lit(None).cast("int")
            for at, (one, two) in pairs.items():
                child = F.when(F.col("_at") == at, F.when(_squared(z, one) <= _squared(z, two), 2 * at).otherwise(2 * at + 1)).otherwise(child)
            found = _moments(own.where(F.col("_at").isin(list(pairs))), child, z)
            pairs = {at: tuple((found[k][1] / found[k][0]).tolist() for k in (2 * at, 2 * at + 1)) for at in pairs if 2 * at in found and 2 * at + 1 in found}
        for at, (one, two) in pairs.items():
            # children as the last centres deal the rows out
            model.nodes[2 * at], model.nodes[2 * at + 1] = (Cluster(2 * at + i, 0, c, 0.0) for i, c in enumerate((one, two)))
            model.nodes[at].kids = True
        spread = {k: v for k, v in _moments(rows, model.path(step + 1), z).items() if k >= 2 << step}
        level = []
        for at in pairs:
            sides = [2 * at + i for i in (0, 1)]
            for k in sides:
                n, s, q = spread.get(k, (0, np.zeros(len(z)), np.zeros(len(z))))
                centre = np.array(model.nodes[k].centre)
                model.nodes[k].n, model.nodes[k].cost = n, float(max(0.0, (q - 2 * centre * s + n * centre * centre).sum()))
            level += [k for k in sides if k in spread]
    return model


def bisection_table(df: DataFrame, model: Bisection) -> DataFrame:
    """(node, parent, level, n, cost, z0, z1, ...)."""
    schema = StructType([StructField("node", IntegerType()), StructField("parent", IntegerType()), StructField("level", IntegerType()), StructField("n", LongType()),
                         StructField("cost", DoubleType()), *[StructField(c, DoubleType()) for c in model.z]])
    rows = [(k, k // 2 or None, k.bit_length() - 1, c.n, c.cost, *map(float, c.centre)) for k, c in sorted(model.nodes.items())]
    return df.sparkSession.createDataFrame(rows, schema)


# ---------------------------------------------------------------- Gaussian mixture
@dataclass
class Mixture:
    z: list[str]
    weights: np.ndarray
    means: np.ndarray
    covariances: np.ndarray
    rounds: list[tuple[int, float]]

    def log_densities(self) -> list[Column]:
        """log(weight) + log density of each component."""
        d, out = len(self.z), []
        for w, m, c in zip(self.weights, self.means, self.covariances, strict=True):
            inverse = np.linalg.inv(c)
            base = math.log(w) - 0.5 * (d * math.log(2 * math.pi) + math.log(np.linalg.det(c))) if w > 0 else -1e300
            x = [F.col(z) - F.lit(float(v)) for z, v in zip(self.z, m, strict=True)]
            form = sum((F.lit(float(inverse[i, j]) * (1.0 if i == j else 2.0)) * x[i] * x[j] for i in range(d) for j in range(i, d)), F.lit(0.0))
            out.append(F.lit(base) - F.lit(0.5) * form)
        return out

    def respond(self, rows: DataFrame) -> DataFrame:
        """Rows with l0, l1, ... (log densities), log_p (of the mixture) and r0, r1, ... (responsibilities, sum 1); map-only."""
        k = range(len(self.weights))
        out = rows.select("*", *[c.alias(f"l{i}") for i, c in enumerate(self.log_densities())])
        high = F.greatest(*[F.col(f"l{i}") for i in k]) if len(k) > 1 else F.col("l0")
        out = out.withColumn("_high", high)
        out = out.withColumn("log_p", F.col("_high") + F.log(sum((F.exp(F.col(f"l{i}") - F.col("_high")) for i in k), F.lit(0.0)))).drop("_high")
        return out.select("*", *[F.exp(F.col(f"l{i}") - F.col("log_p")).alias(f"r{i}") for i in k])


def fit_mixture(rows: DataFrame, z: Sequence[str], k: int = 3, rounds: int = 20, floor: float = 1e-6, tolerance: float = 0.0) -> Mixture:
    """Expectation maximisation with full covariances.

    Starts with equal weights, the whole covariance, and means on the line of
    the mean plus (2 i + 1 - k) / k standard deviations of each column. Every
    round keeps the mean log-likelihood it began with. ``floor`` is added to
    the variances. Rounds end early when the likelihood gains less than
    ``tolerance``. No rows: a ValueError.
    """
    z, d = list(z), len(z)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    first = rows.agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(f"s{i}") for i, c in enumerate(z)], *[F.sum(F.col(z[i]) * F.col(z[j])).alias(f"p{i}_{j}") for i, j in pairs]).first()
    if not first["n"]:
        raise ValueError("no rows to fit")

    def gaussian(n: float, s: np.ndarray, p: dict) -> tuple[np.ndarray, np.ndarray]:
        mean, c = s / n, np.zeros((d, d))
        for i, j in pairs:
            c[i, j] = c[j, i] = p[i, j] / n - mean[i] * mean[j]
        return mean, c + floor * np.eye(d)

    mean, c = gaussian(first["n"], np.array([first[f"s{i}"] for i in range(d)]), {(i, j): first[f"p{i}_{j}"] for i, j in pairs})
    model = Mixture(z, np.full(k, 1 / k), np.array([mean + (2 * i + 1 - k) / k * np.sqrt(np.diag(c)) for i in range(k)]), np.array([c] * k), [])
    for number in range(rounds + 1):
        step = model.respond(rows)
        sums = [F.sum("log_p").alias("ll")]
        for a in range(k):
            r = F.col(f"r{a}")
            sums += [F.sum(r).alias(f"n{a}"), *[F.sum(r * F.col(z[i])).alias(f"s{a}_{i}") for i in range(d)], *[F.sum(r * F.col(z[i]) * F.col(z[j])).alias(f"p{a}_{i}_{j}") for i, j in pairs]]
        out = step.agg(*sums).first()
        model.rounds.append((number, out["ll"] / first["n"]))
        if number == rounds or number and model.rounds[-1][1] - model.rounds[-2][1] < tolerance:
            return model
        for a in range(k):
            n = out[f"n{a}"]
            model.weights[a] = n / first["n"]
            if n > 1e-9:
                model.means[a], model.covariances[a] = gaussian(n, np.array([out[f"s{a}_{i}"] for i in range(d)]), {(i, j): out[f"p{a}_{i}_{j}"] for i, j in pairs})
    return model


def mixture_table(df: DataFrame, model: Mixture) -> DataFrame:
    """(component, name, value): weight, m_i and c_i_j (i <= j) of each component."""
    d = len(model.z)
    rows = []
    for a in range(len(model.weights)):
        rows.append((a, "weight", float(model.weights[a])))
        rows += [(a, f"m_{i}", float(model.means[a][i])) for i in range(d)]
        rows += [(a, f"c_{i}_{j}", float(model.covariances[a][i, j])) for i in range(d) for j in range(i, d)]
    return df.sparkSession.createDataFrame(rows, StructType([StructField("component", IntegerType()), StructField("name", StringType()), StructField("value", DoubleType())]))


def likelihood_table(df: DataFrame, model: Mixture) -> DataFrame:
    """(round, log_likelihood): the mean that each round began with."""
    return df.sparkSession.createDataFrame([(i, float(v)) for i, v in model.rounds], StructType([StructField("round", IntegerType()), StructField("log_likelihood", DoubleType())]))
