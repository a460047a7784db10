"""Multilayer perceptron (one hidden layer, logistic output) by full-batch back-propagation.

A round is one aggregation: every row's gradient of all weights is a set of
built-in expressions, added up map-side, so a round shuffles one row per
task. The driver holds the weights, hidden x (inputs + 2) + 1 numbers.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


@dataclass
class Perceptron:
    """Inner weights (hidden x (inputs + 1), the bias first), outer weights (hidden + 1, the bias first)."""

    z: list[str]
    inner: np.ndarray
    outer: np.ndarray
    losses: list[tuple[int, float]]

    def hidden(self) -> list[Column]:
        return [sigmoid(sum((F.lit(float(w)) * F.col(c) for w, c in zip(row[1:], self.z, strict=True)), F.lit(float(row[0])))) for row in self.inner]

    def predict(self) -> Column:
        """Probability of class 1; map-only."""
        return sigmoid(sum((F.lit(float(w)) * h for w, h in zip(self.outer[1:], self.hidden(), strict=True)), F.lit(float(self.outer[0]))))


def start_weights(inputs: int, hidden: int) -> tuple[np.ndarray, np.ndarray]:
    """Fixed start: cosines of the weight's number, so that hidden units differ and a fit repeats exactly."""
    inner = np.array([[math.cos(1.0 + j * (inputs + 1) + i) for i in range(inputs + 1)] for j in range(hidden)])
    return inner, np.array([0.0, *(math.cos(2.0 + j) for j in range(hidden))])


def fit(rows: DataFrame, z: Sequence[str], y: str = "y", hidden: int = 4, rounds: int = 100, rate: float = 1.0, momentum: float = 0.5) -> Perceptron:
    """Gradient descent with momentum on the mean log loss over all rows; ``z`` are standardised columns, ``y`` is 0 or 1.

    Keeps the loss that every round began with. No rows: a ValueError.
    """
    z = list(z)
    inner, outer = start_weights(len(z), hidden)
    model, speed_in, speed_out = Perceptron(z, inner, outer, []), np.zeros_like(inner), np.zeros_like(outer)
    for number in range(rounds + 1):
        step = rows.select(*z, F.col(y).alias("_y"), *[h.alias(f"_h{j}") for j, h in enumerate(model.hidden())])
        h = [F.col(f"_h{j}") for j in range(hidden)]
        step = step.withColumn("_p", sigmoid(sum((F.lit(float(w)) * x for w, x in zip(model.outer[1:], h, strict=True)), F.lit(float(model.outer[0])))))
        miss = F.col("_p") - F.col("_y")
        sums = [F.count(F.lit(1)).alias("n"), F.sum(-F.when(F.col("_y") > 0.5, F.log("_p")).otherwise(F.log(F.lit(1.0) - F.col("_p")))).alias("loss"), F.sum(miss).alias("o0")]
        for j in range(hidden):
            back = miss * F.lit(float(model.outer[j + 1])) * h[j] * (F.lit(1.0) - h[j])
            sums += [F.sum(miss * h[j]).alias(f"o{j + 1}"), F.sum(back).alias(f"i{j}_0"), *[F.sum(back * F.col(c)).alias(f"i{j}_{i + 1}") for i, c in enumerate(z)]]
        out = step.agg(*sums).first()
        if not out["n"]:
            raise ValueError("no rows to fit")
        model.losses.append((number, out["loss"] / out["n"]))
        if number < rounds:
            speed_in = momentum * speed_in - rate * np.array([[out[f"i{j}_{i}"] / out["n"] for i in range(len(z) + 1)] for j in range(hidden)])
            speed_out = momentum * speed_out - rate * np.array([out[f"o{j}"] / out["n"] for j in range(hidden + 1)])
            model.inner, model.outer = model.inner + speed_in, model.outer + speed_out
    return model


def losses_table(df: DataFrame, model: Perceptron) -> DataFrame:
    return df.sparkSession.createDataFrame([(i, float(v)) for i, v in model.losses], StructType([StructField("round", IntegerType()), StructField("loss", DoubleType())]))
