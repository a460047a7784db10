"""Bounded samples of labelled rows, and calibration of a single figure."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """(doc_id, text, label, part) of about ``rows`` labelled documents at most; part: a hash of the id in [0, 1).

    The sample is the ids of smallest hash, so it does not depend on how the
    table is partitioned. Null labels, ids and texts are left out.
    """
    marks = labels.where(F.col(label).isin(0, 1)).select(F.col("doc_id"), F.col(label).cast("int").alias("label")).where("doc_id is not null")
    unit = lambda salt: F.pmod(F.xxhash64(F.lit(salt), F.col("doc_id")), F.lit(1 << 30)) / float(1 << 30)
    n = marks.count()
    picked = marks.where(unit("sample") < min(1.0, rows / max(1, n))).dropDuplicates(["doc_id"])
    texts = docs.select("doc_id", "text").where("text is not null")
    # at most about ``rows`` ids, so the texts are not shuffled
    return texts.join(F.broadcast(picked), "doc_id").withColumn("part", unit("part"))


def logistic_fit(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and intercept of P(label 1 | x), by Newton steps with a small penalty on the slope."""
    if len(y) == 0:
        return 0.0, 0.0
    scale = float(np.std(x)) or 1.0
    a = np.column_stack([x / scale, np.ones(len(x))])
    w = np.array([0.0, np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))])
    ridge = np.diag([1e-2, 1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + ridge
        step = np.linalg.solve(h, a.T @ (y - p) - ridge @ w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0] / scale), float(w[1])
