"""Randomised properties (hypothesis) of the distributed building blocks."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strataflow.operators import explore as EX
from strataflow.operators import metrics as ME
from strataflow.operators.prefix import running_sums

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

values = st.lists(st.integers(min_value=-50, max_value=50), min_size=1, max_size=300)


@SETTINGS
@given(values, st.integers(min_value=3, max_value=200))
def test_exact_quantiles_equal_numpy(spark, xs, rows_per_task):
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 0.99, 1.0]
    got = {r["q"]: r["value"] for r in EX.quantiles(df, ["x"], probs, rows_per_task=rows_per_task).collect()}
    for q in probs:
        assert abs(got[q] - np.quantile(np.array(xs, dtype=float), q)) < 1e-9


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-20, 20)), min_size=1, max_size=200, unique=True),
       st.integers(min_value=2, max_value=50))
def test_running_sums_equal_cumsum(spark, pairs, rows_per_task):
    df = spark.createDataFrame([(g, k, k * k) for g, k in pairs], "g int, k int, v int")
    got = {(r["g"], r["k"]): (r["cum_v"], r["tot_v"]) for r in
           running_sums(df, "k", ["v"], ["g"], rows_per_task=rows_per_task, totals=True).collect()}
    for g in {g for g, _ in pairs}:
        ks = sorted(k for gg, k in pairs if gg == g)
        acc = 0
        for k in ks:
            acc += k * k
            assert got[(g, k)] == (acc, sum(x * x for x in ks))


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 10), st.booleans()), min_size=2, max_size=200))
def test_auc_equals_pairwise_definition(spark, rows):
    df = spark.createDataFrame([(float(s), float(lab)) for s, lab in rows], "score double, label double")
    pos = [s for s, lab in rows if lab]
    neg = [s for s, lab in rows if not lab]
    got = ME.auc(df, "score", "label", 1.0)
    if not pos or not neg:
        assert got is None
        return
    # Mann-Whitney: P(score+ > score-) + 0.5 P(tie)
    want = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert abs(got - want) < 1e-12
