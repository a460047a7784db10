"""Sampling, splitting and sample validation.

All samples are hash-threshold filters on ``uniform(row_key, salt)``: map
only, the same rows for any partitioning or executor loss, and pushed into
the scan together with the other filters. ``method="native"`` keeps Spark's
``sampleBy`` / ``randomSplit`` for callers that want them.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import uniform
from ..session import checkpointed
from .joins import join_summary
from .strata import STRATUM


def salt_for(purpose: str, seed: int) -> str:
    return f"{purpose}:{seed}"


def proportional_fraction(n_target: int, n_total: int) -> float:
    """max(0, min(1, n/N)), 0 for an empty population (M1)."""
    if n_total <= 0:
        return 0.0
    return max(0.0, min(1.0, n_target / n_total))


def sample_flag(fraction: float, seed: int = 42, row_key: str = "event_id", purpose: str = "strata") -> Column:
    """The Bernoulli membership test as a boolean Column (u(row_key) < fraction)."""
    return uniform(row_key, salt_for(purpose, seed)) < F.lit(float(fraction))


def bernoulli(df: DataFrame, fraction: float, seed: int = 42, row_key: str = "event_id",
              purpose: str = "sample") -> DataFrame:
    """Keep rows with u(row_key) < fraction."""
    return df.filter(sample_flag(fraction, seed, row_key, purpose))


def stratified_sample(df: DataFrame, key: str = STRATUM, n: int | None = None,
                      fraction: float | None = None, fractions: Mapping[str, float] | None = None,
                      seed: int = 42, row_key: str = "event_id", method: str = "hash") -> DataFrame:
    """Stratified Bernoulli sample (M1, M2).

    ``fractions`` gives a rate per stratum (strata missing from it get 0);
    otherwise one proportional rate, ``fraction`` or ``min(1, n/N)``, is used
    for every stratum, which keeps each stratum's share in expectation.
    """
    if fractions is None:
        if fraction is None:
            if n is None:
                raise ValueError("give n, fraction or fractions")
            fraction = proportional_fraction(n, df.count())
        if method == "native":
            keys = [r[0] for r in df.select(key).distinct().collect()]
            return df.sampleBy(key, {k: fraction for k in keys}, seed)
        return bernoulli(df, fraction, seed, row_key, "strata")
    if method == "native":
        return df.sampleBy(key, dict(fractions), seed)
    rate = F.coalesce(F.create_map(*[x for k, v in fractions.items() for x in (F.lit(k), F.lit(float(v)))])
                      [F.col(key)], F.lit(0.0)) if fractions else F.lit(0.0)
    return df.filter(uniform(row_key, salt_for("strata", seed)) < rate)


def sample_to(df: DataFrame, n: int, seed: int = 42, row_key: str = "event_id",
              purpose: str = "plot", n_total: int | None = None) -> DataFrame:
    """Simple Bernoulli sample with fraction min(1, n/N) (M4)."""
    total = df.count() if n_total is None else n_total
    return bernoulli(df, proportional_fraction(n, total), seed, row_key, purpose)


# ---------------------------------------------------------------- exact allocation (M3)
def allocate(counts: Mapping[str, int], n: int) -> dict[str, int]:
    """Largest-remainder proportional allocation: n_i = n·c_i/N rounded so
    that the n_i sum to min(n, N) exactly. Ties go to the larger remainder,
    then the smaller key."""
    total = sum(counts.values())
    if total <= 0:
        return {k: 0 for k in counts}
    n = min(n, total)
    base = {k: (n * c) // total for k, c in counts.items()}
    rem = sorted(counts, key=lambda k: (-((n * counts[k]) % total), k))
    left = n - sum(base.values())
    for k in rem[:left]:
        base[k] += 1
    return base


#: Name of the null stratum in lookups.
_NULL = "\x00null"


def stratified_exact(df: DataFrame, n: int, key: str = STRATUM, seed: int = 42,
                     row_key: str = "event_id", z: float = 6.0,
                     rows_per_task: int = 1_000_000,
                     counts: Mapping[str, int] | None = None) -> DataFrame:
    """Exactly n_i rows per stratum: the n_i smallest (u, row_key) (M3).

    A null stratum is one like others. Given ``counts`` may be stale: a
    stratum that has fewer rows than its share gives all it has.

    1. per-stratum counts (partial aggregation; one row per stratum);
    2. a map-only oversample ``u < t_i`` with t_i a few sigma above n_i/c_i,
       re-run with a wider margin for any stratum that came up short, so no
       stratum is ever truncated;
    3. the candidates (about n_i each, checkpointed) are ranked in two levels: counts per
       (stratum, u-bucket) give bucket offsets, and a window ranks rows only
       inside one bucket, so no task holds more than ~``rows_per_task`` rows
       even when one stratum holds a third of the data.
    """
    if counts is None:   # per-stratum sizes; pass them when already known to save a scan
        counts = {r[0]: r[1] for r in df.groupBy(key).count().collect()}
    # strata are looked up by name; the null stratum has one of its own
    named = lambda k: _NULL if k is None else str(k)
    counts = {named(k): c for k, c in counts.items()}
    stratum = F.coalesce(F.col(key).cast("string"), F.lit(_NULL))
    if not counts:
        return df.filter(F.lit(False))
    alloc = allocate(counts, n)
    u = uniform(row_key, salt_for("exact", seed))
    thr = {}
    for k, c in counts.items():
        m = alloc[k]
        thr[k] = 1.0 if m >= c else min(1.0, (m + max(z, 0.0) * math.sqrt(m + 1.0) + 10.0) / c)
    while True:
        tmap = F.create_map(*[x for k, t in thr.items() for x in (F.lit(k), F.lit(float(t)))])
        # candidates are about n rows: checkpoint them so the count, the bucket
        # table and the ranking read them instead of rescanning the input
        cand = checkpointed(df.withColumn("_u", u).filter(F.col("_u") < tmap[stratum]))
        got = {named(r[0]): r[1] for r in cand.groupBy(key).count().collect()}
        for k in counts:   # a complete stratum has no more rows, whatever the given counts say
            if thr[k] >= 1.0:
                alloc[k] = min(alloc[k], got.get(k, 0))
        short = [k for k in counts if got.get(k, 0) < alloc[k]]
        if not short:
            break
        for k in short:   # widen only the short strata; at 1.0 a stratum is complete
            thr[k] = min(1.0, thr[k] * 2.0)
    n_max = max(got.values()) if got else 0
    buckets = max(1, math.ceil(n_max / rows_per_task))
    cand = cand.withColumn("_b", F.least(F.floor(F.col("_u") / tmap[stratum] * buckets),
                                         F.lit(buckets - 1)).cast("int"))
    if buckets == 1:
        offs = None
    else:
        bc = cand.groupBy(key, "_b").agg(F.count(F.lit(1)).alias("_n"))
        offs = bc.withColumn("_off", F.sum("_n").over(
            Window.partitionBy(key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))).fillna(0, ["_off"])
        cand = join_summary(cand, offs.select(key, "_b", "_off"), [key, "_b"])
    amap = F.create_map(*[x for k, a in alloc.items() for x in (F.lit(k), F.lit(int(a)))])
    rank = F.row_number().over(Window.partitionBy(key, "_b").orderBy("_u", row_key))
    if offs is not None:
        rank = rank + F.col("_off")
    return cand.withColumn("_rank", rank) \
        .filter(F.col("_rank") <= amap[stratum]).drop("_u", "_b", "_off", "_rank")


# ---------------------------------------------------------------- splitting (M5)
def with_split(df: DataFrame, weights: Sequence[float] = (0.7, 0.3), names: Sequence[str] = ("train", "test"),
               seed: int = 42, row_key: str = "event_id", col: str = "split") -> DataFrame:
    """Label each row with its split: disjoint and complete by construction."""
    total = float(sum(weights))
    u = uniform(row_key, salt_for("split", seed))
    acc, expr = 0.0, None
    for w, name in zip(weights[:-1], names[:-1]):
        acc += w / total
        expr = (F.when(u < F.lit(acc), F.lit(name)) if expr is None
                else expr.when(u < F.lit(acc), F.lit(name)))
    last = F.lit(names[len(weights) - 1])
    return df.withColumn(col, last if expr is None else expr.otherwise(last))


def split(df: DataFrame, weights: Sequence[float] = (0.7, 0.3), seed: int = 42,
          row_key: str = "event_id", method: str = "hash") -> list[DataFrame]:
    """Random split by hash of the row key (or native ``randomSplit``)."""
    if method == "native":
        return df.randomSplit(list(weights), seed)
    names = [f"s{i}" for i in range(len(weights))]
    labelled = with_split(df, weights, names, seed, row_key, "_split")
    return [labelled.filter(F.col("_split") == n).drop("_split") for n in names]


def split_balance(df: DataFrame, split_col: str = "split", cls: str = "pay_class",
                  positive: str = "card") -> DataFrame:
    """Rows and positive-class share per split, one aggregation (A4)."""
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n"),
                                     F.avg((F.col(cls) == positive).cast("double")).alias("positive_share"))


# ---------------------------------------------------------------- validation
def sample_validation(population: DataFrame, sample: DataFrame | None = None, key: str = STRATUM,
                      in_sample: Column | None = None) -> DataFrame:
    """Population vs sample share per stratum with absolute error.

    With ``in_sample`` (a membership Column of a hash sample of
    ``population``) both counts come from ONE scan and one aggregation.
    With a separate ``sample`` frame both sides are aggregated first (one
    row per stratum), so the join is between two tiny tables; AQE
    broadcasts the sample side at run time.
    """
    w = Window.partitionBy()
    if in_sample is not None:
        c = population.groupBy(key).agg(F.count(F.lit(1)).alias("n_pop"),
                                         F.sum(in_sample.cast("long")).alias("n_sample"))
        v = c.select(key, "n_pop", "n_sample",
                     (F.col("n_pop") / F.sum("n_pop").over(w)).alias("share_pop"),
                     F.coalesce(F.try_divide(F.col("n_sample"), F.sum("n_sample").over(w)),
                                F.lit(0.0)).alias("share_sample"))
        return v.withColumn("abs_err", F.abs(F.col("share_pop") - F.col("share_sample")))
    return validation_from_counts(population.groupBy(key).agg(F.count(F.lit(1)).alias("n_pop")),
                                  sample.groupBy(key).agg(F.count(F.lit(1)).alias("n_sample")), key)


def validation_from_counts(pop_counts: DataFrame, sample_counts: DataFrame, key: str = STRATUM) -> DataFrame:
    """J1 from per-stratum counts (key, n_pop) and (key, n_sample): lets a
    caller reuse population counts it already has instead of rescanning."""
    w = Window.partitionBy()
    pop = pop_counts.withColumn("share_pop", F.col("n_pop") / F.sum("n_pop").over(w))
    smp = sample_counts.withColumn("share_sample", F.col("n_sample") / F.sum("n_sample").over(w))
    v = pop.join(smp, key, "left").fillna(0, ["n_sample"]).fillna(0.0, ["share_sample"])
    return v.select(key, "n_pop", "n_sample", "share_pop", "share_sample",
                    F.abs(F.col("share_pop") - F.col("share_sample")).alias("abs_err"))


def sample_validation_long(v: DataFrame, key: str = STRATUM) -> DataFrame:
    """Melt the two shares to (key, source, share)."""
    return v.select(key, F.inline(F.array(
        F.struct(F.lit("population").alias("source"), F.col("share_pop").alias("share")),
        F.struct(F.lit("sample").alias("source"), F.col("share_sample").alias("share")))))


def max_deviation(v: DataFrame) -> DataFrame:
    """Largest absolute share error, unrounded."""
    return v.agg(F.max("abs_err").alias("max_abs_err"))
