"""Distributed running sums over a global order, and exact quantiles on top.

A plain ``Window.orderBy`` without partition keys moves every row into one
task. Here the ordered table is range-partitioned into buckets of about
``rows_per_task`` rows; each bucket's totals (a table of B rows) give its
offset, and a window runs only inside one bucket. Null order values and null
partition keys are values like others, whatever the number of buckets. The result is exact; no task holds more than about
``rows_per_task`` rows whatever the data size or skew of the input, because
the callers aggregate to one row per distinct order value first.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed
from .joins import join_summary


#: Accuracy of the sketches that bracket a rank: an error of 1/SKETCH of a group's rows at most.
SKETCH = 10_000


def _bucketed(df: DataFrame, order_col: str, descending: bool, rows_per_task: int,
              n_rows: int | None = None) -> tuple[DataFrame, int]:
    """``df`` with ``_bkt``: numbers of value ranges, in the order of the sort.

    One bucket needs no shuffle. Otherwise the rows are range-partitioned, so
    nulls and NaN lie where the same sort puts them, and written once: the
    partition number is then a stable column."""
    n = df.count() if n_rows is None else n_rows
    buckets = max(1, math.ceil(n / rows_per_task))
    if buckets == 1:
        return df.withColumn("_bkt", F.lit(0)), 1
    order = F.col(order_col).desc() if descending else F.col(order_col).asc()
    return checkpointed(df.repartitionByRange(buckets, order).withColumn("_bkt", F.spark_partition_id())), buckets


def running_sums(df: DataFrame, order_col: str, sum_cols: Sequence[str],
                 partition_cols: Sequence[str] = (), descending: bool = False,
                 rows_per_task: int = 1_000_000, prefix: str = "cum_",
                 n_rows: int | None = None, totals: bool = False) -> DataFrame:
    """Add inclusive running sums ``cum_<c>`` of ``sum_cols`` in ``order_col``
    order within ``partition_cols``. ``order_col`` must be unique within a
    partition (aggregate by it first). ``n_rows`` (row count of ``df``, if
    already known) saves a counting job. ``totals`` also adds the partition
    totals ``tot_<c>``, from the same windows / bucket table (no extra scan)."""
    part = list(partition_cols)
    b, nb = _bucketed(df, order_col, descending, rows_per_task, n_rows)
    order = F.col(order_col).desc() if descending else F.col(order_col).asc()
    w_bkt = Window.partitionBy(*part, "_bkt")
    w_in = w_bkt.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    extra = [F.sum(c).over(w_bkt).alias(f"_b_{c}") for c in sum_cols] if totals and nb == 1 else []
    out = b.select("*", *[F.sum(c).over(w_in).alias(f"_in_{c}") for c in sum_cols], *extra)
    if nb > 1:
        tot = b.groupBy(*part, "_bkt").agg(*[F.sum(c).alias(f"_t_{c}") for c in sum_cols])
        w_off = Window.partitionBy(*part).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
        w_all = Window.partitionBy(*part)
        offs = tot.select(*part, "_bkt",
                          *[F.coalesce(F.sum(f"_t_{c}").over(w_off), F.lit(0)).alias(f"_o_{c}") for c in sum_cols],
                          *[F.sum(f"_t_{c}").over(w_all).alias(f"_b_{c}") for c in sum_cols])
        out = join_summary(out, offs, [*part, "_bkt"])
        cols = [(F.col(f"_in_{c}") + F.col(f"_o_{c}")).alias(f"{prefix}{c}") for c in sum_cols]
    else:
        cols = [F.col(f"_in_{c}").alias(f"{prefix}{c}") for c in sum_cols]
    if totals:
        cols += [F.col(f"_b_{c}").alias(f"tot_{c}") for c in sum_cols]
    return out.select(*b.columns, *cols).drop("_bkt")


def stack(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (),
          name: str = "column_name", value: str = "value") -> DataFrame:
    """Long form (keep..., column_name, value) of several numeric columns."""
    return df.select(*keep, F.inline(F.array(*[
        F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias(value)) for c in cols])))


def exact_quantiles_long(long: DataFrame, probs: Sequence[float], group_cols: Sequence[str],
                         value: str = "value", rows_per_task: int = 1_000_000) -> DataFrame:
    """Exact linear-interpolation quantiles of ``value`` per group, as a
    DataFrame (group..., q, value).

    Position h = (N-1)·q; result = v[floor h] + (v[ceil h] - v[floor h])·(h - floor h),
    the definition shared by pandas, numpy, Spark ``percentile`` and DuckDB
    ``quantile_cont``. Two scans: a sketch per group brackets each wanted
    rank between two values; then only values inside a bracket are kept one
    by one, everything between two brackets becomes one row (its count and
    its least value), and the exact ranks are looked up among those. A rank
    that a sketch missed is noticed, and all distinct values are used then.
    No group's values are ever gathered in one task and nothing but the
    result reaches the driver.
    """
    if not group_cols:
        return exact_quantiles_long(long.withColumn("_all", F.lit(0)), probs, ["_all"], value, rows_per_task).drop("_all")
    g, probs = list(group_cols), [float(q) for q in probs]
    held = long.filter(F.col(value).isNotNull()).select(*g, value)
    edges = [max(0.0, q - 2 / SKETCH) for q in probs] + [min(1.0, q + 2 / SKETCH) for q in probs]
    sketch = held.groupBy(*g).agg(F.percentile_approx(value, edges, SKETCH).alias("_e"))
    near = join_summary(held, sketch, g)
    v = F.col(value)
    inside, passed = F.lit(False), F.lit(0)
    for i in range(len(probs)):
        low, high = F.col("_e")[i], F.col("_e")[i + len(probs)]
        inside = inside | v.between(low, high)
        passed = passed + (v > high).cast("int")
    kept = near.withColumn("_kept", F.when(inside, v)).withColumn("_gap", F.when(~inside, passed))
    counts = checkpointed(kept.groupBy(*g, "_gap", "_kept").agg(F.count(F.lit(1)).alias("_c"), F.min(v).alias(value))
                          .select(*g, value, "_c", F.col("_kept").isNull().alias("_whole")))
    out = checkpointed(_ranked(counts, probs, g, value, rows_per_task))
    if out.where("_unsure").isEmpty():
        return out.drop("_unsure")
    distinct = held.groupBy(*g, value).agg(F.count(F.lit(1)).alias("_c"))
    return quantiles_from_counts(checkpointed(distinct), probs, g, value, "_c", rows_per_task)


def quantiles_from_counts(counts: DataFrame, probs: Sequence[float], group_cols: Sequence[str],
                          value: str = "value", count: str = "_c",
                          rows_per_task: int = 1_000_000) -> DataFrame:
    """:func:`exact_quantiles_long` on a table that already holds one row per
    distinct (group, value) with its multiplicity ``count``."""
    if count != "_c":
        counts = counts.withColumnRenamed(count, "_c")
    return _ranked(counts.withColumn("_whole", F.lit(False)), probs, list(group_cols), value, rows_per_task).drop("_unsure")


def _ranked(counts: DataFrame, probs: Sequence[float], g: list[str], value: str, rows_per_task: int) -> DataFrame:
    """(group..., q, value, _unsure) from rows of distinct values and their counts.

    A ``_whole`` row stands for several values, of which only the least is
    known: a rank inside it, beyond the first, is unsure."""
    # group sizes N come with the running sums (bucket windows / bucket table)
    cum = running_sums(counts, value, ["_c"], g, rows_per_task=rows_per_task, totals=True)
    n = F.col("tot__c")
    start = F.col("cum__c") - F.col("_c")
    hits = []
    for q in probs:
        h = (n - F.lit(1)).cast("double") * F.lit(float(q))
        for kind, rank in (("lo", F.floor(h)), ("hi", F.ceil(h))):
            hits.append(F.when((start <= rank) & (F.col("cum__c") > rank),
                               F.struct(F.lit(float(q)).alias("q"), F.lit(kind).alias("kind"), h.alias("h"),
                                        F.col(value).cast("double").alias("v"), (F.col("_whole") & (start < rank)).alias("unsure"))))
    found = cum.select(*g, F.explode(F.filter(F.array(*hits), lambda x: x.isNotNull())).alias("_hit"))
    per_q = found.groupBy(*g, F.col("_hit.q").alias("q")).agg(
        F.max(F.when(F.col("_hit.kind") == "lo", F.col("_hit.v"))).alias("_vlo"),
        F.max(F.when(F.col("_hit.kind") == "hi", F.col("_hit.v"))).alias("_vhi"),
        F.max("_hit.h").alias("_h"), F.max("_hit.unsure").alias("_unsure"))
    frac = F.col("_h") - F.floor("_h")
    val = F.when(frac == 0, F.col("_vlo")).otherwise(F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * frac)
    return per_q.select(*g, "q", val.alias("value"), "_unsure")
