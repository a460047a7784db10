"""Exploratory statistics (A8-A15, W1, W2, F12): the numbers behind the charts.

Each chart of the study becomes a small DataFrame computed over all rows:
quantiles, histograms, a density curve, a correlation matrix, box
statistics and 2-D density grids. Only bounded summaries (min/max, quantile
cut points, per-bin counts) reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .joins import join_summary
from .prefix import exact_quantiles_long, stack

APPROX_ACCURACY = 10_000
#: Bandwidths from its centre within which a bin adds to a density curve.
KDE_REACH = 8.5


# ---------------------------------------------------------------- quantiles
def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float] = (0.25, 0.5, 0.75, 0.99),
              by: Sequence[str] = (), exact: bool = True, rows_per_task: int = 1_000_000) -> DataFrame:
    """Linear-interpolated quantiles per column (and group), long form
    (by..., column_name, q, value).

    ``exact=True`` uses distributed running sums (exact at any size);
    ``exact=False`` uses ``percentile_approx`` sketches (one pass)."""
    by = list(by)
    return long_quantiles(stack(df, cols, keep=by), probs, [*by, "column_name"], exact, rows_per_task)


def long_quantiles(long: DataFrame, probs: Sequence[float], groups: Sequence[str], exact: bool = True,
                   rows_per_task: int = 1_000_000) -> DataFrame:
    """Quantiles of ``value`` per group of a long table: (groups..., q, value)."""
    groups = list(groups)
    if exact:
        return exact_quantiles_long(long, probs, groups, rows_per_task=rows_per_task)
    agg = long.groupBy(*groups).agg(F.percentile_approx("value", list(probs), APPROX_ACCURACY).alias("_qs"))
    return agg.select(*groups, F.posexplode("_qs").alias("_i", "value")) \
        .select(*groups, F.element_at(F.array(*[F.lit(float(q)) for q in probs]),
                                      F.col("_i") + 1).alias("q"), "value")


def quantile_values(df: DataFrame, cols: Sequence[str], q: float = 0.99, exact: bool = True) -> dict[str, float]:
    """{column: quantile} for a handful of columns (a bounded driver dict)."""
    rows = quantiles(df, cols, [q], exact=exact).collect()
    return {r["column_name"]: r["value"] for r in rows}


def quantile_clip(df: DataFrame, cols: Sequence[str], q: float = 0.99, exact: bool = True) -> DataFrame:
    """Keep rows strictly below each column's q-quantile, all columns ANDed.

    The cut points become literals, so the filter is an ordinary predicate
    (pushed into a Parquet scan when the columns are stored)."""
    cut = quantile_values(df, cols, q, exact)
    cond = None
    for c in cols:   # a column without values has no quantile: nothing is below it
        t = F.col(c) < F.lit(cut.get(c)).cast("double")
        cond = t if cond is None else cond & t
    return df.filter(cond)


# ---------------------------------------------------------------- histograms
def _min_max(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    r = df.agg(*[x for c in cols for x in (F.min(F.col(c).cast("double")).alias(f"lo_{c}"),
                                             F.max(F.col(c).cast("double")).alias(f"hi_{c}"))]).first()
    return {c: (r[f"lo_{c}"], r[f"hi_{c}"]) for c in cols}


def _bin(col: str, lo: float, hi: float, bins: int):
    """Equal-width bin in [0, bins); the last bin is right-closed."""
    if lo is None:
        return F.lit(None).cast("int")
    if hi == lo:
        return F.lit(0)
    idx = F.floor((F.col(col).cast("double") - F.lit(lo)) / F.lit(hi - lo) * F.lit(float(bins)))
    return F.least(idx, F.lit(bins - 1)).cast("int")


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 40) -> DataFrame:
    """Equal-width histogram over [min, max] per column, long form
    (column_name, bin, bin_lo, bin_hi, n); empty bins are omitted."""
    mm = _min_max(df, cols)
    parts = []
    for c in cols:
        lo, hi = mm[c]
        if lo is None:
            continue
        width = (hi - lo) / bins
        parts.append(F.struct(F.lit(c).alias("column_name"), _bin(c, lo, hi, bins).alias("bin"),
                              F.lit(lo).alias("_lo"), F.lit(width).alias("_w")))
    if not parts:   # every column empty or all-null
        return df.sparkSession.createDataFrame(
            [], "column_name string, bin int, bin_lo double, bin_hi double, n long")
    long = df.select(F.inline(F.array(*parts))).filter(F.col("bin").isNotNull())
    return long.groupBy("column_name", "bin", "_lo", "_w").agg(F.count(F.lit(1)).alias("n")).select(
        "column_name", "bin",
        (F.col("_lo") + F.col("bin") * F.col("_w")).alias("bin_lo"),
        (F.col("_lo") + (F.col("bin") + 1) * F.col("_w")).alias("bin_hi"), "n")


def density_grid(df: DataFrame, x: str, y: str, by: Sequence[str] = (), bins: int = 50) -> DataFrame:
    """2-D equal-width binned counts over [min, max] of x and y (A15):
    the scatter plot as a bounded table (by..., x_bin, y_bin, n)."""
    mm = _min_max(df, [x, y])
    (xl, xh), (yl, yh) = mm[x], mm[y]
    if xl is None or yl is None:
        empty = df.select(*by, F.lit(0).alias("x_bin"), F.lit(0).alias("y_bin"), F.lit(0).cast("long").alias("n"))
        return empty.where(F.lit(False))
    return (df.select(*by, _bin(x, xl, xh, bins).alias("x_bin"), _bin(y, yl, yh, bins).alias("y_bin"))
              .filter(F.col("x_bin").isNotNull() & F.col("y_bin").isNotNull())
              .groupBy(*by, "x_bin", "y_bin").agg(F.count(F.lit(1)).alias("n")))


def kde(df: DataFrame, cols: str | Sequence[str], grid_points: int = 200, bandwidth: float | None = None,
        bins_per_bandwidth: int = 512) -> DataFrame:
    """Gaussian density estimates on an even grid over [min, max] of each column.

    Rows are first counted into bins much narrower than the bandwidth (one
    aggregation for all columns; only non-empty bins exist), each represented
    by the mean of its values. Every bin then contributes its kernel term to
    the grid points within KDE_REACH bandwidths (a generator, no join; beyond
    them a term is below 2e-16 of its height) and a final aggregation sums per
    grid point. As the bins follow the bandwidth
    (Scott's rule by default, sample stddev * n^(-1/5)), the error does not
    grow with the number of rows. Output (x, density), for a list of columns
    with column_name first; each density integrates to 1.
    """
    names = [cols] if isinstance(cols, str) else list(cols)
    stats = df.agg(*[x for i, c in enumerate(names) for x in (
        F.count(F.col(c)).alias(f"n{i}"), F.stddev_samp(F.col(c).cast("double")).alias(f"s{i}"),
        F.min(F.col(c).cast("double")).alias(f"lo{i}"), F.max(F.col(c).cast("double")).alias(f"hi{i}"))]).first()
    parts, curves = [], []
    for i, c in enumerate(names):
        n, sd, lo, hi = (stats[f"{k}{i}"] for k in ("n", "s", "lo", "hi"))
        if not n or sd is None or sd == 0 or hi == lo or grid_points < 2:
            continue   # no curve
        h = float(bandwidth) if bandwidth else sd * n ** (-0.2)
        x = F.col(c).cast("double")
        parts.append(F.struct(
            F.lit(c).alias("column_name"), F.floor((x - F.lit(lo)) / F.lit(h / bins_per_bandwidth)).alias("bin"), x.alias("value"),
            F.lit(lo).alias("lo"), F.lit((hi - lo) / (grid_points - 1)).alias("step"), F.lit(h).alias("h"),
            F.lit(n * h * math.sqrt(2.0 * math.pi)).alias("norm")))
        curves.append((c, float(lo), float((hi - lo) / (grid_points - 1)), h, float(n * h * math.sqrt(2.0 * math.pi))))
    if not parts:
        out = df.sparkSession.createDataFrame([], "column_name string, x double, density double")
        return out.drop("column_name") if isinstance(cols, str) else out
    of = ["column_name", "lo", "step", "h", "norm"]
    bins = (df.select(F.inline(F.array(*parts))).where(F.col("value").isNotNull())
              .groupBy(*of, "bin").agg(F.count(F.lit(1)).alias("c"), F.avg("value").alias("centre")))
    # a bin adds to the grid points within KDE_REACH bandwidths; the others still have a row
    at = lambda side: (F.col("centre") - F.col("lo") + F.lit(side * KDE_REACH) * F.col("h")) / F.col("step")
    near = F.filter(F.sequence(F.greatest(F.ceil(at(-1)), F.lit(0)).cast("int"), F.greatest(F.least(F.floor(at(1)), F.lit(grid_points - 1)), F.lit(0)).cast("int")),
                    lambda i: i.between(F.ceil(at(-1)), F.floor(at(1))))
    pts = bins.select(*of, "c", "centre", F.explode(near).alias("i"))
    grid = df.sparkSession.createDataFrame(curves, "column_name string, lo double, step double, h double, norm double")
    grid = grid.select(*of, F.lit(0).cast("long").alias("c"), F.col("lo").alias("centre"), F.explode(F.sequence(F.lit(0), F.lit(grid_points - 1))).alias("i"))
    pts = pts.unionByName(grid)
    z = (F.col("lo") + F.col("i") * F.col("step") - F.col("centre")) / F.col("h")
    out = (pts.groupBy(*of, "i").agg(F.sum(F.col("c") * F.exp(F.lit(-0.5) * z * z)).alias("_s"))
              .select("column_name", (F.col("lo") + F.col("i") * F.col("step")).alias("x"), (F.col("_s") / F.col("norm")).alias("density"))
              .orderBy("column_name", "x"))   # curves of grid_points rows
    return out.drop("column_name") if isinstance(cols, str) else out


# ---------------------------------------------------------------- correlation
def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson r for every ordered pair, one aggregation pass.

    r = covar_samp / (stddev_samp · stddev_samp); null when a column is
    constant (``try_divide``), where Spark's ``corr`` would raise under ANSI.
    """
    cols = list(cols)
    aggs = [F.stddev_samp(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(cols)]
    for i in range(len(cols)):
        for j in range(i + 1, len(cols)):
            aggs.append(F.covar_samp(F.col(cols[i]).cast("double"), F.col(cols[j]).cast("double")).alias(f"c{i}_{j}"))
    one = df.agg(*aggs)
    cells = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if i == j:
                r = F.when(F.col(f"s{i}") > 0, F.lit(1.0))
            else:
                lo, hi = min(i, j), max(i, j)
                r = F.try_divide(F.col(f"c{lo}_{hi}"), F.col(f"s{lo}") * F.col(f"s{hi}"))
            cells.append(F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), r.cast("double").alias("r")))
    return one.select(F.inline(F.array(*cells)))


# ---------------------------------------------------------------- groups
def group_share(df: DataFrame, group: str, cls: str) -> DataFrame:
    """Counts per (group, class) and the share within each group."""
    counts = df.groupBy(group, cls).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(group)))


def cluster_means(df: DataFrame, cols: Sequence[str], cluster: str = "prediction") -> DataFrame:
    """Per-cluster count and mean of each column over all rows."""
    return df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"),
                                   *[F.avg(F.col(c).cast("double")).alias(c) for c in cols])


def cluster_profile(df: DataFrame, cluster: str = "prediction",
                    spec: Sequence[tuple[str, str, int]] = (
                        ("trip_distance", "avg_distance", 2), ("fare_amount", "avg_fare", 2),
                        ("trip_duration_min", "avg_duration_min", 1), ("pickup_hour", "avg_hour", 1),
                        ("passenger_count", "avg_passengers", 2))) -> DataFrame:
    """n and rounded means per cluster, ordered by cluster."""
    return (df.groupBy(cluster)
              .agg(F.count(F.lit(1)).alias("n"),
                   *[F.round(F.avg(c), d).alias(name) for c, name, d in spec])
              .orderBy(cluster))


def cluster_zscores(means: DataFrame, cols: Sequence[str], cluster: str = "prediction") -> DataFrame:
    """z-score of each per-cluster mean down its column, population stddev
    over clusters, unweighted (W2). Input: one row per cluster (tiny)."""
    w = Window.partitionBy("column_name")
    long = stack(means, cols, keep=[cluster], value="mean")
    sd = F.stddev_pop("mean").over(w)
    return long.withColumn("z", F.when(sd > 0, (F.col("mean") - F.avg("mean").over(w)) / sd))


def box_stats(df: DataFrame, by: str, cols: Sequence[str], clip_q: float | None = 0.99,
              exact: bool = True, whisker: float = 1.5) -> DataFrame:
    """Box-plot statistics per (group, column).

    Each column is first cut at its own global ``clip_q`` quantile (strictly
    below), then per group: quartiles (linear), 1.5·IQR fences, whiskers at
    the last data point inside the fences, and the count outside them.

    Cut points and quartiles come from sketches that bracket their ranks (two
    scans each in exact mode, one otherwise), then one aggregation counts and
    finds whiskers. No table of distinct values is written, no group is
    gathered anywhere; the fences join back through a size-checked summary
    join.
    """
    long = stack(df, cols, keep=[by])
    if clip_q is not None:
        cut = quantile_values(df, cols, clip_q, exact)
        bounds = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(cut.get(c)).cast("double"))])
        long = long.filter(F.col("value") < F.element_at(bounds, F.col("column_name")))
    long = long.filter(F.col("value").isNotNull())
    qs = long_quantiles(long, (0.25, 0.5, 0.75), [by, "column_name"], exact)
    j = join_summary(long, _fences(qs, by, whisker), [by, "column_name"])
    inside = (F.col("value") >= F.col("lo_fence")) & (F.col("value") <= F.col("hi_fence"))
    return j.groupBy(by, "column_name", "q1", "median", "q3").agg(
        F.count(F.lit(1)).alias("n"), *_whiskers(inside),
        F.sum(F.when(inside, 0).otherwise(1)).cast("long").alias("n_outliers"))


def _whiskers(inside: Column) -> list[Column]:
    """Last data points inside the fences, never inside the box."""
    return [F.least(F.min(F.when(inside, F.col("value"))), F.col("q1")).alias("whisker_lo"),
            F.greatest(F.max(F.when(inside, F.col("value"))), F.col("q3")).alias("whisker_hi")]


def _fences(qs: DataFrame, by: str, whisker: float) -> DataFrame:
    quart = qs.groupBy(by, "column_name").agg(
        *[F.max(F.when(F.col("q") == q, F.col("value"))).alias(n)
          for q, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])
    return quart.select(by, "column_name", "q1", "median", "q3",
                        (F.col("q1") - F.lit(whisker) * (F.col("q3") - F.col("q1"))).alias("lo_fence"),
                        (F.col("q3") + F.lit(whisker) * (F.col("q3") - F.col("q1"))).alias("hi_fence"))
